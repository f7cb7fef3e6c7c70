"""near_dedup against the plain rule: texts whose shingle sets are alike are one, and nothing else is."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loam.llm import neardup, simhash


def kept(spark, texts, **args):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(r.doc_id for r in neardup.near_dedup(docs, **args).collect())


def expected(texts, words=5, similarity=0.8):
    sets = [set(simhash.shingle_hashes((t or "").encode(), words).tolist()) for t in texts]
    names = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if names[i] != names[j] and min(len(sets[i]), len(sets[j])) >= similarity * max(len(sets[i]), len(sets[j])):
                shared = len(sets[i] & sets[j])
                if shared >= similarity * (len(sets[i]) + len(sets[j]) - shared):
                    low, high = sorted((names[i], names[j]))
                    names = [low if n == high else n for n in names]
    return [k for k, n in enumerate(names) if n == k]


def test_clean_rows_and_one_of_each_group_stay(spark):
    words = [f"w{k}" for k in range(400)]
    near = words[:200] + ["changed"] + words[201:]
    other = [f"x{k}" for k in range(300)] + words[:60]  # shares a passage only
    rows = [(4, " ".join(words)), (2, " ".join(near)), (8, " ".join(words)), (1, " ".join(other)), (6, None), (5, ""), (9, "one"), (9, "one"), (None, "two words"), (None, "two words"), (7, "three words now"), (7, "four words here now")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, node int").withColumns({c: F.lit("x") for c in ("id", "row", "k", "n", "own", "f0", "rank", "class", "other")})
    out = neardup.near_dedup(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted([2, 1, 5, 9, 7, 7, None], key=str)
    assert neardup.near_dedup(docs.limit(0)).count() == 0


@pytest.mark.parametrize("changed", [5, 6])
def test_groups_about_the_threshold(spark, changed):
    rng = np.random.default_rng(changed)
    texts = []
    for g in range(10):
        base = [f"g{g}w{n}" for n in range(400)]
        for _ in range(40):
            words = list(base)
            for at in rng.choice(400, changed, replace=False):
                words[at] = f"x{rng.integers(0, 1 << 40)}"
            texts.append(" ".join(words))
    want = expected(texts)
    assert kept(spark, texts) == want
    # in blocks of few texts, shingles dealt out as if hot, and with nothing left to chance
    assert kept(spark, texts, block_rows=7, block_shingles=2000, hot_rows=5) == want
    assert kept(spark, texts, radius=256) == want


def test_repeated_boilerplate_joins_nothing(spark):
    line = " ".join(f"line{k}" for k in range(11))
    texts = [" ".join([*[line] * 1000, *(f"{c}{k}" for k in range(300))]) for c in "abcd"]
    assert kept(spark, texts) == expected(texts) == [0, 1, 2, 3]


def test_copies_that_repeat_a_line_differently_are_one(spark):
    words, line = " ".join(f"w{k}" for k in range(300)), " ".join(f"line{k}" for k in range(11))
    texts = [" ".join([words, *[line] * n]) for n in (3, 100)]
    assert kept(spark, texts) == expected(texts) == [0]


def test_equal_fingerprints_alone_join_nothing(spark, monkeypatch):
    def sketches(docs, *args):
        return docs.selectExpr("doc_id as id", "xxhash64(text) as node", "xxhash64(1, text) as other", "60L as size", *(f"0L as {f}" for f in neardup.FPS))

    monkeypatch.setattr(neardup, "sketches", sketches)
    line = " ".join(f"line{k}" for k in range(11))
    texts = [" ".join([*(f"{c}{k}" for k in range(24)), *[line] * 100]) for c in "ab"]
    assert kept(spark, texts) == expected(texts) == [0, 1]


def test_texts_of_one_node_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(neardup, "text_hashes", lambda text: (F.length(text).cast("long"), F.xxhash64(F.lit(1), text)))
    texts = ["one two three", "abc def ghijk", "one two three", "one two  three"]
    assert kept(spark, texts) == [0, 1, 3]


def test_short_texts_and_texts_just_alike_are_all_found(spark):
    rng = np.random.default_rng(4)
    texts = [None, "", " \n"]
    for k in range(40):  # 4 of 5 shingles shared
        words = [f"w{n}" for n in rng.integers(0, 1 << 40, 8)]
        texts += [" ".join(words), " ".join([*words, "more"])]
    for k in range(40):  # 9 to 13 of 96 shingles changed: similarity 0.76 to 0.83
        words = [f"v{n}" for n in rng.integers(0, 1 << 40, 100)]
        cut = int(rng.integers(9, 14))
        texts += [" ".join(words), " ".join([*words[:-cut], *(f"u{n}" for n in rng.integers(0, 1 << 40, cut))])]
    texts += ["one", "One", "two words", "TWO  words", "two words more"]
    assert kept(spark, texts) == expected(texts)


def test_a_chance_of_missing_a_pair_is_small():
    assert neardup.missed() < 1e-8 and neardup.missed(radius=256) == 0 < neardup.missed(radius=52) < 0.1
    rng = np.random.default_rng(6)
    for shared, one, two in ((4, 0, 1), (8, 1, 1), (8, 2, 0), (9, 1, 1), (16, 2, 2), (12, 0, 3)):  # small sets of similarity 0.8
        far = []
        for _ in range(2000):
            h = rng.integers(0, 2**64, shared + one + two, dtype=np.uint64)
            far.append(sum((x ^ y).bit_count() for x, y in zip(simhash.fingerprint(h[: shared + one], neardup.LANES), simhash.fingerprint(np.delete(h, slice(shared, shared + one)), neardup.LANES), strict=True)))
        assert np.mean(far) + 4.7 * np.std(far) < neardup.RADIUS


def test_pages_of_a_template_move_once(spark):
    """20 slots of 10 phrases each: pages share phrases, none are alike. Their texts go to no blocks of candidates."""
    rng = np.random.default_rng(9)
    phrases = [[" ".join(f"s{s}p{p}w{k}" for k in range(8)) for p in range(10)] for s in range(20)]
    texts = [" ".join(phrases[s][rng.integers(0, 10)] for s in range(20)) for _ in range(1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    moved = []
    real = neardup.tiles

    def tiles(rows, names):
        out = real(rows, names)
        if "text" in names:
            moved.append(out.count())
        return out

    neardup.tiles = tiles
    try:
        assert neardup.near_dedup(docs).count() == len(set(texts))
    finally:
        neardup.tiles = real
    assert moved[0] < 30
