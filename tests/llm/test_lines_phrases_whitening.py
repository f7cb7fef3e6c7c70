"""op11 to op13 against plain versions, on the given tables and on small odd ones."""

import math
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from loam.llm import linededup, phrases, queries, whitening

SF = "/root/testdata/sf0.001"
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# whitening


def plain_fit(vectors, scale=64):
    x = sorted({tuple(math.floor(scale * float(c)) + 1_000_000 for c in v) for v in vectors})
    n, dim = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(dim)]
    z = [[n * r[i] - s[i] for i in range(dim)] for r in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in z), n**3)) for j in range(dim)] for i in range(dim)])
    return n, s, cov


def check_whitening(rows, vectors):
    """rows: the result by id; vectors: id to vector of the rows that take part."""
    n, s, cov = plain_fit(vectors.values())
    values = np.linalg.eigvalsh(cov)[::-1]
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert set(got) == set(vectors)
    width = min(16, len(s))
    z = {}
    for k, v in vectors.items():
        assert set(got[k]) == set(range(1, width + 1))
        x = [math.floor(64 * float(c)) + 1_000_000 for c in v]
        assert {r.deviation for r in got[k].values()} == {sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))}
        assert {r.n for r in got[k].values()} == {n}
        z[tuple(x)] = [got[k][c].whitened for c in range(1, width + 1)]
    own = np.array(list(z.values()))
    assert np.abs(own.mean(axis=0)).max() < 1e-9
    live = values[:width] > 1e-9
    assert np.abs(own.T @ own / n - np.diag(live.astype(float))).max() < 1e-8
    first = next(iter(got.values()))
    assert np.allclose([first[c].explained for c in range(1, width + 1)], np.where(live, values[:width], 0) / values.sum(), rtol=1e-9)
    assert all(r.identity_error < 1e-9 for r in first.values())


def test_op11_over_the_table(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    check_whitening(queries.op11_whitening(spark, SF).collect(), vectors)


def test_whitening_of_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    good = {k: rng.normal(size=5).tolist() for k in range(40)} | {100 + k: [0.5, 0.25, -1.0, 3.0, 0.0] for k in range(60)}
    bad = [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0]), (202, [1.0, float("nan"), 0.0, 0.0, 0.0]), (203, [float("inf")] * 5), (204, [])]
    table = spark.createDataFrame([*good.items(), *bad], "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("x", "dim", "component")})
    check_whitening(whitening.whitened(table).collect(), good)
    assert whitening.whitened(table.filter("vec_id >= 200")).collect() == []
    one = whitening.whitened(table.filter("vec_id >= 100"), components=3).collect()
    assert len(one) == 180 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(1, 0, 0.0, 0.0, 0.0)}


def test_whitening_of_huge_components_and_several_lengths(spark):
    rows = [(1, [1e306, -1e308]), (2, [5e-324, 0.0]), (3, [-1e15, 1e15]), (None, [1.0, 2.0]), (5, [1.0, 2.0, 3.0]), (6, [2.0, 2.0, 5.0]), (6, [2.0, 2.0, 5.0])]
    out = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert Counter((r.vec_id, r.n) for r in out) == {(1, 4): 2, (2, 4): 2, (3, 4): 2, (None, 4): 2, (5, 2): 3, (6, 2): 6}
    assert all(math.isfinite(r.whitened) and r.identity_error < 1e-6 for r in out)
    assert {r.deviation for r in out if r.vec_id == 1} == {(1 << 63) - 1}
    assert {r.deviation for r in out if r.vec_id == 6} == {64**2 + 128**2}


def test_polarised_squares_are_exact():
    rng = np.random.default_rng(2)
    for most in (100, 1 << 40, 1 << 61):
        x = rng.integers(-most, most, (50, 4))
        n, sums = len(x), [sum(int(v) for v in col) for col in x.T]
        centre = [(2 * s + n) // (2 * n) for s in sums]
        cov = whitening.covariance(whitening.pair_squares(x, centre), n, sums, centre)
        exact = [[float(Fraction(sum((n * int(a) - sums[i]) * (n * int(b) - sums[j]) for a, b in zip(x[:, i], x[:, j], strict=True)), n**3)) for j in range(4)] for i in range(4)]
        assert (cov == np.array(exact)).all()


# lines


def plain_lines(docs):
    """(doc_id, text) to doc_id: (n_lines, n_dropped, kept)."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(A_Z)
    first, many = {}, set()
    for k, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        for x in (text or "").split("\n"):
            if len(key(x)) >= 10 and first.setdefault(key(x), k) != k:
                many.add(key(x))
    out = {}
    for k, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (key(x) in many and first[key(x)] != k)]
        out.setdefault(k, []).append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r.row.doc_id, []).append((r.n_lines, r.n_dropped, r.kept))
    return {k: sorted(v) for k, v in out.items()}


ODD_LINES = [
    (3, "  Repeated LINE here \nown line of three\nrepeated line here"),
    (1, "repeated line here\t\nrepeated line here\nshort\n\n"),
    (2, "repeated line here"),
    (9, "short\n123456789\n1234567890\nÄÄÄÄÄÄÄÄÄÄ"),
    (8, "short\n123456789\n1234567890\nääääääääää\n€€€€€€€€€"),
    (7, "ÄÄÄÄÄÄÄÄÄÄ\n€€€€€€€€€\n repeated line here"),
    (6, None),
    (5, ""),
    (4, "x" * 300_000 + "\nend of a long line"),
    (10, "x" * 300_000 + "\n" + "\n" * 5000 + "END of a long line"),
    (None, "repeated line here\nonly where there is no id"),
    (None, "only where there is no id\nother"),
    (11, "a line of one id\nanother"),
    (11, "a line of one id\nx"),
]


def test_lines_against_plain_version(spark, monkeypatch):
    monkeypatch.setattr(linededup, "GROUP_KEYS", 3)
    table = spark.createDataFrame(ODD_LINES, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("row", "id", "lost", "kept")})
    expected = {k: sorted(v) for k, v in plain_lines(ODD_LINES).items()}
    assert by_id(linededup.deduplicated(table).collect()) == expected
    assert expected[2] == [(1, 1, "")] and expected[None][0][1] == 0
    assert linededup.deduplicated(table.limit(0)).collect() == []


def test_full_filters_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(linededup, "WORD_BITS", 8)
    monkeypatch.setattr(linededup, "MOST_BITS", 8)
    table = spark.createDataFrame(ODD_LINES, "doc_id long, text string")
    assert by_id(linededup.deduplicated(table).collect()) == {k: sorted(v) for k, v in plain_lines(ODD_LINES).items()}


def test_only_suspects_are_shuffled(spark):
    docs = spark.range(2000).select("id", F.concat(F.lit("a line that only document "), F.col("id").cast("string"), F.lit(" has\nthis line is in all documents")).alias("text"))
    found = linededup.suspects(docs, linededup.twice_seen(docs, 4000)).collect()
    assert 2000 <= len(found) < 2010 and len({r.id for r in found}) == 2000


# phrases


def plain_counts(docs):
    out = Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(A_Z)):
            w = re.findall(r"[^\x20\x09]+", piece)
            out.update((lang or "und", tuple(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    return out


def plain_top(docs, least, most):
    f = plain_counts(docs)
    total = Counter()
    for (lang, w), n in f.items():
        total[lang] += n if len(w) == 1 else 0
    good = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    rows = {}
    for (lang, w), a in good.items():
        if any(lang == g and len(x) > len(w) and 100 * b >= 50 * a and any(x[i : i + len(w)] == w for i in range(len(x) - len(w) + 1)) for (g, x), b in good.items()):
            continue
        score, _, l, r = min((10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        rows.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return {(lang, k + 1, p.decode(), -a, l, r, total[lang], -s) for lang, x in rows.items() for k, (s, a, p, l, r) in enumerate(sorted(x)[:most])}


@pytest.mark.parametrize("share", [0.0, 0.02, 0.5, 1.0])
def test_phrases_whatever_the_sample(spark, share):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 60")
    out = phrases.top_phrases(docs, least=4, most=200, share=share)
    assert {tuple(r) for r in out.collect()} == plain_top([(r.lang, r.text) for r in docs.collect()], 4, 200)


def test_phrases_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "GROUP_WORDS", 40)
    monkeypatch.setattr(phrases, "GROUP_BYTES", 30)
    monkeypatch.setattr(phrases, "OUT_ROWS", 3)
    texts = ["a b c. a b C\ta b\nc", None, "", " .,; ", "a b c d! " * 9, "z z z z z z", "É é É é x y", "w" * 100_000 + " end", "one two three " * 400]
    rows = [(k, t, lang) for k, t in enumerate(texts) for lang in ("en", None)] + [(0, texts[0], "en")] * 3 + [(None, texts[4], "und")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit("x") for c in ("id", "phrase", "n", "words")})
    expected = plain_top([(lang, t) for _, t, lang in rows], 3, 50)
    assert {tuple(r) for r in phrases.top_phrases(table, least=3, most=50).collect()} == expected
    assert any(x[2] == "z z z" for x in expected)
    assert phrases.top_phrases(table.limit(0)).collect() == []


def test_full_filters_still_count_everything(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MOST_BITS", 1)
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id between 60 and 90")
    out = phrases.top_phrases(docs, least=4, most=200, share=0.3)
    assert {tuple(r) for r in out.collect()} == plain_top([(r.lang, r.text) for r in docs.collect()], 4, 200)


def test_scores_beyond_64_bits(spark):
    rows = [("x", 1, "a", 4 * 10**12), ("x", 1, "b", 5 * 10**12), ("x", 2, "a b", 3 * 10**12)]
    table = spark.createDataFrame(rows, "lang string, words int, phrase string, n long")
    out = phrases.scored(table, spark.createDataFrame([("x", 9 * 10**12)], "lang string, n long")).collect()
    assert [tuple(r) for r in out] == [("x", "a b", 2, 3 * 10**12, 4 * 10**12, 5 * 10**12, 9 * 10**12, 450_000)]
