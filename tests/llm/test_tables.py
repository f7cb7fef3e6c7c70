import gzip
import hashlib
import math
import os
import re

import numpy as np
import pytest
from oracle import assert_same
from pyspark.sql import functions as F

import corpus_pipeline
from loam.llm import queries, shared, topk, urlfilter, warc

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_against_sql(spark, name):
    assert_same(queries.queries()[name], queries.oracle_sql()[name], spark, SF)


# URL filters


def as_regex(glob: str) -> re.Pattern:
    parts = re.split(r"(\*\*|\*|\?)", glob)
    return re.compile("(?s)" + "".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(p, re.escape(p)) for p in parts))


def test_automaton_against_regular_expressions():
    rng = np.random.default_rng(0)
    draw = lambda letters, n: "".join(rng.choice(list(letters), n))
    globs = ["", "*", "**", "a*b**c?", "*.com/en/**", "***"] + [draw("ab/.?*", rng.integers(1, 9)) for _ in range(150)]
    urls = ["", "/", "a/b", "x" * 200] + [draw("ab/.", rng.integers(0, 12)) for _ in range(300)]
    automaton = urlfilter.GlobAutomaton(globs)
    assert automaton.words > 5
    expected = [[bool(as_regex(g).fullmatch(u)) for g in globs] for u in urls]
    assert (automaton.matches([u.encode() for u in urls]) == np.array(expected)).all()


def test_verdicts_of_odd_urls(spark):
    urls = [None, "", "no scheme/en/", "http://COM/en/x", "http://acom/en/x", "http://A.example.com/en/7?x=://b.net/de/", "x://example.net/de/8#f", "https://q.net/de/", "ftp://a.org/?u=.com/en/", "http://www.spam-farm.org", "http://h.org/spam-farm", "http://a.com?/en/", "http://a.com/EN/", "http://a.com/en/" + "y" * 9000, "http://a.com/en/" + "y" * 9000]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string").withColumns({c: F.lit("x") for c in ("host", "path", "rule", "verdict")})
    judge = urlfilter.judged([*(urlfilter.host_rule(*r) for r in queries.HOST_RULES), *(urlfilter.Rule(g, "block") for g in queries.BLOCKED_GLOBS)])
    rows = pages.select(urlfilter.host_of(F.col("url")).alias("h"), urlfilter.path_of(F.col("url")).alias("p"), judge(urlfilter.canonical(F.col("url"))).alias("j")).collect()
    assert [(r.h, r.p[:10]) for r in rows[:6]] == [("", ""), ("", ""), ("", ""), ("com", "/en/x"), ("acom", "/en/x"), ("a.example.com", "/en/7")]
    assert [(r.j.rule, r.j.verdict) for r in rows] == [(None, "allow")] * 3 + [("com/en/", "block"), (None, "allow"), ("example.com/en/7", "allow"), ("example.net/de/8", "block"), ("net/de/", "allow"), (None, "allow"), ("*spam-farm**", "block"), (None, "allow"), (None, "allow"), (None, "allow"), ("com/en/", "block"), ("com/en/", "block")]
    assert pages.limit(0).select(judge(urlfilter.canonical(F.col("url")))).count() == 0


# top k


def test_top_k_with_ties_bad_vectors_and_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 7)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "FAN", 2)
    rng = np.random.default_rng(0)
    rows = [(k, rng.integers(-2, 3, 4).astype(float).tolist()) for k in range(120)]
    rows += [(200, None), (201, [1.0, None, 1.0, 1.0]), (202, [math.nan] * 4), (203, [math.inf] * 4), (204, [1.0, 2.0]), (210, [3.0, 1.0]), (220, []), (221, []), (230, [1e30, -2.0**70, 0.5]), (231, [1e30, 1.0, 1.0]), (232, [-1.0, 2.0, 3.0]), (5, [2.0] * 4), (None, [1.0] * 4)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("id", "shard", "block", "dim", "v", "w", "score")})
    out = topk.exact_top_k(table, table.filter("vec_id % 10 = 0"), k=6).collect()
    held = lambda x: max(-(2**63) + 1, min(2**63 - 1, x))
    usable = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = []
    for q, v in usable:
        if q % 10 == 0:
            scores = sorted((-held(sum(a * b for a, b in zip(v, w, strict=True))), i) for i, w in usable if i != q and len(w) == len(v))[:6]
            expected += [(q, k, i, -s) for k, (s, i) in enumerate(scores, 1)]
    assert sorted(map(tuple, out)) == sorted(expected)
    assert topk.exact_top_k(table.limit(0), table).count() == topk.exact_top_k(table, table.limit(0)).count() == 0


def test_large_components_stay_exact():
    q = np.array([[3_000_000_019.0, 7]])
    q_id, i, s = topk.tile_top_k(q, np.array([1]), np.array([[1_000_000_011.0, 1], [1_000_000_011, 2], [5, 5]]), np.array([9, 8, 7]), 2)
    assert list(zip(i.tolist(), s.tolist(), strict=True)) == [(8, 3_000_000_019 * 1_000_000_011 + 14), (9, 3_000_000_019 * 1_000_000_011 + 7)]


def test_tiles_of_long_vectors_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_BYTES", 1 << 20)
    rng = np.random.default_rng(1)
    vectors = rng.integers(-3, 4, (300, 4096)) / 1024
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    out = topk.exact_top_k(table, table.filter("vec_id % 100 = 0"), k=3)
    whole = np.floor(vectors * 1024)
    scores = whole[::100] @ whole.T
    for r in out.collect():
        own = sorted((-s, i) for i, s in enumerate(scores[r.query_id // 100]) if i != r.query_id)
        assert (-r.score, r.id) == own[r.rank - 1]
    assert out.count() == 9


# WARC


def pages_of(spark):
    big = "<p>" + "x" * 2000
    rows = [(1, "http://a/é x\r\nX: y", "<p>é"), (2, None, None), (3, "u", big), (9, "u", big), (4, "v", big), (9, "u", big), (5, "", "small"), (6, "w", "small"), (None, "n", big + "n"), (7, "z", "\r\n\r\nWARC/1.1\r\n"), (8, "long", "y" * 300_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("payload", "digest", "shard", "bin", "refers_to")}), rows


def test_archives_round_trip_and_are_the_same_bytes_again(spark):
    pages, rows = pages_of(spark)
    folders = [shared.new_path(spark, "warc") for _ in range(2)]
    manifests = [warc.write_archives(p, f, shard_bytes=3000, roll_bytes=700).toPandas().sort_values("file").reset_index(drop=True) for p, f in zip((pages, pages.repartition(3)), folders, strict=True)]
    assert len(manifests[0]) > 3 and manifests[0].equals(manifests[1])
    got = sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(spark, folders[0]).collect())
    expected = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        top = max((p for p, _, h in rows if h == html and p is not None), default=None) if len(raw) >= 1000 else None
        refers = top if top is not None and page_id != top else None
        expected.append((page_id is None, page_id or 0, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if refers else "response", refers))
    assert got == sorted(expected)
    assert {r.page_id: r.url for r in warc.read_archives(spark, folders[0]).collect()}[1] == "http://a/%C3%A9%20x%0D%0AX:%20y"
    data = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folders[0]).first().content
    assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_record_ids_are_unique_and_revisits_refer(spark):
    folder = shared.new_path(spark, "warc")
    warc.write_archives(pages_of(spark)[0], folder)
    text = b"".join(gzip.decompress(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).collect())
    ids = re.findall(rb"WARC-Record-ID: (\S+)", text)
    refers = set(re.findall(rb"WARC-Refers-To: (\S+)", text))
    assert len(set(ids)) == len(ids) == 11 and len(refers) == 1 and refers <= set(ids)


def test_half_of_the_pages_alike_and_a_refused_rename(spark, tmp_path, monkeypatch):
    big = "<p>" + "same words " * 300
    pages = spark.createDataFrame([(k, f"http://h/{k}", big if k % 2 else f"<p>page {k}") for k in range(400)], "page_id long, url string, html string")
    first = warc.write_archives(pages, f"file://{tmp_path}/a", shard_bytes=60_000, roll_bytes=3000).toPandas()
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_archives(spark, f"file://{tmp_path}/a").collect()}
    assert got == {k: ("revisit", 399) if k % 2 and k < 399 else ("response", None) for k in range(400)}
    # another attempt finds all names taken, and its renames refused
    roll = warc._Roll(f"file://{tmp_path}/b", 0, 1 << 20)

    class Refusing:
        def __getattr__(self, name):
            return getattr(roll_fs, name)

        def move(self, source, target):
            if os.path.exists(target):
                raise OSError("exists")
            roll_fs.move(source, target)

    roll_fs, roll.fs = roll.fs, Refusing()
    names = []
    for _ in range(2):
        roll.number = 0
        assert not list(roll.add(1, b"bytes"))
        names += [x[0] for x in roll.close()]
    assert names[0] == names[1] and os.listdir(f"{tmp_path}/b/_temporary") == [] and len(first) > 3


def test_archives_of_no_pages(spark):
    folder = shared.new_path(spark, "warc")
    assert warc.write_archives(pages_of(spark)[0].limit(0), folder).count() == 0
    assert warc.read_archives(spark, folder).count() == 0


def test_damaged_archives_are_refused():
    good = warc.gzip_member(warc.record(1, "u", b"hello", hashlib.sha1(b"hello").hexdigest(), None))
    assert next(warc.parsed(good))[:4] == (1, 5, hashlib.sha1(b"hello").hexdigest(), "response")
    bad = warc.gzip_member(gzip.decompress(good).replace(b"hello", b"hallo"))
    with pytest.raises(ValueError, match="digest"):
        list(warc.parsed(bad))
    with pytest.raises(ValueError, match="ends within"):
        list(warc.parsed(good[:-3]))


# pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, kept, SF)
        assert out.columns[: len(docs.columns)] == docs.columns and (k == 3 or len(out.columns) == len(docs.columns))
        path = shared.new_path(spark, "test-stage")
        out.write.parquet(path)
        kept = spark.read.parquet(path)
        if k == 0:
            assert kept.count() >= 0.98 * docs.count()
        if k == 1:
            assert kept.select("doc_id").distinct().count() == kept.count() and kept.select("text").distinct().count() == kept.count()
    assert kept.filter("ids is null or n_tokens = 0").count() == 0
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, kept.collect()))


def test_pipeline_with_nulls_and_an_extra_column(spark, tmp_path):
    rows = [(None, None, None, None, None, 1), (1, "the cat sat on the mat", "en", "a", 22, 2), (2, "", "en", None, 0, 3), (1, "the cat sat on the mat", "en", "a", 22, 4), (3, "der hund ist in dem haus", "de", None, 24, 5)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids int").withColumns({c: F.lit("x") for c in ("node", "row", "N_Tokens", "copies", "lang_", "size")}).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} <= {1, 3}
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
