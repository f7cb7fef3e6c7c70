"""Rows without a key don't meet in one task, and landed pages don't take a file for each asset."""

import os

import pytest
from pyspark.sql import functions as F

from loam.operators import graph, mapping
from loam.plans import catalog, stored
from loam.sources import landing

SF = "/root/testdata/sf0.001"


@pytest.fixture
def plain_joins(spark):
    """Neither broadcasts nor adaptive splits, as where rows are many."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def largest(df) -> float:
    """The share of the rows that the largest partition holds."""
    n = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    return n[-1] / sum(n)


@pytest.mark.parametrize("name", ["g1_landed_edges", "g7_landed_dependencies"])
def test_landed_sources_are_few_files(spark, tmp_path, monkeypatch, name):
    at = f"file://{tmp_path}/run"
    monkeypatch.setattr(stored, "new_path", lambda _, label: f"{at}/{label}")
    monkeypatch.setattr("loam.sources.shared.shared_dir", lambda _: at)
    assert catalog.queries()[name](spark, SF).count() > 150
    assert sum(len(files) for _, _, files in os.walk(tmp_path / "run")) < 80  # 200 assets


def test_pages_of_a_table_are_those_of_files(spark, tmp_path):
    for k, page in (("d1", '[{"type": "dataset", "inodeId": "i"}]'), ("d2", '{"sources": []}'), ("d3", "{broken"), ("a%20b+c", "[]")):
        (tmp_path / "f" / f"child={k}").mkdir(parents=True)
        (tmp_path / "f" / f"child={k}" / "page.json").write_text(page)
    landing.read_files(spark, f"{tmp_path}/f/child=*").write.parquet(f"{tmp_path}/t")
    found = [landing.read_pages(spark, f"{tmp_path}/f/child=*", landing.SOURCE_KEYS, landing.BY_FOLDER), landing.pages_of(spark.read.parquet(f"{tmp_path}/t"), landing.SOURCE_KEYS, landing.BY_FOLDER)]
    pages = [sorted((r.file, r.asset_id, r.n) for r in p.select("file", "asset_id", F.size("items").alias("n")).collect()) for p, _ in found]
    assert pages[0] == pages[1] and [(a, n) for _, a, n in pages[1]] == [("a%20b+c", 0), ("d1", 1), ("d2", 0)]
    assert [[r.file.split("=")[1] for r in odd.collect()] for _, odd in found] == [["d3/page.json"]] * 2


def test_pages_are_parsed_once(spark, tmp_path, capsys):
    """Pages of sources once in all, however often their list is mentioned; the listing while its table is written."""
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "d1.json").write_text('[{"type": "dataset", "inodeId": "i2"}, {"type": "dataset", "inodeId": "j2"}, {"type": "dataset", "id": "d3"}]')
    (tmp_path / "a.json").write_text('[{"datasetId": "d1", "name": "one"}, {"datasetId": "d2", "inodeId": "i2"}, {"datasetId": "d2", "inodeId": "j2"}, {"datasetId": null, "inodeId": "n"}]')
    (tmp_path / "b.json").write_text('{"entries": [{"datasetId": "d3", "name": "three"}, {"datasetId": "d1", "name": "one"}]}')
    (tmp_path / "t.json").write_text("[]")
    edges = graph.extract_edges(landing.source_listing(landing.read_pages(spark, f"{tmp_path}/s", landing.SOURCE_KEYS, landing.BY_FILE)[0]), "dataset", ["inode_id", "id"], normalise=False)
    out = landing.landed_dependencies(spark, f"{tmp_path}/[ab].json", f"{tmp_path}/t.json", f"{tmp_path}/s", "r", "2001-01-01")
    plans = []
    for df in (edges, out):
        capsys.readouterr()
        df.explain()
        plans.append(capsys.readouterr().out)
    assert plans[0].count("parseJson") == plans[0].count("FileScan text") == 1
    assert plans[1].count("FileScan text") == plans[1].count("t.json") > 0
    assert sorted((r.asset_id, r.parent_id or "", r.n_parents, r.n_children) for r in out.collect()) == [("d1", "d2", 2, 0), ("d1", "d3", 2, 0), ("d2", "", 0, 1), ("d3", "", 0, 1)]


def test_sources_without_an_asset_are_spread(spark, plain_joins):
    dep = spark.range(100).select(F.col("id").alias("asset_id"), F.concat(F.lit("dm_"), F.col("id").cast("string")).alias("target_id"), *(F.lit("x").alias(c) for c in mapping.DETAILS if c not in ("asset_id", "target_id")))
    kind = F.when(F.col("id") % 10 == 0, "dataset").when(F.col("id") % 10 == 1, "data-model").when(F.col("id") % 10 < 8, "table")
    sources = spark.range(0, 4000, 1, 4).select(F.col("id").alias("workbook_id"), kind.alias("source_type"), (F.col("id") % 200).alias("inode_id"), F.concat(F.lit("dm_"), (F.col("id") % 200).cast("string")).alias("data_model_id"))
    sources = sources.withColumns({c: F.when(F.col("workbook_id") % 3 > 0, F.col(c)) for c in ("inode_id", "data_model_id")})
    for aliases in (None, spark.createDataFrame([(5_000, 1), (None, 2)], "alias long, canonical long")):
        out = mapping.classify_sources(sources, *mapping.dependency_lookup(dep), aliases)
        assert out.columns == [*sources.columns, "in_scope", *mapping.DETAILS] and out.count() == 4000
        assert largest(out) < 0.4
        n = out.groupBy("source_type").agg(F.count_if("in_scope").alias("n"), F.count("asset_id").alias("known")).collect()
        expected = {t: sum(1 for i in range(4000) if i % 10 == r and i % 3 and i % 200 < 100) for t, r in (("dataset", 0), ("data-model", 1))}
        assert {r.source_type: r.n for r in n} == {**expected, "table": 0, None: 0} and all(r.n == r.known for r in n)


def test_assets_without_target_or_parent_are_spread(spark, plain_joins):
    assets = spark.range(0, 2000, 1, 4).select(F.col("id").alias("asset_id"), F.col("id").cast("string").alias("name"), F.when(F.col("id") % 10 == 0, F.concat(F.lit("m"), F.col("id").cast("string"))).alias("target_id"))
    targets = assets.filter("asset_id % 20 = 0").select("target_id", F.lit("t").alias("name"))
    edges = spark.createDataFrame([(5, 6), (5, 9_999), (6, 7)], "child long, parent long")
    out = graph.dependency_table(assets, edges, targets, "r", "2001-01-01")
    assert largest(out) < 0.4 and out.count() == 2001
    assert out.filter("target_name = 't'").count() == 100 and out.filter("target_id is not null").count() == 200
    assert sorted((r.asset_id, r.parent_id, r.parent_name) for r in out.filter("parent_id is not null").collect()) == [(5, 6, "6"), (5, 9999, "9999"), (6, 7, "7")]
    assert out.filter("role = 'ROOT' and parent_name is null").count() == 1998


def test_newest_lookups_take_no_sources(spark, monkeypatch):
    """The sources of workbooks have no part in the result of m1_latest_run."""
    def never(*_):
        raise AssertionError

    monkeypatch.setattr(mapping, "classify_sources", never)
    assert catalog.queries()["m1_latest_run"](spark, SF).count() > 200


def test_readers_of_sources_move_what_they_read(spark, plain_joins, tmp_path, capsys):
    """A count by workbook needs the keys of assets and targets alone, however many details there are."""
    path = f"file://{tmp_path}/assets"
    spark.range(20).select(*(F.col("id").cast("string").alias(c) for c in mapping.DETAILS)).write.parquet(path)
    assets = spark.read.parquet(path)
    sources = spark.range(40).select(F.col("id").alias("workbook_id"), F.lit("dataset").alias("source_type"), F.col("id").cast("string").alias("inode_id"), F.lit(None).cast("string").alias("data_model_id"))
    out = mapping.classify_sources(sources, assets, assets)
    assert out.filter("in_scope").count() == 20 and out.filter("in_scope and asset_name = inode_id").count() == 20
    capsys.readouterr()
    out.select("workbook_id", "in_scope").explain()
    plan = capsys.readouterr().out
    assert "asset_id" in plan and "asset_url" not in plan


@pytest.mark.parametrize("name", ["v5_terminal_assets", "v8_repointing_candidates", "v10_graph_nodes", "v11_graph_edges"])
def test_mapped_queries_make_one_dependency_table(spark, monkeypatch, name):
    made, written = [], []
    table, keep = graph.dependency_table, catalog.kept
    monkeypatch.setattr(graph, "dependency_table", lambda *a, **k: made.append(1) or table(*a, **k))
    monkeypatch.setattr(catalog, "kept", lambda *a, **k: written.append(1) or keep(*a, **k))
    assert catalog.queries()[name](spark, SF).count() > 0
    assert len(made) == len(written) == 1


@pytest.mark.parametrize("name, tables", [("v8_latest_runs", {"kept", "details", "summary"}), ("v10_latest_runs", {"kept", "summary"}), ("v11_latest_runs", {"kept", "details"}), ("v11_stale_edges", {"kept", "details"})])
def test_newest_runs_are_found_in_what_is_written(spark, monkeypatch, capsys, name, tables):
    """A run is found without another join of sources and workbooks, and what a query doesn't read is not written."""
    written, keep = {}, stored.kept
    monkeypatch.setattr(stored, "kept", lambda df, label="kept": (written.update({label: df.columns}), keep(df, label))[1])
    out = catalog.queries()[name](spark, SF)
    capsys.readouterr()
    out.explain()
    plan = capsys.readouterr().out
    assert "o_orderkey" not in plan and "l_orderkey" not in plan
    assert set(written) == tables and not {"asset_path", "workbook_path"} & set(written.get("details", []))
