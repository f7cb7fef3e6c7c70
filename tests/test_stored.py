"""Landed pages, logs by folder, tables in buckets, runs and views."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_inventory import LOG, log_row, now

from loam.operators import editlog, graph, overview
from loam.operators.inventory import changed_records, run_inventory, updated_inventory
from loam.plans import catalog
from loam.sources import buckets, landing, listings, runs
from loam.streaming.upserts import stream_latest_edits

SF = "/root/testdata/sf0.001"


def write(folder, pages):
    folder.mkdir(parents=True)
    for name, page in pages.items():
        (folder / name).write_text(page if isinstance(page, str) else json.dumps(page))
    return str(folder)


def test_entries_of_any_shape(spark, tmp_path):
    entries = [
        {"datasetId": "d1", "inodeId": "i1", "name": "one", "path": ["a", "b"], "url": "u", "createdBy": "c", "owner": {"name": "n"}, "migrationStatus": "migrated", "migrationToDataModel": {"dataModelId": "m1", "migratedAt": "2001-02-03T04:05:06.789+02:00", "migratedBy": "x"}},
        {"datasetId": "d2", "path": "a/b", "owner": "o", "migrationToDataModel": None, "new": [1, {"a": 2}]},
        {"datasetId": 3, "name": None, "path": {"odd": 1}, "migrationToDataModel": "m", "inodeId": None},
        {"name": "no id"},
        "text",
        None,
    ]
    path = write(tmp_path / "p", {"a.json": {"total": 6, "entries": entries}, "b.json": [entries[1]], "c.json": "{broken", "d.json": {"rows": []}, "e.json": {"entries": "none", "data": []}})
    pages, odd = landing.read_pages(spark, path)
    found = landing.entries(pages)
    rows = {r.asset_id: r for r in landing.asset_entries(found).collect()}
    assert set(rows) == {"d1", "d2", "3"}
    assert (rows["d1"].path, rows["d1"].owner, rows["d1"].target_id, rows["d1"].migrated_at, rows["d1"].migrated_by) == ("a/b", '{"name":"n"}', "m1", datetime(2001, 2, 3, 4, 5, 6, 789000), "x")
    assert (rows["d2"].path, rows["d2"].owner, rows["d2"].name, rows["d2"].target_id) == ("a/b", "o", None, None)
    assert rows["3"].path == '{"odd":1}' and rows["3"].migrated_at is None
    assert [tuple(r) for r in landing.alias_entries(found).collect()] == [("i1", "d1")]
    assert sorted(os.path.basename(r.file) for r in odd.collect()) == ["c.json", "d.json"]


def test_targets_and_workbooks_of_landed_entries(spark, tmp_path):
    path = write(tmp_path / "p", {"a": {"workbooks": [{"workbookId": "w", "name": "n", "owner": {"name": "a", "email": "e"}, "createdAt": "2001-01-01", "updatedAt": "soon"}]}, "b": {"dataModels": [{"dataModelId": "m", "createdAt": "2001-01-01T00:00:00Z"}]}})
    found = landing.entries(landing.read_pages(spark, path)[0])
    book, model = landing.workbook_entries(found).first(), landing.target_entries(found).first()
    assert (book.workbook_id, book.owner_name, book.owner_email, book.created_at, book.updated_at) == ("w", "a", "e", datetime(2001, 1, 1), None)
    assert (model.target_id, model.created_at) == ("m", datetime(2001, 1, 1))


def test_source_pages_name_their_asset_by_file_or_folder(spark, tmp_path):
    source = {"type": "dataset", "inodeId": "i1"}
    by_file = write(tmp_path / "f", {"a%20b c.json": [source], "d2.json": {"sources": [source, {"type": "table", "inodeId": 5}]}, "d3.json": {"entries": []}, "d4.json": {"error": "not found"}})
    pages, odd = landing.read_pages(spark, by_file, landing.SOURCE_KEYS, landing.BY_FILE)
    rows = {r.workbook_id: r for r in landing.workbook_sources(pages).filter("source_type = 'dataset'").collect()}
    assert set(rows) == {"a%20b c", "d2"} and rows["d2"].inode_id == "i1"
    assert sorted(r.asset_id for r in pages.collect()) == ["a%20b c", "d2", "d3"] and odd.count() == 1
    by_folder = tmp_path / "g"
    for k in (1, 2):
        write(by_folder / f"asset=d{k}", {"page.json": [source]})
    pages, _ = landing.read_pages(spark, str(by_folder / "*"), landing.SOURCE_KEYS, landing.BY_FOLDER)
    assert sorted(map(tuple, graph.extract_edges(landing.source_listing(pages), "dataset", ["inode_id", "id"]).collect())) == [("d1", "i1"), ("d2", "i1")]


def test_from_pages_to_the_dependency_table(spark, tmp_path):
    assets = write(tmp_path / "a", {"1": {"entries": [{"datasetId": "d1", "inodeId": "i1", "migrationToDataModel": {"dataModelId": "m9"}}, {"datasetId": "d2"}]}, "2": [{"datasetId": "d2"}, {"datasetId": "d3", "migrationToDataModel": {"dataModelId": "m1"}}]})
    targets = write(tmp_path / "t", {"1": {"data": [{"dataModelId": "m1", "name": "model"}]}})
    singles = write(tmp_path / "s", {"m9.json": {"dataModelId": "m9", "name": "other's"}, "m8.json": {"dataModelId": "m8", "name": "not wanted"}})
    sources = write(tmp_path / "e", {"d2.json": [{"type": "dataset", "inodeId": "i1"}], "d3.json": {"sources": [{"type": "dataset", "inodeId": None, "id": "d2"}, {"type": "dataset", "id": "gone"}]}, "zz.json": [{"type": "dataset", "id": "d1"}]})
    out = {r.asset_id: r for r in landing.landed_dependencies(spark, assets, targets, sources, "r", "2001-01-01", single_targets=singles).collect()}
    assert {k: (r.role, r.parent_id, r.target_name, r.n_parents, r.n_children) for k, r in out.items()} == {"d1": ("ROOT", None, "other's", 0, 1), "d2": ("INTERNAL", "d1", None, 1, 1), "d3": ("LEAF", "d2", "model", 1, 0)}


def test_listing_pages_keep_their_file_if_asked(spark, tmp_path):
    path = write(tmp_path / "p", {"a.json": [{"id": "1"}]})
    items, _ = listings.read_listing_pages(spark, path, spark.createDataFrame([], "id string").schema, file_col="page")
    assert [(r.id, os.path.basename(r.page)) for r in items.collect()] == [("1", "a.json")]


def test_unchanged_logs_are_not_opened(spark, tmp_path):
    path, names = str(tmp_path / "logs"), ["wal_a", "wal b:1/2", "wal_c%d", "wal_old"]
    rows = spark.createDataFrame([log_row(n, k, "t") for k, n in enumerate(names)], LOG)
    rows.repartition(1).write.partitionBy("log_name").parquet(path)
    for f in (tmp_path / "logs" / "log_name=wal_old").glob("*.parquet"):  # a read of it would fail
        f.write_bytes(b"broken")
    changed = spark.createDataFrame([(n,) for n in (*names[:3], "wal_gone", None)], "log_name string")
    kind = LOG.removeprefix("log_name string, ")
    found = runs.read_logs(spark, path, changed, kind)
    assert sorted((r.log_name, r.edit_num) for r in found.collect()) == sorted((n, k) for k, n in enumerate(names[:3]))
    assert not [f for f in found.inputFiles() if "wal_old" in f] and len(found.inputFiles()) == 3
    with pytest.raises(Exception):  # noqa: B017
        runs.read_logs(spark, path, changed.limit(0).union(spark.createDataFrame([("wal_old",)], "log_name string")), kind).collect()
    assert runs.read_logs(spark, path, changed.limit(0), kind).count() == 0


def times(folder):
    return {f: os.stat(f).st_mtime_ns for f in map(str, folder.rglob("*.parquet"))}


def test_one_changed_row_rewrites_one_bucket(spark, tmp_path):
    table = lambda lo, hi, v: spark.range(lo, hi).select(F.col("id").alias("k"), F.lit("s").alias("s"), F.lit(v).alias("v"))
    path = f"file://{tmp_path}/t"
    buckets.upsert_buckets(spark, path, table(0, 500, "old"), ["k", "s"], 8)
    before = times(tmp_path / "t")
    assert len(before) == 8
    out = buckets.upsert_buckets(spark, path, table(7, 8, "new"), ["k", "s"], 8)
    after = times(tmp_path / "t")
    assert len(after) == 8 and len(set(before.items()) & set(after.items())) == 7
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, runs.merged(table(0, 500, "old"), table(7, 8, "new"), ["k", "s"]).collect()))
    more = spark.createDataFrame([(7, "s", "again"), (900, "s", "added"), (None, "s", "x"), (None, "s", "y")], "k long, s string, v string")
    assert buckets.upsert_buckets(spark, path, more, ["k", "s"], 8).filter("v in ('again', 'added', 'x', 'y')").count() == 4
    assert buckets.upsert_buckets(spark, path, more.limit(0), ["k", "s"], 8).count() == 503
    with pytest.raises(Exception, match="repeat a key"):
        buckets.upsert_buckets(spark, path, more.filter("k = 7").union(more.filter("k = 7")), ["k", "s"], 8)
    assert buckets.read_buckets(spark, path).count() == 503


def test_an_upsert_that_failed_is_finished_or_dropped(spark, tmp_path):
    path, rows = f"file://{tmp_path}/t", lambda *r: spark.createDataFrame(list(r), "k long, v string")
    buckets.upsert_buckets(spark, path, rows((1, "a"), (2, "b")), ["k"], 4)
    # it failed before its rows were whole
    rows((1, "bad")).withColumn(buckets.BUCKET, buckets.bucket_of(["k"], 4)).write.parquet(f"{path}/_pending")
    os.remove(tmp_path / "t" / "_pending" / "_SUCCESS")
    assert sorted(map(tuple, buckets.read_buckets(spark, path).collect())) == [(1, "a"), (2, "b")]
    assert not (tmp_path / "t" / "_pending").exists()
    # it failed while it replaced the folders
    fresh = rows((1, "new"), (2, "b")).withColumn(buckets.BUCKET, buckets.bucket_of(["k"], 4))
    fresh.write.parquet(f"{path}/_pending")
    assert sorted(map(tuple, buckets.upsert_buckets(spark, path, rows((3, "c")), ["k"], 4).collect())) == [(1, "new"), (2, "b"), (3, "c")]
    # the first upsert of all failed
    first = f"file://{tmp_path}/u"
    fresh.write.parquet(f"{first}/_pending")
    os.remove(tmp_path / "u" / "_pending" / "_SUCCESS")
    assert not buckets.has_buckets(spark, first)
    assert buckets.upsert_buckets(spark, first, rows((3, "c")), ["k"], 4).count() == 1


def test_latest_run_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "runs")
    for run, at in (("f9", "2001-07-01"), ("a1", "2001-08-02")):
        runs.append_run(spark.range(3), path, run, at)
    runs.write_snapshot(runs.stamped(spark.range(5), "zz", "2002-01-01"), path)  # a run that never ended
    out = runs.read_latest_run(spark, path)
    assert {(r.run_id, r.created_at) for r in out.collect()} == {("a1", datetime(2001, 8, 2))} and out.count() == 3
    assert runs.read_latest_run(spark, path, "run_id").select("run_id").first().run_id == "f9"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan and "PushedFilters: []" in plan
    runs.append_run(spark.range(1), path, "b1", "2001-01-01", "overwrite")
    assert runs.read_latest_run(spark, path).count() == 1
    with pytest.raises(ValueError):
        runs.read_latest_run(spark, path, "asset_id")


def test_views_answer_in_another_session(spark):
    dep, (_, _, summary, details) = catalog.dep(spark, SF), catalog._mapped(spark, SF)
    for name, df in (("t_dep", dep), ("t_sum", summary), ("t_det", details)):
        older = df.withColumn("created_at", F.col("created_at") - F.expr("interval 1 day")).withColumn("run_id", F.lit("zz"))
        df.unionByName(older.limit(50)).write.mode("overwrite").saveAsTable(name)
    overview.create_views(spark, "t_dep", "t_sum", "t_det", "v_nodes", "v_edges")
    other = spark.newSession()
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(other.table("v_nodes")) == rows(overview.graph_nodes(dep, summary))
    assert rows(other.table("v_edges")) == rows(overview.graph_edges(dep, details))
    for v in ("v_nodes", "v_edges"):
        spark.sql(f"DROP VIEW {v}")
    for t in ("t_dep", "t_sum", "t_det"):
        spark.sql(f"DROP TABLE {t}")


def test_inventory_by_tasks_is_that_of_the_driver(spark, tmp_path):
    for name, n in (("t1", 1), ("t2/day=1", 2), ("t2/day=2", 1)):
        spark.range(10).repartition(n).write.parquet(str(tmp_path / "tables" / name))
    os.makedirs(tmp_path / "tables" / "_hidden")
    path = f"file://{tmp_path}/tables"
    rows = lambda **o: sorted((r.name, r.location.split("/tables/")[1], r.created_at.replace(microsecond=0), r.last_modified.replace(microsecond=0), r.size_bytes) for r in listings.table_inventory(spark, path, **o).collect())
    assert rows(by_tasks=True) == rows() and len(rows()) == 3
    os.makedirs(tmp_path / "none")
    assert listings.table_inventory(spark, f"file://{tmp_path}/none", by_tasks=True).count() == 0


KINDS = {"last_edit_at": "timestamp_ntz", "table_created_at": "timestamp_ntz", "table_modified_at": "timestamp_ntz", "log_modified_at": "timestamp_ntz", "deleted_at": "timestamp_ntz", "size_bytes": "long", "max_edit_num": "long", "is_orphaned": "boolean", "is_deleted": "boolean", "is_legacy": "boolean", "is_tagged": "boolean", "is_archived": "boolean"}
RECORD = ", ".join(f"{c} {KINDS.get(c, 'string')}" for c in editlog.RECORD)


def fold_inputs(spark, rows, log_times, names=("T",)):
    at = datetime(2001, 7, 1)
    logs = spark.createDataFrame(log_times, "log_name string, last_modified timestamp_ntz")
    tables = spark.createDataFrame([(n, "i", "/t", at, at, 7) for n in names], "name string, table_id string, location string, created_at timestamp_ntz, last_modified timestamp_ntz, size_bytes long")
    listing = spark.createDataFrame([], "id string, name string, path string, url string, owner_id string, is_archived boolean")
    tagged = spark.createDataFrame([], "workbook_id string, name string, path string, url string, owner_id string, tags array<struct<tagged_id string, name string>>")
    return rows, logs, tables, listing, listing, tagged, spark.createDataFrame([], "member_id string, first_name string, last_name string"), "s", now()


def test_runs_of_the_fold_write_what_changes(spark, tmp_path):
    path, logs = f"file://{tmp_path}/map", str(tmp_path / "logs")
    spark.createDataFrame([log_row("wal_a", k, f"t{k}") for k in range(40)] + [log_row("wal_b", 1, "u")], LOG).write.partitionBy("log_name").parquet(logs)
    rows = lambda changed: runs.read_logs(spark, logs, changed, LOG.removeprefix("log_name string, "))
    empty, first = spark.createDataFrame([], RECORD), [("wal_a", datetime(2001, 7, 1)), ("wal_b", datetime(2001, 7, 1))]
    out = run_inventory(spark, path, empty, *fold_inputs(spark, rows, first), buckets=8)
    assert out.count() == 41
    before = times(tmp_path / "map")
    spark.createDataFrame([log_row("wal_b", 9, "u")], LOG).write.mode("append").partitionBy("log_name").parquet(logs)
    out = run_inventory(spark, path, empty, *fold_inputs(spark, rows, [first[0], ("wal_b", datetime(2001, 7, 2))]), buckets=8)
    assert {r.table_name: r.max_edit_num for r in out.collect()} == {f"t{k}": k for k in range(40)} | {"u": 9}
    after = times(tmp_path / "map")
    assert len(set(before.items()) & set(after.items())) == len(before) - 1
    out = run_inventory(spark, path, empty, *fold_inputs(spark, rows, [first[0], ("wal_b", datetime(2001, 7, 2))]), buckets=8)
    assert times(tmp_path / "map") == after and out.count() == 41


def test_an_incomplete_list_of_logs_changes_no_stored_flag(spark):
    record = {c: None for c in editlog.RECORD} | {"table_name": "old", "scan_schema": "s", "log_name": "wal_x", "is_orphaned": False, "is_deleted": False, "is_legacy": False, "is_tagged": False}
    inventory = spark.createDataFrame([tuple(record[c] for c in editlog.RECORD)], RECORD)
    inputs = fold_inputs(spark, spark.createDataFrame([log_row("wal_b", 1, "u")], LOG), [("wal_b", datetime(2001, 7, 1))])
    flags = lambda complete: {r.table_name: (r.is_orphaned, r.is_deleted) for r in updated_inventory(inventory, *inputs, complete=complete).collect()}
    assert flags(True) == {"old": (True, True), "u": (True, False)}
    assert flags(False) == {"old": (False, False), "u": (True, False)}
    assert changed_records(inventory, inventory).count() == 0


def test_stream_of_edits_in_buckets(spark, tmp_path):
    source, path = str(tmp_path / "log"), f"file://{tmp_path}/latest"
    for rows in ([log_row("wal_a", 1, "t"), log_row("wal_a", 5, "u")], [log_row("wal_a", 4, "t"), log_row("wal_b", 2, "u")]):
        spark.createDataFrame(rows, LOG).write.mode("append").parquet(source)
        stream_latest_edits(spark.readStream.schema(LOG).parquet(source), path, str(tmp_path / "cp"), buckets=4).awaitTermination(120)
    assert sorted((r.table_name, r.max_edit_num) for r in buckets.read_buckets(spark, path).collect()) == [("t", 4), ("u", 5)]


def test_aliases_as_they_are(spark):
    assets = spark.createDataFrame([("d1", "one"), ("d2", "two")], "asset_id string, name string")
    aliases = spark.createDataFrame([("i1", "d1"), ("i2", "d2"), ("d2", "d2")], "alias string, canonical string")
    nodes = graph.with_aliases(assets, aliases)
    assert sorted(map(tuple, nodes.collect())) == [("d1", "one"), ("d2", "two"), ("i1", "one"), ("i2", "two")]
    edges = spark.createDataFrame([("d2", "i1")], "child string, parent string")
    assert {r.asset_id: r.role for r in graph.graph_roles(edges, nodes).collect()} == {"d1": "ROOT", "d2": "LEAF", "i1": "ROOT", "i2": "ROOT"}
