import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loam.operators import editlog, mapping, overview, reports, scoring
from loam.operators.inventory import updated_inventory
from loam.sources import listings, runs
from loam.streaming.upserts import stream_latest_edits

def now():
    return F.lit("2001-08-02").cast("timestamp_ntz")


LOG = "log_name string, edit_num long, ds_id long, ts timestamp_ntz, metadata string, edit string"
MAP = "table_name string, scan_schema string, log_name string, is_deleted boolean, deleted_at timestamp_ntz, is_orphaned boolean"
SCORE = "table_name string, scan_schema string, workbook_name string, owner_first_name string, owner_last_name string, is_archived boolean, is_orphaned boolean, is_deleted boolean, is_legacy boolean, is_tagged boolean, version_tag string, max_edit_num long, size_bytes long, workbook_url string, last_edit_at timestamp_ntz, table_modified_at timestamp_ntz, last_edit_by string"


def log_row(log, n, table, **more):
    return log, n, 1, datetime(2001, 1, 1), json.dumps({"tableName": table, **more}), None


def test_latest_edit_and_ties_across_logs(spark):
    rows = [log_row("wal_b", 3, "t"), log_row("wal_b", 2, "t"), log_row("wal_a", 3, "t"), log_row("wal_c", None, "u"), log_row("wal_d", 0, "u"), ("wal_d", 9, 1, None, '{"x":1}', None)]
    latest = editlog.latest_edit_per_table(spark.createDataFrame(rows, LOG))
    assert latest.count() == 4
    one = editlog.dedup_across_logs(latest).select("table_name", "log_name").collect()
    assert sorted(map(tuple, one)) == [("t", "wal_a"), ("u", "wal_c")]


def test_deletion_flags_set_keep_and_clear(spark):
    then = datetime(2001, 5, 5)
    rows = [("a", "s", "gone", False, None, False), ("b", "s", "gone", True, then, False), ("c", "s", "back", True, then, False), ("d", "s", "here", None, None, False), ("e", "other", "gone", False, None, False), ("f", "s", None, False, None, False)]
    inventory = spark.createDataFrame(rows, MAP)
    logs = spark.createDataFrame([("back",), ("here",)], "log_name string")
    out = {r.table_name: (r.is_deleted, r.deleted_at) for r in editlog.deletion_flags(inventory, logs, "s", now()).collect()}
    assert out == {"a": (True, datetime(2001, 8, 2)), "b": (True, then), "c": (False, None), "d": (None, None), "e": (False, None), "f": (False, None)}
    assert editlog.deletion_flags(inventory, logs, "s", now(), complete=False) is inventory


def test_orphan_changes_ignore_case_and_the_batch(spark):
    rows = [("a", "s", "l", None, None, False), ("b", "s", "l", None, None, True), ("c", "s", "l", None, None, None), ("d", "other", "l", None, None, False), ("e", "s", "l", None, None, False)]
    tables, batch = spark.createDataFrame([("B",), ("x",)], "name string"), spark.createDataFrame([("e",)], "table_name string")
    out = editlog.orphan_changes(spark.createDataFrame(rows, MAP), tables, batch, "s")
    assert sorted(map(tuple, out.collect())) == [("a", True), ("b", False), ("c", True)]


def test_infer_id_column_prefers_first_of_ties(spark):
    df = spark.createDataFrame([("1", " X ", "x"), ("2", "y", "y")], "id string, aId string, bId string")
    ids = spark.createDataFrame([("X",), ("Y",)], "id string")
    assert tuple(editlog.infer_id_column(df, ids).first()) == ("aId", 2)
    assert tuple(editlog.infer_id_column(df.limit(0), ids).first()) == ("id", 0)


def test_scores_of_nulls_and_bounds(spark):
    day = datetime(2001, 8, 2)
    base = dict(table_name="t", scan_schema="s", workbook_name="w", owner_first_name=None, owner_last_name="L", is_archived=False, is_orphaned=False, is_deleted=False, is_legacy=False, is_tagged=False, version_tag=None, max_edit_num=500, size_bytes=1, workbook_url=None, last_edit_at=day, table_modified_at=day, last_edit_by=None)
    cases = [({}, 1), (dict(is_orphaned=True), 31), (dict(is_orphaned=None, is_deleted=True), 1), (dict(is_archived=None, workbook_name=None), 16), (dict(is_tagged=True), 0), (dict(last_edit_at=None, table_modified_at=None, max_edit_num=None), 51), (dict(is_legacy=True, last_edit_at=datetime(2001, 7, 1)), 15), (dict(size_bytes=(1 << 30) + 1), 10), (dict(max_edit_num=10), 9)]
    rows = [tuple({**base, **c, "table_name": str(k)}.values()) for k, (c, _) in enumerate(cases)]
    out = {r.table_name: (r.total_score, r.owner) for r in scoring.archival_score(spark.createDataFrame(rows, SCORE), now()).collect()}
    assert out == {str(k): (score, "L") for k, (_, score) in enumerate(cases)}


def test_stale_active_at_thirty_days(spark):
    rows = [("t%d" % k, "s", "w", "F", None, False, False, False, False, False, None, 1, 1, None, t, None, None) for k, t in enumerate([datetime(2001, 7, 3), datetime(2001, 7, 2, 23), None])]
    out = reports.stale_active(spark.createDataFrame(rows, SCORE), now())
    assert {(r.table_name, r.days_since_edit, r.inactivity_band) for r in out.collect()} == {("t1", 30, "31–90 days"), ("t2", None, ">365 days")}


def test_upsert_versions(spark, tmp_path):
    path = str(tmp_path / "map")
    rows = lambda *r: spark.createDataFrame(r, "k string, s string, v long")
    runs.upsert(spark, path, rows(("a", "1", 1), ("b", "1", 1)), ["k", "s"])
    again = rows(("b", "1", 2), ("c", "1", 2), (None, "1", 3), (None, "1", 4))
    out = runs.upsert(spark, path, again, ["k", "s"])
    assert sorted(map(tuple, out.collect()), key=str) == [("a", "1", 1), ("b", "1", 2), ("c", "1", 2), (None, "1", 3), (None, "1", 4)]
    assert runs.versions(spark, path) == [0, 1] and runs.read_version(spark, path, 0).count() == 2
    with pytest.raises(Exception, match="repeat a key"):
        runs.upsert(spark, path, rows(("a", "1", 5), ("a", "1", 6)), ["k", "s"])
    assert runs.versions(spark, path) == [0, 1]  # a failed one is never read


def test_snapshots_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "runs")
    for run, mode in (("r1", "append"), ("r2", "append"), ("r3", "overwrite")):
        runs.write_snapshot(runs.stamped(spark.range(2), run, "2001-01-01"), path, mode)
        if run == "r2":
            assert spark.read.parquet(path).count() == 4
    assert [r.run_id for r in spark.read.parquet(path).select("run_id").distinct().collect()] == ["r3"]
    with pytest.raises(ValueError):
        runs.write_snapshot(spark.range(1), path, "ignore")


def test_listing_pages_and_table_inventory(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    for name, page in {"a": {"data": [{"id": "1"}]}, "b": [{"id": "2"}, {"id": "3"}], "c": {"other": []}, "d": {"entries": [{"id": "4"}], "data": [{"id": "5"}]}}.items():
        (pages / f"{name}.json").write_text(json.dumps(page, indent=1))
    items, odd = listings.read_listing_pages(spark, str(pages), T.StructType([T.StructField("id", T.StringType())]))
    assert sorted(r.id for r in items.collect()) == ["1", "2", "3", "4"]
    assert [r.file.rsplit("/", 1)[1] for r in odd.collect()] == ["c.json"]
    spark.range(10).repartition(2).write.parquet(str(tmp_path / "tables/t1"))
    row = listings.table_inventory(spark, str(tmp_path / "tables")).first()
    assert row.name == "t1" and row.size_bytes > 0 and row.created_at <= row.last_modified


def test_stream_of_edits(spark, tmp_path):
    source, path = str(tmp_path / "log"), str(tmp_path / "latest")
    for rows in ([log_row("wal_a", 1, "t"), log_row("wal_a", 5, "u")], [log_row("wal_a", 4, "t"), log_row("wal_b", 2, "u")]):
        spark.createDataFrame(rows, LOG).write.mode("append").parquet(source)
        stream_latest_edits(spark.readStream.schema(LOG).parquet(source), path, str(tmp_path / "cp")).awaitTermination(120)
    assert sorted((r.table_name, r.max_edit_num) for r in runs.read_version(spark, path).collect()) == [("t", 4), ("u", 5)]


def test_ids_without_any_enrichment_are_tried_again(spark):
    names = ", ".join(f"{c} {'boolean' if c.startswith('is_') else 'string'}" for c in ("workbook_id", *editlog.ENRICHMENT))
    empty = (None,) * (len(editlog.ENRICHMENT) - 1)
    stored = spark.createDataFrame([("known", "name", *empty), ("bare", None, *empty), (None, "name", *empty)], names)
    records = spark.createDataFrame([("known",), ("bare",), ("new",), ("new",), (None,)], "workbook_id string")
    assert sorted(r.workbook_id for r in editlog.ids_to_enrich(records, stored).collect()) == ["bare", "new"]
    assert [r.workbook_id for r in editlog.ids_to_enrich(records, stored, retry_empty=False).collect()] == ["new"]


def test_sources_in_scope_and_status(spark):
    names = ", ".join(f"{c} {'long' if c in ('n_parents', 'n_children') else 'string'}" for c in mapping.DETAILS)
    dep = spark.createDataFrame([("d1", *[None] * 7, "m1", *[None] * 5), ("d0", *[None] * 7, "m1", *[None] * 5)], names)
    assets, targets = mapping.dependency_lookup(dep)
    assert targets.first().asset_id == "d0"
    rows = [("w1", "dataset", "i1", None), ("w1", "data-model", None, "m1"), ("w2", "table", None, None), ("w3", "data-model", None, "m1"), ("w4", "dataset", "zz", None)]
    sources = spark.createDataFrame(rows, "workbook_id string, source_type string, inode_id string, data_model_id string")
    alias = spark.createDataFrame([("i1", "d1")], "alias string, canonical string")
    books = spark.createDataFrame([(f"w{k}",) + (None,) * 7 for k in range(1, 5)], "workbook_id string, name string, url string, path string, owner_name string, owner_email string, created_at string, updated_at string")
    out = mapping.asset_summary(mapping.classify_sources(sources, assets, targets, alias), books, "r", "2001-01-01")
    assert {(r.workbook_id, r.migration_status) for r in out.collect()} == {("w1", "PARTIALLY MIGRATED"), ("w3", "FULLY MIGRATED")}


def test_a_version_left_by_a_failed_write_is_passed_over(spark, tmp_path):
    path, rows = f"file://{tmp_path}/t", lambda *r: spark.createDataFrame(list(r), "k long, v string")
    runs.upsert(spark, path, rows((1, "a"), (2, "b")), ["k"])
    (tmp_path / "t" / "v=1" / "_temporary").mkdir(parents=True)  # no _SUCCESS in it
    out = runs.upsert(spark, path, rows((2, "c")), ["k"])
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "c")]
    assert runs.versions(spark, path) == [0, 2] and runs.versions(spark, path, complete=False) == [0, 1, 2]


def test_a_run_of_the_fold(spark):
    at = datetime(2001, 7, 1)
    record = {c: None for c in editlog.RECORD} | {"scan_schema": "s", "is_orphaned": False, "is_deleted": False, "is_legacy": False, "is_tagged": False}
    kinds = {"last_edit_at": "timestamp_ntz", "table_created_at": "timestamp_ntz", "table_modified_at": "timestamp_ntz", "log_modified_at": "timestamp_ntz", "deleted_at": "timestamp_ntz", "size_bytes": "long", "max_edit_num": "long", "is_orphaned": "boolean", "is_deleted": "boolean", "is_legacy": "boolean", "is_tagged": "boolean", "is_archived": "boolean"}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in editlog.RECORD)
    stored = [record | x for x in (
        {"table_name": "old", "log_name": "wal_a", "log_modified_at": at, "max_edit_num": 1, "workbook_id": "w1", "is_archived": False},  # its log is as it was, its table gone
        {"table_name": "t", "log_name": "wal_b", "log_modified_at": datetime(2001, 1, 1), "max_edit_num": 1, "workbook_id": "w2"},  # has new edits
        {"table_name": "lost", "log_name": "wal_gone", "log_modified_at": at},  # its log is gone
        {"table_name": "old", "log_name": "wal_a", "scan_schema": "other"})]
    inventory = spark.createDataFrame([tuple(r[c] for c in editlog.RECORD) for r in stored], schema)
    rows = spark.createDataFrame([log_row("wal_a", 9, "old"), log_row("wal_b", 5, "t", workbookId="w2", page="https://h/o/w"), log_row("wal_b", 6, "new", workbookId="w3")], LOG)
    logs = spark.createDataFrame([("wal_a", at), ("wal_b", at)], "log_name string, last_modified timestamp_ntz")
    tables = spark.createDataFrame([(n, "i", "/t", at, at, 7) for n in ("T", "NEW", "LOST")], "name string, table_id string, location string, created_at timestamp_ntz, last_modified timestamp_ntz, size_bytes long")
    books = spark.createDataFrame([("w1", "one", "p", "u", "m", True), ("W2", "two", "p", "u", "m", None)], "id string, name string, path string, url string, owner_id string, is_archived boolean")
    models = spark.createDataFrame([("w3", "model", "p", "u", "m")], "id string, name string, path string, url string, owner_id string")
    tagged = spark.createDataFrame([], "workbook_id string, name string, path string, url string, owner_id string, tags array<struct<tagged_id string, name string>>")
    members = spark.createDataFrame([("M", "Ann", "Bo")], "member_id string, first_name string, last_name string")
    out = {(r.table_name, r.scan_schema): r for r in updated_inventory(inventory, rows, logs, tables, books, models, tagged, members, "s", now(), url_keys=("page",)).collect()}
    assert set(out) == {("old", "s"), ("t", "s"), ("new", "s"), ("lost", "s"), ("old", "other")}
    assert out["old", "s"].max_edit_num == 1 and out["old", "s"].is_orphaned and out["old", "s"].is_archived and not out["old", "other"].is_orphaned
    assert (out["t", "s"].max_edit_num, out["t", "s"].workbook_name, out["t", "s"].workbook_url, out["t", "s"].owner_first_name, out["t", "s"].size_bytes) == (5, "two", "https://h/o/w", "Ann", 7)
    assert out["new", "s"].object_type == "DATA_MODEL" and out["lost", "s"].is_deleted and not out["lost", "s"].is_orphaned and out["lost", "s"].deleted_at == datetime(2001, 8, 2)


def test_tables_that_the_catalog_lists(spark):
    spark.range(1).createOrReplaceTempView("wal_view")
    spark.range(1).write.mode("overwrite").saveAsTable("wal_table")
    assert [r.log_name for r in editlog.discover_logs(listings.catalog_tables(spark, "default")).collect()] == ["wal_table"]
    spark.sql("DROP TABLE wal_table")


def test_views_for_drawing(spark):
    from loam.plans import catalog

    dep, (_, _, summary, details) = catalog.dep(spark, "/root/testdata/sf0.001"), catalog._mapped(spark, "/root/testdata/sf0.001")
    overview.register_views(dep, summary, details, "n", "e")
    assert spark.sql("select * from e left anti join n on source = node_id").count() == 0 < spark.table("n").count()
