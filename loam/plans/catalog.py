"""Registered queries of the catalog operators over tables derived from the given ones, and their SQL."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.functions.columns import legacy_flag, normalise_type, org_slug
from loam.operators import chains, crossover, editlog, graph, mapping, overview, reports, scoring
from loam.plans import catalog_sql, stored
from loam.plans.fixtures import SCHEMA, as_of, view
from loam.sources.runs import latest_run, merged, write_snapshot
from loam.sources.listings import read_listing_pages, table_inventory
from loam.sources.shared import kept, new_path

__all__ = ["oracle_sql", "queries"]


def full_dep(spark: SparkSession, d: str) -> DataFrame:
    """Two runs, the older of which has the larger run id."""
    v = partial(view, spark, d)
    now = graph.dependency_table(v("fx_asset"), v("fx_edge"), v("fx_target"), "a1", "2001-08-02")
    run = lambda i, t: F.struct(F.lit(i).alias("run_id"), F.lit(t).cast("timestamp_ntz").alias("created_at"))
    both = F.when(F.col("asset_id") % 2 == 0, F.array(run("a1", "2001-08-02"), run("f9", "2001-07-01"))).otherwise(F.array(run("a1", "2001-08-02")))
    rest = [c for c in now.columns if c not in ("run_id", "created_at")]
    return now.select(F.explode(both).alias("run"), *rest).select("run.*", *rest)


def dep(spark: SparkSession, d: str) -> DataFrame:
    """The current run. Built alone, since its rows are known; latest_run has a query of its own."""
    v = partial(view, spark, d)
    return graph.dependency_table(v("fx_asset"), v("fx_edge"), v("fx_target"), "a1", "2001-08-02")


def kept_dep(spark: SparkSession, d: str) -> DataFrame:
    """dep(), computed once for queries that join it with itself."""
    return kept(dep(spark, d))


def aliased_listing(v) -> DataFrame:
    """Each asset with its sources, their types spelled in three ways, by alias ids for every third parent."""
    kind = F.when(F.col("parent") % 3 == 0, "Data_Set").when(F.col("parent") % 3 == 1, "data set").otherwise("data-set")
    s = F.struct(kind.alias("type"), F.when(F.col("parent") % 3 == 0, F.concat(F.lit("i_"), F.col("parent").cast("string"))).alias("inode_id"), F.col("parent").cast("string").alias("asset_id"))
    noise = F.struct(F.lit("table").alias("type"), F.lit(None).cast("string").alias("inode_id"), F.lit("t").alias("asset_id"))
    return v("fx_edge").groupBy(F.col("child").cast("string").alias("asset_id")).agg(F.array_append(F.collect_list(s), noise).alias("sources"))


def g1_extract_edges(spark: SparkSession, d: str) -> DataFrame:
    v = partial(view, spark, d)
    known = v("fx_asset").select(F.col("asset_id").cast("string")).union(v("fx_asset").select(F.concat(F.lit("i_"), F.col("asset_id").cast("string"))))
    return graph.extract_edges(aliased_listing(v), "data-set", ["inode_id", "asset_id"], known=known)


def g2_normalise_type(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "fx_source").select(F.concat_ws("_", F.upper("source_type"), F.lit("x y")).alias("raw"))
    return rows.groupBy("raw").agg(F.count("*").alias("n")).select("raw", normalise_type(F.col("raw")).alias("kind"), "n")


def g3_resolve_aliases(spark: SparkSession, d: str) -> DataFrame:
    v = partial(view, spark, d)
    edges = v("fx_edge").select(F.concat(F.lit("i_"), F.col("child").cast("string")).alias("child"), F.col("parent").cast("string").alias("parent"))
    ids = v("fx_asset").select(F.concat(F.lit("i_"), F.col("asset_id").cast("string")).alias("alias"), F.col("asset_id").cast("string").alias("canonical"))
    return graph.resolve_aliases(edges, ids)


def g4_complete_missing(spark: SparkSession, d: str) -> DataFrame:
    v = partial(view, spark, d)
    assets = v("fx_asset").filter("asset_id % 5 <> 0").select("asset_id", "name", "status")
    metadata = v("fx_asset").filter("asset_id % 10 = 0").select("asset_id", "name")
    return graph.complete_missing(assets, v("fx_edge").select(F.col("parent").alias("asset_id")), metadata)


def g5_degrees(spark: SparkSession, d: str) -> DataFrame:
    return graph.degrees(view(spark, d, "fx_edge"), view(spark, d, "fx_asset"))


def g6_graph_role(spark: SparkSession, d: str) -> DataFrame:
    return graph.graph_roles(view(spark, d, "fx_edge"), view(spark, d, "fx_asset")).select("asset_id", "role")


def g7_dependency_table(spark: SparkSession, d: str) -> DataFrame:
    cols = ["run_id", "created_at", "role", "asset_id", "asset_name", "asset_path", "asset_url", "status", "migrated_at", "target_id", "target_name", "target_url", "parent_id", "parent_name", "parent_status", "n_parents", "n_children"]
    return full_dep(spark, d).select(*cols)


def g8_build_summary(spark: SparkSession, d: str) -> DataFrame:
    return graph.build_summary(dep(spark, d))


def g9_write_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Two runs, appended one after the other and read back."""
    rows, path = full_dep(spark, d).select("run_id", "role", "asset_id", "parent_id", "status"), new_path(spark, "snapshots")
    for run in ("f9", "a1"):
        write_snapshot(rows.filter(F.col("run_id") == run), path)
    return spark.read.parquet(path).select(*rows.columns)


def g10_latest_run(spark: SparkSession, d: str) -> DataFrame:
    by_time, by_id = (latest_run(full_dep(spark, d), by) for by in ("created_at", "run_id"))
    n = lambda df, name: df.groupBy("run_id").agg(F.count("*").alias("n")).withColumn("by", F.lit(name))
    return n(by_time, "created_at").unionByName(n(by_id, "run_id"))


def _mapped(spark: SparkSession, d: str, now: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(workbooks, classified, summary, details). now: kept_dep(), where the query itself reads it as well."""
    v = partial(view, spark, d)
    books = v("fx_workbook")
    classified = mapping.classify_sources(v("fx_source"), *mapping.dependency_lookup(kept_dep(spark, d) if now is None else now))
    return books, classified, mapping.asset_summary(classified, books, "a1", "2001-08-02"), mapping.source_details(classified, books, "a1", "2001-08-02")


def m1_dependency_lookup(spark: SparkSession, d: str) -> DataFrame:
    assets, targets = mapping.dependency_lookup(dep(spark, d))
    a = assets.select(F.lit("asset").alias("side"), F.col("asset_id").cast("string").alias("key"), "asset_id", "role", "target_id")
    return a.unionByName(targets.select(F.lit("target").alias("side"), F.col("target_id").alias("key"), "asset_id", "role", "target_id"))


def m2_classify_sources(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d)[1].groupBy("source_type", "in_scope").agg(F.count("*").alias("n"), F.count("asset_id").alias("known"))


def m3_source_details(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d)[3].select("run_id", "workbook_id", "workbook_name", "inode_id", "data_model_id", "source_type", "asset_id", "asset_name", "status", "role", "target_id", "n_parents", "n_children")


def m4_asset_summary(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d)[2].select("run_id", "workbook_id", "workbook_name", "owner_name", "total_sources", "dataset_sources", "data_model_sources", "table_sources", "migration_status")


def m5_mapping_summary(spark: SparkSession, d: str) -> DataFrame:
    books, _, summary, details = _mapped(spark, d)
    return mapping.mapping_summary(books, summary, details)


def c1_walk_chains(spark: SparkSession, d: str) -> DataFrame:
    out = chains.walk_chains(kept_dep(spark, d))
    return out.select("asset_id", "role", "depth", F.array_join(F.transform("chain", lambda x: x["asset_id"].cast("string")), ">").alias("ids"))



def c2_dataset_chains(spark: SparkSession, d: str) -> DataFrame:
    """Complete paths, pivoted, with path text, length and status (C2, C4, C5, C6)."""
    out = chains.dataset_chains(kept_dep(spark, d))
    return out.select(*(f"L{k}_{f}" for k in range(5) for f in ("asset_id", "asset_name", "status")), "chain_path", "chain_length", "chain_status")


def c3_model_chains(spark: SparkSession, d: str) -> DataFrame:
    """Terminal chains, pivoted (C3, C4)."""
    out = chains.model_chains(kept_dep(spark, d))
    return out.select("L0_asset_id", "L0_asset_name", "L0_asset_path", "L0_asset_url", *(f"L{k}_{f}" for k in range(1, 5) for f in ("asset_id", "asset_name")), "chain_length")


def x1_fork_points(spark: SparkSession, d: str) -> DataFrame:
    return crossover.fork_points(kept_dep(spark, d))


def x2_merge_points(spark: SparkSession, d: str) -> DataFrame:
    return crossover.merge_points(kept_dep(spark, d))


def x3_fork_points_simple(spark: SparkSession, d: str) -> DataFrame:
    return crossover.fork_points_simple(dep(spark, d))


def x4_merge_points_simple(spark: SparkSession, d: str) -> DataFrame:
    return crossover.merge_points_simple(dep(spark, d))


def v1_model_overview(spark: SparkSession, d: str) -> DataFrame:
    return overview.model_overview(dep(spark, d))


def v2_leaf_assets(spark: SparkSession, d: str) -> DataFrame:
    return overview.leaf_assets(dep(spark, d))


def v3_migration_progress(spark: SparkSession, d: str) -> DataFrame:
    return overview.migration_progress(dep(spark, d))


def v4_asset_migration_summary(spark: SparkSession, d: str) -> DataFrame:
    return overview.asset_migration_summary(_mapped(spark, d)[2])


def v5_terminal_assets(spark: SparkSession, d: str) -> DataFrame:
    now = kept_dep(spark, d)
    return overview.terminal_assets(now, _mapped(spark, d, now)[3])


def v6_child_ahead_of_parent(spark: SparkSession, d: str) -> DataFrame:
    return overview.child_ahead_of_parent(dep(spark, d))


def v7_blocking_assets(spark: SparkSession, d: str) -> DataFrame:
    return overview.blocking_assets(dep(spark, d))


def v8_repointing_candidates(spark: SparkSession, d: str) -> DataFrame:
    _, _, summary, details = _mapped(spark, d)
    return overview.repointing_candidates(details, summary)


def v9_readiness_pipeline(spark: SparkSession, d: str) -> DataFrame:
    return overview.readiness_pipeline(dep(spark, d))


def v10_graph_nodes(spark: SparkSession, d: str) -> DataFrame:
    now = kept_dep(spark, d)
    return overview.graph_nodes(now, _mapped(spark, d, now)[2])


def v11_graph_edges(spark: SparkSession, d: str) -> DataFrame:
    now = kept_dep(spark, d)
    return overview.graph_edges(now, _mapped(spark, d, now)[3])


def w1_discover_logs(spark: SparkSession, d: str) -> DataFrame:
    v = partial(view, spark, d)
    names = v("fx_log").select(F.upper("log_name").alias("name")).union(v("fx_table").select("name"))
    return editlog.discover_logs(names)


def w2_changed_logs(spark: SparkSession, d: str) -> DataFrame:
    return editlog.changed_logs(view(spark, d, "fx_logs"), view(spark, d, "fx_marks"), SCHEMA)


def _latest(spark: SparkSession, d: str) -> DataFrame:
    return editlog.dedup_across_logs(editlog.latest_edit_per_table(view(spark, d, "fx_log")))


EDIT = ("log_name", "table_name", "max_edit_num", "ds_id", "last_edit_at", "workbook_id", "workbook_url", "input_name", "last_edit_by", "org_slug")


def w3_latest_edit_per_table(spark: SparkSession, d: str) -> DataFrame:
    return editlog.latest_edit_per_table(view(spark, d, "fx_log")).select(*EDIT)


def w4_dedup_across_logs(spark: SparkSession, d: str) -> DataFrame:
    return _latest(spark, d).select(*EDIT)


def w5_org_slug(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "fx_map").select(F.when(F.col("scan_schema") == "schema_0", "https:").otherwise(F.col("workbook_url")).alias("url"))
    return rows.groupBy(org_slug(F.col("url")).alias("org_slug")).agg(F.count("*").alias("n"))


def w6_table_inventory(spark: SparkSession, d: str) -> DataFrame:
    """The folders of the logs, one table each, written for it."""
    path = new_path(spark, "logs")
    view(spark, d, "fx_log").write.partitionBy("log_name").parquet(path)
    return table_inventory(spark, path).select("name", (F.col("created_at") <= F.col("last_modified")).alias("dated"), (F.col("size_bytes") > 0).alias("sized"))


def w17_read_listing_pages(spark: SparkSession, d: str) -> DataFrame:
    """Listings of sources, a page for every thousand workbooks or so, written as JSON and read again."""
    rows, path = view(spark, d, "fx_source"), new_path(spark, "pages")
    pages = rows.groupBy(F.floor(F.col("workbook_id") / 1000).alias("page")).agg(F.collect_list(F.struct(*rows.columns)).alias("items"))
    keyed = F.when(F.col("page") % 2 == 0, F.to_json(F.struct(F.col("items").alias("entries")))).otherwise(F.to_json(F.col("items")))
    pages.select("page", keyed.alias("value")).repartition("page").write.partitionBy("page").text(path)
    items, _ = read_listing_pages(spark, f"{path}/page=*", rows.schema)
    return items.groupBy(*rows.columns).agg(F.count("*").alias("n"))


def w7_orphan_flags(spark: SparkSession, d: str) -> DataFrame:
    return editlog.orphan_flags(_latest(spark, d), view(spark, d, "fx_table")).select("table_name", "is_orphaned")


def w7_orphan_changes(spark: SparkSession, d: str) -> DataFrame:
    batch = _latest(spark, d).filter("max_edit_num % 2 = 0")
    return editlog.orphan_changes(view(spark, d, "fx_map"), view(spark, d, "fx_table"), batch, SCHEMA)


def w8_deletion_flags(spark: SparkSession, d: str) -> DataFrame:
    inventory = view(spark, d, "fx_map")
    logs = inventory.filter("table_name like '%3' or table_name like '%2'").select("log_name")
    return editlog.deletion_flags(inventory, logs, SCHEMA, as_of()).select("table_name", "scan_schema", "is_deleted", "deleted_at")


def w9_infer_id_column(spark: SparkSession, d: str) -> DataFrame:
    v = partial(view, spark, d)
    listing = v("fx_lst_workbook").select(F.col("owner_id").alias("ownerId"), F.concat(F.lit("x"), F.col("id")).alias("otherId"), F.col("id").alias("workbookId"), "name")
    return editlog.infer_id_column(listing, _latest(spark, d).select(F.col("workbook_id").alias("id")))


def _tags(v) -> DataFrame:
    t = v("fx_lst_tagged").groupBy("workbook_id", "name", "url", "owner_id").agg(F.collect_list(F.struct("tagged_id", F.col("tag").alias("name"))).alias("tags"))
    return editlog.tag_index(t.withColumn("path", F.array(F.lit("a"), F.col("name"))))


def w10_tag_index(spark: SparkSession, d: str) -> DataFrame:
    return _tags(partial(view, spark, d))


def _enriched(spark: SparkSession, d: str) -> DataFrame:
    v = partial(view, spark, d)
    books = v("fx_lst_workbook").withColumn("path", F.array(F.lit("b"), F.col("name")))
    models = v("fx_lst_model").withColumn("path", F.col("name"))
    return editlog.enrich_owner_object(_latest(spark, d), books, models, _tags(v), v("fx_member"))


def w11_enrich_owner_object(spark: SparkSession, d: str) -> DataFrame:
    return _enriched(spark, d)


def w12_refresh_archived(spark: SparkSession, d: str) -> DataFrame:
    v = partial(view, spark, d)
    stored = v("fx_map").withColumns({"workbook_id": F.regexp_replace("table_name", "in_", "wb_"), "parent_workbook_id": F.when(F.col("is_tagged"), F.concat(F.lit("wb_"), F.regexp_replace("workbook_id", "wbid_", "")))})
    return editlog.refresh_archived(stored, v("fx_lst_workbook").withColumn("path", F.lit("b")), v("fx_lst_model").withColumn("path", F.lit("b")))


def w13_legacy_flag(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "fx_logs").select("log_name", legacy_flag(F.col("log_name")).alias("is_legacy"))


def w14_assemble_records(spark: SparkSession, d: str) -> DataFrame:
    v = partial(view, spark, d)
    tables = v("fx_table").select("name", F.md5("name").alias("table_id"), F.lit("/t").alias("location"), as_of().alias("created_at"), as_of().alias("last_modified"), F.length("name").cast("long").alias("size_bytes"))
    fresh = _enriched(spark, d).filter("workbook_id not like '%1'")
    cached = v("fx_map").withColumns({"workbook_id": F.regexp_replace("table_name", "in_", "wb_"), "workbook_path": F.lit("old"), "api_url": F.lit(None).cast("string")})
    return editlog.assemble_records(_latest(spark, d), v("fx_logs"), tables, fresh, cached, SCHEMA).drop("table_created_at")


def w15_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The merge itself; its versions on disk are held by unit tests."""
    rows = view(spark, d, "fx_map").select("table_name", "scan_schema", "max_edit_num", "size_bytes", F.lit("old").alias("side"), F.expr("cast(substr(table_name, 4) as bigint)").alias("k"))
    new = rows.filter("k % 3 = 0").withColumns({"side": F.lit("new"), "max_edit_num": F.col("max_edit_num") + 1})
    return merged(rows.filter("k % 2 = 0 or k % 3 <> 0").drop("k"), new.drop("k"), ["table_name", "scan_schema"])


def w16_recent_entries(spark: SparkSession, d: str) -> DataFrame:
    return editlog.recent_entries(view(spark, d, "fx_map")).select("table_name", "table_modified_at")


def s1_score_components(spark: SparkSession, d: str) -> DataFrame:
    return scoring.score_components(view(spark, d, "fx_map"), as_of()).select("table_name", "days_since_edit", "days_since_change", "size_mb", *scoring.PARTS)


def s2_archival_score(spark: SparkSession, d: str) -> DataFrame:
    return scoring.archival_score(view(spark, d, "fx_map"), as_of()).select("table_name", "scan_schema", "workbook_name", "owner", "total_score", "tier", "size_mb")


def s3_tier_rollup(spark: SparkSession, d: str) -> DataFrame:
    return scoring.tier_rollup(scoring.archival_score(view(spark, d, "fx_map"), as_of()))


def r1_landscape_overview(spark: SparkSession, d: str) -> DataFrame:
    return reports.landscape_overview(view(spark, d, "fx_map"))


def r2_reclamation_candidates(spark: SparkSession, d: str) -> DataFrame:
    return reports.reclamation_candidates(view(spark, d, "fx_map"), as_of())


def r3_stale_active(spark: SparkSession, d: str) -> DataFrame:
    return reports.stale_active(view(spark, d, "fx_map"), as_of())


def r4_most_active(spark: SparkSession, d: str) -> DataFrame:
    return reports.most_active(view(spark, d, "fx_map"), as_of())


def r5_owner_summary(spark: SparkSession, d: str) -> DataFrame:
    return reports.owner_summary(view(spark, d, "fx_map"), as_of())


def r6_multi_input_assets(spark: SparkSession, d: str) -> DataFrame:
    return reports.multi_input_assets(view(spark, d, "fx_map"))


def r7_legacy_inventory(spark: SparkSession, d: str) -> DataFrame:
    return reports.legacy_inventory(view(spark, d, "fx_map"), as_of())


def queries() -> dict:
    found = [f for name, f in globals().items() if name[0] in "gmcxvwsr" and name[1:2].isdigit() and callable(f)]
    return {f.__name__: f for f in found} | stored.queries()


def oracle_sql() -> dict[str, str]:
    own = catalog_sql.oracle_sql()
    return own | stored.oracle_sql(own)
