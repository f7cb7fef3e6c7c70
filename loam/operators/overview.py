"""Overview reports on a dependency table (one run) and on workbook mappings (one run)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.functions import wording
from loam.functions.columns import percent
from loam.sources.runs import latest_run


def _nodes(dep: DataFrame, *cols: str) -> DataFrame:
    return dep.select("asset_id", *cols).distinct()


def _roles() -> list:
    return [F.count_if(F.col("role") == r).alias(f"{r.lower()}_count") for r in ("ROOT", "INTERNAL", "LEAF")]


def model_overview(dep: DataFrame) -> DataFrame:
    """One row: nodes in all and by role, forks, merges, terminals, largest degrees, mean number of parents."""
    return _nodes(dep, "role", "n_parents", "n_children").agg(
        F.count("*").alias("total"),
        *_roles(),
        F.count_if(F.col("n_children") > 1).alias("fork_points"),
        F.count_if(F.col("n_parents") > 1).alias("merge_points"),
        F.count_if(F.col("n_children") == 0).alias("terminal_count"),
        F.max("n_parents").alias("max_parents"),
        F.max("n_children").alias("max_children"),
        F.round(F.avg("n_parents"), 2).alias("avg_parents"),
    )


def leaf_assets(dep: DataFrame) -> DataFrame:
    """Nodes that nothing depends on."""
    out = _nodes(dep, "asset_name", "asset_path", "asset_url", "role", "n_parents", "n_children").filter("n_children = 0").drop("n_children")
    kind = F.when(F.col("role") == "ROOT", wording.STANDALONE).otherwise(wording.LEAF)
    return out.withColumn("classification", kind).orderBy("role", F.col("asset_name").asc_nulls_last())


def migration_progress(dep: DataFrame) -> DataFrame:
    """One row: nodes by status, progress within the scope (null if there is none), roles and terminals."""
    of = lambda s: F.col("status") == s
    out = _nodes(dep, "status", "role", "n_children").agg(
        F.count("*").alias("total"),
        F.count_if(of("migrated")).alias("migrated"),
        F.count_if(of("not-migrated")).alias("not_migrated"),
        F.count_if(of("not-required")).alias("not_required"),
        F.count_if(of("migrated") | of("not-migrated")).alias("scope_total"),
        *_roles(),
        F.count_if(F.col("n_children") == 0).alias("terminal"),
        F.count_if((F.col("n_children") == 0) & of("not-migrated")).alias("terminal_not_migrated"),
        F.count_if((F.col("n_children") == 0) & of("migrated")).alias("terminal_migrated"),
    )
    return out.withColumn("pct_migrated", percent(F.col("migrated"), F.col("scope_total")))


def asset_migration_summary(summary: DataFrame) -> DataFrame:
    """One row: workbooks by migration status and their sources by type."""
    of = lambda s: F.count_if(F.col("migration_status") == s)
    out = summary.agg(
        F.count("*").alias("total"),
        of("FULLY MIGRATED").alias("fully_migrated"),
        of("PARTIALLY MIGRATED").alias("partially_migrated"),
        of("NOT MIGRATED").alias("not_migrated"),
        *(F.sum(f"{c}_sources").alias(f"{c}_sources") for c in ("dataset", "data_model", "table")),
    )
    return out.withColumn("pct_fully_migrated", percent(F.col("fully_migrated"), F.col("total")))


def terminal_assets(dep: DataFrame, details: DataFrame) -> DataFrame:
    """Nodes without children that no workbook reads as a dataset."""
    own = _nodes(dep, "asset_name", "asset_path", "asset_url", "status", "role", "n_parents", "n_children", "target_name", "target_url", "migrated_at").filter("n_children = 0").drop("n_children")
    read = details.filter("source_type = 'dataset' and workbook_id is not null").select("asset_id").distinct()
    kind = F.when(F.col("status") == "migrated", wording.TERMINAL_DONE).when(F.col("status") == "not-migrated", wording.TERMINAL_EASY).when(F.col("status") == "not-required", wording.TERMINAL_ORPHANED).otherwise("REVIEW")
    out = own.join(read, "asset_id", "left_anti").withColumn("terminal_status", kind)
    return out.orderBy(F.when(F.col("status") == "not-migrated", 0).when(F.col("status") == "migrated", 1).otherwise(2), F.col("asset_name").asc_nulls_last())


def child_ahead_of_parent(dep: DataFrame) -> DataFrame:
    """Edges whose child is migrated while the parent is not."""
    urls = dep.select(F.col("asset_id").alias("parent_id"), F.col("asset_url").alias("blocker_url")).distinct()
    rows = dep.filter("parent_status = 'not-migrated' and status = 'migrated'").join(urls, "parent_id")
    rows = rows.select("parent_id", "parent_name", "blocker_url", "asset_id", "asset_name", "asset_url", "target_name", "target_url").distinct()
    detail = F.concat(F.lit("Parent is not-migrated but child data model exists: "), F.col("asset_name"), F.lit(" → "), F.coalesce("target_name", F.lit("unknown data model")))
    rows = rows.orderBy(F.col("parent_name").asc_nulls_last(), F.col("asset_name").asc_nulls_last())
    return rows.select(F.lit("CHILD AHEAD OF PARENT").alias("issue_type"), F.col("parent_id").alias("blocker_id"), F.col("parent_name").alias("blocker_name"), "blocker_url", detail.alias("detail"), F.col("asset_url").alias("child_url"), F.col("target_url").alias("child_target_url"))


def blocking_assets(dep: DataFrame) -> DataFrame:
    """Parents that are not migrated, with children that aren't either."""
    held = dep.filter("parent_status = 'not-migrated' and status = 'not-migrated'").groupBy(F.col("parent_id").alias("asset_id")).agg(F.countDistinct("asset_id").alias("not_migrated_children"))
    own = _nodes(dep, "asset_name", "asset_url", "status", "role", F.col("n_children").alias("total_children")).drop("status")
    advice = wording.told(wording.UNBLOCKS, n=F.col("not_migrated_children"))
    return own.join(held, "asset_id").withColumn("recommendation", advice).orderBy(F.col("not_migrated_children").desc(), F.col("asset_name").asc_nulls_last())


def _newest(df: DataFrame, by: str | None) -> DataFrame:
    return df if by is None else latest_run(df, by)


def repointing_candidates(details: DataFrame, summary: DataFrame, by: str | None = None) -> DataFrame:
    """Workbooks that still read a dataset which is already migrated.

    by: each table's own newest run counts, as latest_run(by) finds it; without it all rows count.
    """
    details, summary = _newest(details, by), _newest(summary, by)
    old = details.filter("source_type = 'dataset' and status = 'migrated'").select("workbook_id", F.col("inode_id").alias("dataset_id"), "asset_name", "asset_url", "target_id", "target_name", "target_url", "migrated_at")
    out = summary.select("workbook_id", "workbook_name", "workbook_url", "owner_name", "owner_email", "migration_status").join(old, "workbook_id")
    return out.orderBy(*(F.col(c).asc_nulls_last() for c in ("owner_name", "workbook_name", "asset_name")))


def readiness_pipeline(dep: DataFrame) -> DataFrame:
    """Assets not migrated yet: READY without a parent that is not-migrated, else what they wait for."""
    own = _nodes(dep, "asset_name", "asset_path", "asset_url", "status", "role", "n_parents", "n_children").filter("status = 'not-migrated'").drop("status")
    waits = dep.filter("status = 'not-migrated' and parent_id is not null").groupBy("asset_id").agg(F.count_if(F.col("parent_status") == "not-migrated").alias("b"), F.count_if(F.col("parent_status") == "migrated").alias("m"))
    out = own.join(waits, "asset_id", "left").withColumn("parents_blocking", F.coalesce("b", F.lit(0))).withColumn("parents_migrated", F.coalesce("m", F.lit(0))).drop("b", "m")
    held = F.col("parents_blocking")
    out = out.withColumn("readiness", F.when(held == 0, "READY").otherwise(wording.told(wording.BLOCKED_BY, n=held)))
    priority = F.when((held == 0) & (F.col("n_children") > 0), wording.told(wording.HIGH, n=F.col("n_children"))).when(held == 0, wording.LOW).otherwise(wording.told(wording.WAITING, n=held))
    return out.withColumn("priority", priority).orderBy(held, F.col("n_children").desc(), F.col("asset_name").asc_nulls_last())


def graph_nodes(dep: DataFrame, summary: DataFrame, by: str | None = None) -> DataFrame:
    """Assets and workbooks as nodes of one drawing. by: as in repointing_candidates."""
    dep, summary = _newest(dep, by), _newest(summary, by)
    size = F.greatest(F.col("n_children") + 10, F.lit(10)).cast("long")
    a = dep.select(F.col("asset_id").cast("string").alias("node_id"), F.col("asset_name").alias("node_name"), F.lit("dataset").alias("node_type"), F.col("role").alias("node_subtype"), "status", size.alias("symbol_size")).distinct()
    w = summary.select(F.col("workbook_id").cast("string").alias("node_id"), F.col("workbook_name").alias("node_name"), F.lit("workbook").alias("node_type"), F.col("migration_status").alias("node_subtype"), F.col("migration_status").alias("status"), F.lit(10).cast("long").alias("symbol_size")).distinct()
    return a.unionByName(w)


def graph_edges(dep: DataFrame, details: DataFrame, by: str | None = None, details_run: bool = True) -> DataFrame:
    """Edges between assets, and from assets to the workbooks that read them.

    by: as in repointing_candidates. details_run=False keeps all runs of details, and so stale edges, as an older rule has it.
    """
    dep, details = _newest(dep, by), _newest(details, by if details_run else None)
    a = dep.filter("parent_id is not null").select(F.col("parent_id").cast("string").alias("source"), F.col("asset_id").cast("string").alias("target"), F.lit("ds-ds").alias("edge_type")).distinct()
    known = details.filter("asset_id is not null").join(dep.select("asset_id"), "asset_id", "left_semi")
    return a.unionByName(known.select(F.col("asset_id").cast("string").alias("source"), F.col("workbook_id").cast("string").alias("target"), F.lit("ds-wb").alias("edge_type")).distinct())


def register_views(dep: DataFrame, summary: DataFrame, details: DataFrame, nodes: str = "graph_nodes", edges: str = "graph_edges") -> None:
    """The drawing's nodes and edges as temporary views of these names, for tools that speak SQL."""
    graph_nodes(dep, summary).createOrReplaceTempView(nodes)
    graph_edges(dep, details).createOrReplaceTempView(edges)


def create_views(spark: SparkSession, dep: str, summary: str, details: str, nodes: str = "graph_nodes", edges: str = "graph_edges", by: str = "created_at", details_run: bool = True) -> None:
    """graph_nodes and graph_edges as permanent views of these names over tables of the session's catalog.

    dep, summary and details name the tables; each view takes their newest runs at the time it is asked.
    """
    newest = lambda table: f"(SELECT * FROM {table} WHERE {by} = (SELECT max({by}) FROM {table}))"
    spark.sql(f"""
        CREATE OR REPLACE VIEW {nodes} AS
        SELECT DISTINCT CAST(asset_id AS STRING) AS node_id, asset_name AS node_name, 'dataset' AS node_type, role AS node_subtype, status,
               CAST(greatest(n_children + 10, 10) AS BIGINT) AS symbol_size
        FROM {newest(dep)}
        UNION ALL
        SELECT DISTINCT CAST(workbook_id AS STRING), workbook_name, 'workbook', migration_status, migration_status, CAST(10 AS BIGINT) FROM {newest(summary)}""")
    spark.sql(f"""
        CREATE OR REPLACE VIEW {edges} AS
        SELECT DISTINCT CAST(parent_id AS STRING) AS source, CAST(asset_id AS STRING) AS target, 'ds-ds' AS edge_type FROM {newest(dep)} WHERE parent_id IS NOT NULL
        UNION ALL
        SELECT DISTINCT CAST(asset_id AS STRING), CAST(workbook_id AS STRING), 'ds-wb' FROM {newest(details) if details_run else details}
        WHERE asset_id IN (SELECT asset_id FROM {newest(dep)})""")
