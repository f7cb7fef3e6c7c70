"""Mapping of consumers (workbooks) to the assets and targets they read.

Sources: workbook_id, source_type (dataset, data-model, table, ...), inode_id, data_model_id.
Workbooks: workbook_id and any of name, url, path, owner_name, owner_email, created_at, updated_at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loam.sources.runs import latest_run, stamped

#: What a source's details tell of the asset behind it.
DETAILS = ("asset_id", "asset_name", "asset_path", "asset_url", "status", "role", "migrated_at", "migrated_by", "target_id", "target_name", "target_url", "target_path", "n_parents", "n_children")
WORKBOOK_FIELDS = ("name", "url", "path", "owner_name", "owner_email", "created_at", "updated_at")


def _first(df: DataFrame, key: str) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.col("asset_id").asc_nulls_last(), *(F.col(c).asc_nulls_last() for c in DETAILS if c not in (key, "asset_id")))
    return df.filter(F.col(key).isNotNull()).withColumn("_k", F.row_number().over(order)).filter("_k = 1").drop("_k")


def dependency_lookup(dep: DataFrame, by: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(assets, targets): one row per asset id, and one per target id (its smallest asset), of one run.

    by: of the newest run, as latest_run(by) finds it; without it all rows count.
    """
    dep = dep if by is None else latest_run(dep, by)
    assets = _first(dep.select(*DETAILS), "asset_id")
    return assets, _first(assets, "target_id")


def classify_sources(sources: DataFrame, assets: DataFrame, targets: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Sources with in_scope and the details of the asset behind them.

    A dataset source is in scope if its inode is a known asset, a data-model source if its id is a known target.
    aliases (alias, canonical) lead from inodes to asset ids. Sources without such an id are joined with nothing, so
    that however many they are, they don't meet in one task; sources are read three times for that.
    """
    inode, model = (F.coalesce((F.col("source_type") == kind) & F.col(c).isNotNull(), F.lit(False)) for kind, c in (("dataset", "inode_id"), ("data-model", "data_model_id")))
    # plain columns, not a struct, so that a reader's joins move only the details that it reads
    hit = F.lit(True).alias("_hit")
    by_asset = assets.select(F.col("asset_id").alias("_key"), hit, *DETAILS)
    by_target = targets.select(F.col("target_id").alias("_key"), hit, *DETAILS)
    inodes = sources.filter(inode).withColumn("_key", F.col("inode_id"))
    if aliases is not None:
        names = aliases.select(F.col("alias").alias("_key"), F.col("canonical").alias("_to")).filter("_key is not null").distinct()
        inodes = inodes.join(names, "_key", "left").withColumn("_key", F.coalesce("_to", "_key")).drop("_to")
    models = sources.filter(model).withColumn("_key", F.col("data_model_id"))
    found = lambda rows: rows.select(*sources.columns, F.col("_hit").isNotNull().alias("in_scope"), *DETAILS)
    out = found(inodes.join(by_asset, "_key", "left")).unionByName(found(models.join(by_target, "_key", "left")))
    none = sources.filter(~inode & ~model).select(*sources.columns, F.lit(False).alias("in_scope"))
    return out.unionByName(none, allowMissingColumns=True)


def source_details(classified: DataFrame, workbooks: DataFrame, run_id: str, created_at: str) -> DataFrame:
    """The in-scope sources with their workbooks' names and paths, run-stamped."""
    named = workbooks.select("workbook_id", F.coalesce("name", F.col("workbook_id").cast("string")).alias("workbook_name"), F.col("path").alias("workbook_path"))
    out = classified.filter("in_scope").join(named, "workbook_id", "left")
    return stamped(out.select("workbook_id", "workbook_name", "workbook_path", "inode_id", "data_model_id", "source_type", "in_scope", *DETAILS), run_id, created_at)


def asset_summary(classified: DataFrame, workbooks: DataFrame, run_id: str, created_at: str) -> DataFrame:
    """One row per workbook with a source in scope: counts by source type and the migration status."""
    counts = classified.groupBy("workbook_id").agg(
        F.count_if(F.col("in_scope") & (F.col("source_type") == "dataset")).alias("dataset_sources"),
        F.count_if(F.col("in_scope") & (F.col("source_type") == "data-model")).alias("data_model_sources"),
        F.count_if(F.col("source_type") == "table").alias("table_sources"),
    )
    total = F.col("dataset_sources") + F.col("data_model_sources")
    status = F.when(F.col("data_model_sources") == total, "FULLY MIGRATED").when(F.col("dataset_sources") == total, "NOT MIGRATED").otherwise("PARTIALLY MIGRATED")
    out = counts.withColumn("total_sources", total).filter("total_sources > 0").withColumn("migration_status", status)
    named = workbooks.select("workbook_id", F.coalesce("name", F.col("workbook_id").cast("string")).alias("workbook_name"), *(F.col(c).alias(f"workbook_{c}" if not c.startswith("owner") else c) for c in WORKBOOK_FIELDS if c != "name"))
    out = out.join(named, "workbook_id", "left")
    return stamped(out.select("workbook_id", "workbook_name", "workbook_url", "workbook_path", "owner_name", "owner_email", "workbook_created_at", "workbook_updated_at", "total_sources", "dataset_sources", "data_model_sources", "table_sources", "migration_status"), run_id, created_at)


def mapping_summary(workbooks: DataFrame, summary: DataFrame, details: DataFrame) -> DataFrame:
    """One row: workbooks scanned, in scope, by status, and source relationships."""
    of = lambda s: F.count_if(F.col("migration_status") == s)
    rows = summary.agg(F.count("*").alias("in_scope"), of("FULLY MIGRATED").alias("fully_migrated"), of("PARTIALLY MIGRATED").alias("partially_migrated"), of("NOT MIGRATED").alias("not_migrated"))
    scanned = workbooks.select("workbook_id").distinct().agg(F.count("*")).scalar()
    return rows.select(scanned.alias("scanned"), "*", details.agg(F.count("*")).scalar().alias("relationships"))
