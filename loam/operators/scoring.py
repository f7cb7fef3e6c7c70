"""Archival scores of an inventory: six signals and a penalty, tiers, and their roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions.wording import TIERS
from loam.functions.columns import full_name, units, whole_days

#: Tiers by least score, and the bounds of the bands below as (over, points).
EDIT_AGE = ((365, 25), (180, 18), (90, 10), (30, 4))
TABLE_AGE = ((365, 15), (180, 10), (90, 5))
EDIT_COUNT = ((0, 10), (10, 8), (50, 5), (200, 2))
STORAGE = ((1 << 30, 10), (100 << 20, 7), (10 << 20, 4))
PARTS = ("score_status", "score_edit_recency", "score_table_recency", "score_edit_volume", "score_legacy", "score_storage", "penalty_tagged")


def _over(value: Column, bands: tuple, rest: int, missing: int | None = None) -> Column:
    """The points of the first bound that the value exceeds."""
    out = F.when(value.isNull(), F.lit(missing)) if missing is not None else F.when(F.lit(False), F.lit(0))
    for bound, points in bands:
        out = out.when(value > bound, F.lit(points))
    return out.otherwise(F.lit(rest))


def _up_to(value: Column, bands: tuple, rest: int) -> Column:
    out = F.when(value.isNull(), F.lit(bands[0][1]))
    for bound, points in bands:
        out = out.when(value == bound if bound == 0 else value <= bound, F.lit(points))
    return out.otherwise(F.lit(rest))


def score_components(inventory: DataFrame, as_of: Column) -> DataFrame:
    """The inventory with ages in whole days, size in MB and the seven parts of the score. Rows stay where they are."""
    gone, deleted = F.col("is_orphaned"), F.col("is_deleted")
    there = (gone == F.lit(False)) & (deleted == F.lit(False))  # null flags fail both tests
    status = (
        F.when(gone == F.lit(True), 30)
        .when((deleted == F.lit(True)) & (gone == F.lit(False)), 25)
        .when((F.col("is_archived") == F.lit(True)) & there, 20)
        .when(F.col("workbook_name").isNull() & F.col("is_archived").isNull() & there, 15)
        .otherwise(0)
    )
    aged = inventory.withColumns({"days_since_edit": whole_days(F.col("last_edit_at"), as_of), "days_since_change": whole_days(F.col("table_modified_at"), as_of), "size_mb": units(F.col("size_bytes"), 1 << 20, 2)})
    legacy = F.col("is_legacy") == F.lit(True)
    return aged.withColumns(
        {
            "score_status": status,
            "score_edit_recency": _over(F.col("days_since_edit"), EDIT_AGE, 0, 25),
            "score_table_recency": _over(F.col("days_since_change"), TABLE_AGE, 0, 15),
            "score_edit_volume": _up_to(F.col("max_edit_num"), EDIT_COUNT, 0),
            "score_legacy": F.when(legacy & (F.col("days_since_edit") < 180), 10).when(legacy, 5).otherwise(0),
            "score_storage": _over(F.col("size_bytes"), STORAGE, 1),
            "penalty_tagged": F.when(F.col("is_tagged") == F.lit(True), -15).otherwise(0),
        }
    )


def archival_score(inventory: DataFrame, as_of: Column) -> DataFrame:
    """Each row's total (0 to 100), tier and owner with the parts, highest first."""
    total = sum((F.col(p) for p in PARTS[1:]), F.col(PARTS[0]))
    out = score_components(inventory, as_of).withColumn("total_score", F.greatest(F.lit(0), F.least(F.lit(100), total)))
    tier = F.lit(TIERS[-1][1])
    for least, name in reversed(TIERS[:-1]):
        tier = F.when(F.col("total_score") >= least, name).otherwise(tier)
    out = out.withColumns({"tier": tier, "owner": full_name(F.col("owner_first_name"), F.col("owner_last_name"))})
    cols = ["table_name", "scan_schema", "workbook_name", "owner", "is_archived", "is_orphaned", "is_deleted", "is_legacy", "is_tagged", "version_tag", "days_since_edit", "days_since_change", "max_edit_num", "size_mb", *PARTS, "total_score", "tier", "workbook_url"]
    return out.select(*cols, "size_bytes").orderBy(F.col("total_score").desc(), F.col("size_mb").desc())


def tier_rollup(scored: DataFrame) -> DataFrame:
    """Per tier: rows, GB, mean score and the range of edit ages. scored: archival_score()."""
    out = scored.groupBy("tier").agg(F.count("*").alias("records"), F.round(F.sum(F.coalesce("size_bytes", F.lit(0))).cast("double") / float(1 << 30), 3).alias("total_gb"), F.round(F.avg("total_score"), 1).alias("avg_score"), F.min("days_since_edit").alias("min_days_since_edit"), F.max("days_since_edit").alias("max_days_since_edit"))
    return out.orderBy("tier")
