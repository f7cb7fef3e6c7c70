"""Reports on an inventory. as_of is a timestamp without zone that stands for now."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions.columns import full_name, units, whole_days

MB, GB = 1 << 20, 1 << 30


def _is(name: str, value: bool = True) -> Column:
    return F.col(name) == F.lit(value)


def _signal() -> Column:
    return _is("is_orphaned") | _is("is_deleted") | _is("is_archived")


def _gb(size: Column) -> Column:
    return F.round(F.sum(size).cast("double") / float(GB), 3)


def _bytes() -> Column:
    return F.coalesce("size_bytes", F.lit(0))


def _before(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(F.lit(days))


def _owner() -> Column:
    return full_name(F.col("owner_first_name"), F.col("owner_last_name")).alias("owner")


def _age(as_of: Column) -> Column:
    return whole_days(F.col("last_edit_at"), as_of).alias("days_since_edit")


def landscape_overview(inventory: DataFrame) -> DataFrame:
    """Per schema: tables by flag, GB in all and GB that could be reclaimed."""
    out = inventory.groupBy("scan_schema").agg(
        F.count("*").alias("tables"),
        F.count_if(_is("is_orphaned")).alias("orphaned"),
        F.count_if(_is("is_deleted")).alias("deleted"),
        F.count_if(_is("is_archived") & _is("is_orphaned", False) & _is("is_deleted", False)).alias("archived_active"),
        F.count_if(_is("is_legacy")).alias("legacy"),
        F.count_if(_is("is_tagged")).alias("tagged"),
        _gb(_bytes()).alias("total_gb"),
        _gb(F.when(_signal(), _bytes()).otherwise(0)).alias("reclaimable_gb"),
    )
    return out.orderBy(F.col("scan_schema").asc_nulls_last())


def reclamation_candidates(inventory: DataFrame, as_of: Column) -> DataFrame:
    """Tables with any signal for archival; the strongest one, largest tables first."""
    signal = F.when(_is("is_orphaned"), "Orphaned — table gone").when(_is("is_deleted"), "Deleted — log gone").when(_is("is_archived"), "Workbook archived").otherwise("Other")
    rows = inventory.filter(_signal()).orderBy(F.col("scan_schema").asc_nulls_last(), F.col("size_bytes").desc_nulls_last())
    return rows.select("scan_schema", "table_name", "log_name", "workbook_name", _owner(), signal.alias("signal"), "is_tagged", "version_tag", units(F.col("size_bytes"), GB, 3).alias("size_gb"), "last_edit_at", _age(as_of), "max_edit_num", "workbook_url")


def stale_active(inventory: DataFrame, as_of: Column) -> DataFrame:
    """Live tables without an edit for 30 days, or ever. A null archived flag is not live."""
    rows = inventory.filter(_is("is_orphaned", False) & _is("is_deleted", False) & _is("is_archived", False) & (F.col("last_edit_at").isNull() | (F.col("last_edit_at") < _before(as_of, 30))))
    age = whole_days(F.col("last_edit_at"), as_of)
    band = F.when(age.isNull() | (age > 365), ">365 days").when(age > 180, "181–365 days").when(age > 90, "91–180 days").otherwise("31–90 days")
    rows = rows.orderBy(F.col("scan_schema").asc_nulls_last(), F.col("last_edit_at").asc_nulls_first())
    return rows.select("scan_schema", "table_name", "workbook_name", _owner(), "last_edit_by", "last_edit_at", _age(as_of), band.alias("inactivity_band"), "max_edit_num", units(F.col("size_bytes"), MB, 2).alias("size_mb"), "is_tagged", "version_tag", "workbook_url")


def most_active(inventory: DataFrame, as_of: Column) -> DataFrame:
    """Live tables with edits, most edited first."""
    rows = inventory.filter(_is("is_orphaned", False) & _is("is_deleted", False) & (F.col("max_edit_num") > 0))
    rows = rows.orderBy(F.col("scan_schema").asc_nulls_last(), F.col("max_edit_num").desc(), F.col("last_edit_at").desc_nulls_last())
    return rows.select("scan_schema", "table_name", "workbook_name", _owner(), "last_edit_by", "max_edit_num", "last_edit_at", _age(as_of), units(F.col("size_bytes"), MB, 2).alias("size_mb"), "is_tagged", "version_tag", "workbook_url")


def owner_summary(inventory: DataFrame, as_of: Column) -> DataFrame:
    """Per schema and owner: tables by flag, stale ones, GB."""
    out = inventory.filter("owner_id is not null").groupBy("scan_schema", _owner(), "owner_id").agg(
        F.count("*").alias("tables"),
        F.count_if(_is("is_archived")).alias("archived"),
        F.count_if(_is("is_orphaned")).alias("orphaned"),
        F.count_if(_is("is_deleted")).alias("deleted"),
        F.count_if((F.col("last_edit_at") < _before(as_of, 180)) | F.col("last_edit_at").isNull()).alias("stale_180d"),
        _gb(_bytes()).alias("total_gb"),
        _gb(F.when(_signal(), _bytes()).otherwise(0)).alias("reclaimable_gb"),
    )
    return out.orderBy(F.col("scan_schema").asc_nulls_last(), F.col("reclaimable_gb").desc(), F.col("archived").desc())


def multi_input_assets(inventory: DataFrame) -> DataFrame:
    """Workbooks with several input elements; versions count to their parent, whose untagged name is preferred."""
    out = inventory.filter("workbook_id is not null").groupBy(F.coalesce("parent_workbook_id", "workbook_id").alias("workbook")).agg(
        F.coalesce(F.max(F.when(_is("is_tagged", False), F.col("workbook_name"))), F.max("workbook_name")).alias("workbook_name"),
        full_name(F.max("owner_first_name"), F.max("owner_last_name")).alias("owner"),
        F.countDistinct("input_name").alias("input_elements"),
        F.count("*").alias("files"),
        F.count_if(_is("is_tagged")).alias("tagged_files"),
        F.countDistinct("scan_schema").alias("schemas"),
        F.sum("max_edit_num").alias("edits"),
        F.max("last_edit_at").alias("last_edit_at"),
        _gb(_bytes()).alias("total_gb"),
        F.max(F.when(_is("is_archived"), "Yes").otherwise("No")).alias("archived"),
    )
    return out.filter("input_elements > 1").orderBy(F.col("input_elements").desc(), F.col("files").desc())


def legacy_inventory(inventory: DataFrame, as_of: Column) -> DataFrame:
    """Tables of legacy logs; those edited within 180 days first."""
    age = whole_days(F.col("last_edit_at"), as_of)
    idle = age.isNull() | (age >= 180)
    rows = inventory.filter(_is("is_legacy")).orderBy(F.col("scan_schema").asc_nulls_last(), F.when(idle, 1).otherwise(0), F.col("last_edit_at").desc_nulls_last())
    return rows.select("scan_schema", "log_name", "table_name", "workbook_name", _owner(), "last_edit_at", _age(as_of), "max_edit_num", F.when(idle, "Inactive — low urgency").otherwise("Active — migrate urgently").alias("priority"), "is_orphaned", "is_archived", units(F.col("size_bytes"), MB, 2).alias("size_mb"), "workbook_url")
