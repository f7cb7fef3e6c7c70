"""One run of the edit-log fold: from the logs that changed to the next state of the inventory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.operators import editlog
from loam.sources.buckets import has_buckets, read_buckets, upsert_buckets
from loam.sources.runs import merged
from loam.sources.shared import kept

KEYS = ["table_name", "scan_schema"]


def updated_inventory(
    inventory: DataFrame, rows: DataFrame | Callable[[DataFrame], DataFrame], logs: DataFrame, tables: DataFrame, workbooks: DataFrame, models: DataFrame, tagged: DataFrame, members: DataFrame,
    scan_schema: str, as_of: Column, complete: bool = True, url_keys: tuple = editlog.URL_KEYS,
) -> DataFrame:
    """The inventory (columns RECORD) after a run: new edits merged in, then orphan, deletion and archived flags refreshed.

    rows: rows of the logs, or a function from the changed logs (log_name) to their rows, such as read_logs of
    loam.sources.runs, which opens no other log; logs: (log_name, last_modified) of all of them; tables: table_inventory();
    workbooks, models, tagged and members: listings as in editlog. Only logs that changed since the stored marks count.
    complete says that logs lists all there are; otherwise stored rows keep their orphan and deletion flags. Other
    schemas' rows keep their flags.
    """
    changed = editlog.changed_logs(logs, inventory, scan_schema).select("log_name")
    found = rows(changed) if callable(rows) else rows.join(changed, "log_name", "left_semi")
    latest = editlog.dedup_across_logs(editlog.latest_edit_per_table(found, url_keys))
    fresh = editlog.enrich_owner_object(editlog.ids_to_enrich(latest, inventory), workbooks, models, editlog.tag_index(tagged), members)
    batch = editlog.assemble_records(latest, logs, tables, fresh, inventory, scan_schema)
    out = merged(inventory, batch, KEYS)
    if complete:
        own = F.col("scan_schema") == scan_schema
        orphans = editlog.orphan_changes(inventory, tables, batch, scan_schema).withColumnRenamed("is_orphaned", "_o")
        out = out.join(orphans, "table_name", "left")
        out = out.withColumn("is_orphaned", F.when(own & F.col("_o").isNotNull(), F.col("_o")).otherwise(F.col("is_orphaned"))).select(*inventory.columns)
    out = editlog.deletion_flags(out, logs, scan_schema, as_of, complete)
    archived = editlog.refresh_archived(out, workbooks, models).withColumnRenamed("is_archived", "_a")
    out = out.join(archived, "workbook_id", "left").withColumn("is_archived", F.coalesce("_a", "is_archived"))
    return out.select(*inventory.columns)


def changed_records(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of after that before lacks or has otherwise."""
    return after.select(*before.columns).subtract(before)


def run_inventory(spark: SparkSession, path: str, empty: DataFrame, *inputs, buckets: int = 64, **options) -> DataFrame:
    """A run over an inventory kept by loam.sources.buckets: only the buckets of rows that change are written.

    empty: the inventory to begin with, where there is none yet. inputs and options: those of updated_inventory, from rows on.
    """
    before = read_buckets(spark, path) if has_buckets(spark, path) else empty
    return upsert_buckets(spark, path, kept(changed_records(before, updated_inventory(before, *inputs, **options))), KEYS, buckets)
