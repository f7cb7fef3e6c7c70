"""A stream of edit-log rows folded into the inventory of latest edits, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from loam.operators.editlog import dedup_across_logs, latest_edit_per_table
from loam.sources.buckets import has_buckets, read_buckets, upsert_buckets
from loam.sources.runs import read_version, upsert, versions
from loam.sources.shared import kept


def stream_latest_edits(log: DataFrame, path: str, checkpoint: str, available_now: bool = True, buckets: int | None = None) -> StreamingQuery:
    """Keep, below the path, the latest edit of each table over all batches of a streaming edit log.

    With buckets the table is one of loam.sources.buckets, of which a batch rewrites only what it changes; otherwise
    every batch writes a new version. A batch that is tried again changes nothing more.
    """

    def fold(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        newest = dedup_across_logs(latest_edit_per_table(batch))
        there = has_buckets(spark, path) if buckets else bool(versions(spark, path))
        if there:
            now = read_buckets(spark, path) if buckets else read_version(spark, path)
            held = now.join(newest.select("table_name"), "table_name", "left_semi").select(*newest.columns)
            newest = dedup_across_logs(newest.unionByName(held))
            if buckets:
                newest = kept(newest.subtract(now.select(*newest.columns)))
        if buckets:
            upsert_buckets(spark, path, newest, ["table_name"], buckets)
        else:
            upsert(spark, path, newest, ["table_name"])

    writer = log.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
