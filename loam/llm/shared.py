"""Written tables that cut lineage in the folder that driver and executors share, and small Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from loam.sources.shared import new_path, shared_dir

__all__ = ["new_path", "removed", "shared_dir", "small", "written"]

#: Rows of whole texts that a Python worker turns into objects at once. Spark bounds an Arrow batch in bytes
#: (spark.sql.execution.arrow.maxBytesPerBatch), which holds for long texts.
ARROW_RECORDS = 1000
#: Spark's settings while a table is written: shuffle files go at the end; Arrow batches are small, as each of a stage's
#: Python functions holds some in its worker and outside the JVM's heap.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, and safe against lost executors.

    Once it is written, the shuffles that made it are deleted.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    before = {k: spark.conf.get(k) for k in WRITING}
    for k, v in WRITING.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    out.loam_path = path
    return out


def removed(*tables: DataFrame) -> None:
    """Delete tables made by written() that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.loam_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(batches: Iterator[pa.RecordBatch], rows: int = ARROW_RECORDS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most so many rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
