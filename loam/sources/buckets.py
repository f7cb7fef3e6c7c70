"""A keyed table on plain files of which an upsert rewrites only what changes.

Rows lie in folders by a hash of their key. An upsert reads the folders that hold a key of its updates, merges, and
replaces those folders by Spark's dynamic partition overwrite; the others are neither read nor written. The merged
rows are first written beside the table, so an upsert that fails while it replaces folders is finished by
the next upsert, or by recovered(). One writer at a time; a reader during the replacement may miss folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.sources.runs import exists, merged

BUCKET = "_bucket"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in keys)), F.lit(buckets)).cast("int")


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def recovered(spark: SparkSession, path: str) -> bool:
    """Finish an upsert that failed after its rows were written, drop one that failed before; whether there was one to finish."""
    pending = f"{path}/_pending"
    if not exists(spark, pending):
        return False
    done = exists(spark, f"{pending}/_SUCCESS")
    if done:
        _replace(spark.read.parquet(pending), path)
    _remove(spark, pending)
    return done


def has_buckets(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at the path, once recovered(): the first upsert may have failed before it made one."""
    recovered(spark, path)
    folders = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{BUCKET}=*")
    return bool(folders.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folders))


def _replace(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The table, once recovered()."""
    recovered(spark, path)
    return spark.read.parquet(path).drop(BUCKET)


def upsert_buckets(spark: SparkSession, path: str, updates: DataFrame, keys: list[str], buckets: int = 64) -> DataFrame:
    """merged(table, updates, keys), of which only the buckets with updates are read and written; returns the table.

    buckets must stay what it was when the table was made. Rows with a null key part are added each time, as in merged().
    """
    dealt = updates.withColumn(BUCKET, bucket_of(keys, buckets))
    if has_buckets(spark, path):
        # no more than `buckets` numbers
        own = [r[BUCKET] for r in dealt.select(BUCKET).distinct().collect()]
        if not own:
            return read_buckets(spark, path)
        held = spark.read.parquet(path)
        out = merged(held.filter(F.col(BUCKET).isin(own)), dealt.select(*held.columns), keys)
    else:
        out = merged(dealt.limit(0), dealt, keys)
    pending = f"{path}/_pending"
    out.repartition(BUCKET).write.mode("overwrite").parquet(pending)
    recovered(spark, path)
    return read_buckets(spark, path)
