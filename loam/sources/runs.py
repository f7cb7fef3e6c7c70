"""Run-stamped snapshots and versioned tables on plain files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def latest_run(df: DataFrame, by: str = "created_at") -> DataFrame:
    """Rows of the newest run. by="run_id" takes the largest run id instead, which needn't be the newest."""
    return df.filter(F.col(by) == df.agg(F.max(by)).scalar())


def stamped(df: DataFrame, run_id: str, created_at: str) -> DataFrame:
    """df with the columns run_id and created_at in front."""
    return df.select(F.lit(run_id).alias("run_id"), F.lit(created_at).cast("timestamp_ntz").alias("created_at"), "*")


def write_snapshot(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write a run's rows, partitioned by run_id. mode: append, or overwrite (which empties the table first)."""
    if mode not in ("append", "overwrite"):
        raise ValueError(mode)
    df.write.mode(mode).partitionBy("run_id").parquet(path)


def append_run(df: DataFrame, path: str, run_id: str, created_at: str, mode: str = "append") -> None:
    """Stamp the rows with a run and write them, partitioned by run_id; then enter the run in the table of runs below the path.

    A run whose write failed is in no table of runs, so read_latest_run doesn't take it.
    """
    write_snapshot(stamped(df, run_id, created_at), path, mode)
    stamped(df.sparkSession.range(1), run_id, created_at).drop("id").coalesce(1).write.mode("append").parquet(f"{path}/_runs")


def read_latest_run(spark: SparkSession, path: str, by: str = "created_at") -> DataFrame:
    """latest_run() of snapshots that append_run wrote, from the table of runs: only the newest run's partition is read."""
    if by not in ("created_at", "run_id"):
        raise ValueError(by)
    newest = spark.read.parquet(f"{path}/_runs").orderBy(F.col(by).desc(), F.col("run_id").desc()).select("run_id").first()
    snapshots = spark.read.parquet(path)
    # partition values are read as what they look like, numbers for instance
    return snapshots.filter(F.col("run_id") == F.lit(newest["run_id"]).cast(snapshots.schema["run_id"].dataType))


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def log_folders(path: str, names: list[str], column: str = "log_name") -> list[str]:
    """The folders of a table partitioned by the column, for these values: Spark escapes some signs in them."""
    return [f"{path}/{column}=" + re.sub(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", n) for n in names]


def read_logs(spark: SparkSession, path: str, names: DataFrame, schema: str) -> DataFrame:
    """The rows of the named logs (log_name) of a table partitioned by log_name.

    Only the folders of these logs are listed and opened, however many others there are: the driver holds their names, as
    it does for every read. A log without a folder has no rows. schema: that of the table without log_name.
    """
    named = sorted(r["log_name"] for r in names.select("log_name").filter("log_name is not null").distinct().collect())
    folders = [f for f in log_folders(path, named) if exists(spark, f)]
    kind = f"{schema}, log_name string"
    if not folders:
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).option("basePath", path).parquet(*folders)


def merged(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """target with the rows of updates: those of equal keys replaced as a whole, the others added.

    Raises at run time if updates repeat a key. Null keys match nothing, so such rows are added.
    """
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    repeats = Window.partitionBy(*keys, F.when(null_key, F.monotonically_increasing_id()))
    once = updates.withColumn("_n", F.count("*").over(repeats))
    once = once.filter(F.when(F.col("_n") > 1, F.raise_error(F.lit("updates repeat a key"))).otherwise(F.lit(True)))
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(once.select(*target.columns))


def versions(spark: SparkSession, path: str, complete: bool = True) -> list[int]:
    """The numbers of the complete versions below the path; or of all, also those whose write failed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    done = [int(n[2:]) for n in names if n.startswith("v=") and (not complete or fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))]
    return sorted(done)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of a table; the newest complete one by default."""
    return spark.read.parquet(f"{path}/v={versions(spark, path)[-1] if version is None else version}")


def upsert(spark: SparkSession, path: str, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Merge updates into the newest complete version of the table and write the result as a new one.

    A version left behind by a failed write is passed over: its number is not used again.
    """
    done, all_numbers = versions(spark, path), versions(spark, path, complete=False)
    out = merged(read_version(spark, path), updates, keys) if done else updates
    number = max(all_numbers, default=-1) + 1
    out.write.parquet(f"{path}/v={number}")
    return read_version(spark, path, number)

