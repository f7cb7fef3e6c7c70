"""Tables that cut lineage, in the folder that the session names; a temporary one only in local sessions without."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, a local session gets one; a cluster's executors could not see it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="spark-loam-")
    return _OWN[app]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/loam/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame, label: str = "kept") -> DataFrame:
    """df computed once, as a Parquet table in storage that outlives executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
