"""Landed listing pages and the inventory of table folders."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys under which a page may hold its items, in order of preference.
LIST_KEYS = ("entries", "workbooks", "dataModels", "data", "items")


def read_listing_pages(spark: SparkSession, path: str, item: T.StructType, keys: tuple = LIST_KEYS, file_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(items, odd_pages) of JSON page files: the items of the first key present; files without any key.

    A page may also be a bare list of items. file_col: a column of the items for the page's file. Items whose fields vary
    in type, and pages that belong to an asset, are read by loam.sources.landing.
    """
    page = T.StructType([T.StructField(k, T.ArrayType(item)) for k in keys])
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    bare = F.when(F.ltrim("value").startswith("["), F.from_json("value", T.ArrayType(item)))
    wrapped = F.from_json(F.when(~F.ltrim("value").startswith("["), F.col("value")), page)
    rows = files.select("file", F.coalesce(bare, *(wrapped[k] for k in keys)).alias("found"))
    own = [F.col("file").alias(file_col)] if file_col else []
    return rows.select("file", F.explode("found").alias("item")).select("item.*", *own), rows.filter("found is null").select("file")


def _listed(glob: str):
    """(location, created_at, last_modified, size_bytes) of the folders that hold files, below given ones."""
    import posixpath
    from fnmatch import fnmatch

    import pyarrow as pa
    from pyarrow import fs

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, root = fs.FileSystem.from_uri(uri)
                prefix, found = uri[: len(uri.rstrip("/")) - len(root.rstrip("/"))], {}
                for f in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
                    if f.type == fs.FileType.File and fnmatch(f.base_name, glob):
                        at = posixpath.dirname(f.path)
                        first, last, size = found.get(at, (f.mtime, f.mtime, 0))
                        found[at] = min(first, f.mtime), max(last, f.mtime), size + f.size
                rows = [(prefix + at, *x) for at, x in found.items()]
                kinds = (pa.string(), pa.timestamp("us", "UTC"), pa.timestamp("us", "UTC"), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["location", "created_at", "last_modified", "size_bytes"])

    return run


def table_inventory(spark: SparkSession, path: str, glob: str = "*.parquet", by_tasks: bool = False) -> DataFrame:
    """(table_id, name, location, created_at, last_modified, size_bytes) of the table folders below a path.

    Only file metadata is read. A table's creation is that of its oldest file, its id a hash of its location.
    by_tasks: the driver lists the folders directly below the path alone, and tasks list the files within them, each folder
    in one task; for stores with very many files that pyarrow's file systems reach. Files directly below the path
    are no table then. Else Spark lists all files, and the driver holds their status.
    """
    if by_tasks:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
        uris = [(s.getPath().toUri().getScheme() + "://" + (s.getPath().toUri().getAuthority() or "") + s.getPath().toUri().getPath(),) for s in found if s.isDirectory() and s.getPath().getName()[0] not in "._"]
        if uris:
            given = spark.createDataFrame(uris, "uri string").repartition(min(len(uris), 8 * spark.sparkContext.defaultParallelism))
            rows = given.mapInArrow(_listed(glob), "location string, created_at timestamp, last_modified timestamp, size_bytes long")
        else:
            rows = spark.createDataFrame([], "location string, created_at timestamp, last_modified timestamp, size_bytes long")
        return _named(rows)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    rows = files.select(F.regexp_replace("path", "/[^/]*$", "").alias("location"), "length", "modificationTime")
    return _named(rows.groupBy("location").agg(F.min("modificationTime").alias("created_at"), F.max("modificationTime").alias("last_modified"), F.sum("length").alias("size_bytes")))


def _named(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.md5("location").alias("table_id"), F.regexp_extract("location", "([^/]+)$", 1).alias("name"), "location", "created_at", "last_modified", "size_bytes"
    )


def catalog_tables(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """(name): the tables that the session's catalog lists in a schema, the current one by default."""
    return spark.sql(f"SHOW TABLES{f' IN {schema}' if schema else ''}").filter(~F.col("isTemporary")).select(F.col("tableName").alias("name"))
