"""From landed pages of nested listings to the tables that the operators take.

Pages are JSON files. An entry is read as a VARIANT, so a field may be missing, null, of another type than usual, or new
without any harm: what can't be read as the type that is wanted is null. Names given here are fixed values of the listings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.sources.listings import LIST_KEYS
from loam.sources.shared import kept

#: Keys under which a page of an asset's sources may hold them.
SOURCE_KEYS = ("entries", "sources")
#: The file's own name without its ending, and the folder it lies in.
BY_FILE, BY_FOLDER = r"([^/]+?)(?:\.[^./]*)?$", r"([^/]+)/[^/]*$"


def field(entry: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(entry, f"$.{path}", kind)


def iso_time(entry: Column, path: str) -> Column:
    """ISO 8601 text as a timestamp without zone, the offset discarded; null if it is no time."""
    return F.regexp_replace(field(entry, path), r"(Z|[+-]\d{2}:?\d{2})$", "").try_cast("timestamp_ntz")


def path_of(entry: Column, name: str = "path") -> Column:
    """A path that is text, or a list of parts, which are joined by `/`."""
    return F.coalesce(F.array_join(field(entry, name, "array<string>"), "/"), field(entry, name))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): files' paths and whole texts.

    Where there is a file for each asset, a read of them costs a listing and an opening each. Many of them should be
    written as one table of these columns (Parquet, say), once or as they land; pages_of() takes such a table as well.
    """
    return spark.read.text(path, wholetext=True).select(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))).alias("file"), "value")


def pages_of(files: DataFrame, keys: tuple = LIST_KEYS, asset_from: str | None = None) -> tuple[DataFrame, DataFrame]:
    """read_pages() of the texts of pages (file, value), wherever they are kept."""
    # exploded arrays of one, as filters on a plain column would go below it and parse each page again for every mention
    parsed = files.select("file", F.explode(F.array(F.try_parse_json("value"))).alias("page"))
    lists = [F.try_variant_get("page", p, "array<variant>") for p in ("$", *(f"$.{k}" for k in keys))]
    asset = F.regexp_replace(F.regexp_extract("file", asset_from, 1), "^[^=]*=", "") if asset_from else F.lit(None).cast("string")
    rows = parsed.select("file", asset.alias("asset_id"), F.explode(F.array(F.coalesce(*lists))).alias("items"))
    return rows.filter("items is not null"), rows.filter("items is null").select("file")


def read_pages(spark: SparkSession, path: str, keys: tuple = LIST_KEYS, asset_from: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(pages, odd): (file, asset_id, items) of JSON page files, items an array of VARIANT; and files (file) that hold no list.

    A page is a bare list, or an object with the list under the first of the keys that holds one. asset_from: a regular
    expression on the file's path whose group is the id of the asset that the page belongs to, BY_FILE or BY_FOLDER
    for instance (pages of sources don't name it themselves); a folder `name=id` gives the id. Without it asset_id is null.
    """
    return pages_of(read_files(spark, path), keys, asset_from)


def entries(pages: DataFrame) -> DataFrame:
    """(asset_id, entry): a row for each item of the pages."""
    return pages.select("asset_id", F.explode("items").alias("entry"))


def _once(rows: DataFrame, key: str, all_of: tuple = ()) -> DataFrame:
    """One row for each id, as pages that overlap repeat entries: the first by its columns, and every value of those in all_of."""
    rest = [c for c in rows.columns if c not in (key, *all_of)]
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("e"), *(F.collect_set(c).alias(c) for c in all_of)).select(key, "e.*", *all_of)


def asset_entries(found: DataFrame, inodes: bool = False) -> DataFrame:
    """Assets (as loam.operators.graph takes them) of dataset entries, by their dataset id. inodes: with the array of their inode ids."""
    e = F.col("entry")
    ids = [field(e, "inodeId").alias("inodes")] if inodes else []
    return _once(found.select(
        field(e, "datasetId").alias("asset_id"), field(e, "name").alias("name"), path_of(e).alias("path"), field(e, "url").alias("url"), field(e, "createdBy").alias("created_by"), field(e, "owner").alias("owner"),
        field(e, "migrationStatus").alias("status"), field(e, "migrationToDataModel.dataModelId").alias("target_id"), iso_time(e, "migrationToDataModel.migratedAt").alias("migrated_at"), field(e, "migrationToDataModel.migratedBy").alias("migrated_by"), *ids,
    ), "asset_id", ("inodes",) if inodes else ())


def alias_entries(found: DataFrame) -> DataFrame:
    """(alias, canonical): the inode ids of dataset entries, which sources may name in place of the dataset ids."""
    e = F.col("entry")
    return found.select(field(e, "inodeId").alias("alias"), field(e, "datasetId").alias("canonical")).filter("alias is not null and canonical is not null").distinct()


def target_entries(found: DataFrame) -> DataFrame:
    """Targets (as loam.operators.graph takes them) of data model entries."""
    e = F.col("entry")
    return _once(found.select(field(e, "dataModelId").alias("target_id"), field(e, "name").alias("name"), field(e, "url").alias("url"), path_of(e).alias("path"), iso_time(e, "createdAt").alias("created_at"), iso_time(e, "updatedAt").alias("updated_at")), "target_id")


def workbook_entries(found: DataFrame) -> DataFrame:
    """Workbooks (as loam.operators.mapping takes them) of workbook entries."""
    e = F.col("entry")
    return _once(found.select(
        field(e, "workbookId").alias("workbook_id"), field(e, "name").alias("name"), field(e, "url").alias("url"), path_of(e).alias("path"), field(e, "owner.name").alias("owner_name"), field(e, "owner.email").alias("owner_email"),
        iso_time(e, "createdAt").alias("created_at"), iso_time(e, "updatedAt").alias("updated_at"),
    ), "workbook_id")


def source_listing(pages: DataFrame) -> DataFrame:
    """(asset_id, sources): for graph.extract_edges. pages: with asset_from; sources: type, inode_id, asset_id, data_model_id, id."""
    one = lambda s: F.struct(field(s, "type").alias("type"), field(s, "inodeId").alias("inode_id"), field(s, "datasetId").alias("asset_id"), field(s, "dataModelId").alias("data_model_id"), field(s, "id").alias("id"))
    return pages.select("asset_id", F.explode(F.array(F.transform("items", one))).alias("sources"))  # once, as in pages_of


def workbook_sources(pages: DataFrame) -> DataFrame:
    """(workbook_id, source_type, inode_id, data_model_id): for mapping.classify_sources. pages: with asset_from."""
    e = F.col("entry")
    return entries(pages).select(F.col("asset_id").alias("workbook_id"), field(e, "type").alias("source_type"), field(e, "inodeId").alias("inode_id"), field(e, "dataModelId").alias("data_model_id"))


def landed_dependencies(spark: SparkSession, assets: str, targets: str, sources: str | DataFrame, run_id: str, created_at: str, asset_from: str = BY_FILE, single_targets: str | None = None) -> DataFrame:
    """graph.dependency_table of three folders of landed pages: listed assets, listed targets, and each asset's sources.

    Sources may also be a table of their pages (file, value), as read_files() gives it. They count if a listed asset has
    their inode id, dataset id or id. single_targets: files of one target
    each, for those that the list lacks but assets name (they may belong to others).
    """
    from loam.operators import graph

    listed = entries(read_pages(spark, assets)[0])
    # one table of assets and aliases, as each of their many uses would parse the listing again
    found = kept(asset_entries(listed, inodes=True), "listed")
    own, aliases = found.drop("inodes"), found.select(F.explode("inodes").alias("alias"), F.col("asset_id").alias("canonical"))
    models = target_entries(entries(read_pages(spark, targets)[0]))
    if single_targets:
        files = spark.read.text(single_targets, wholetext=True).select(F.try_parse_json("value").alias("entry")).filter("entry is not null")
        wanted = own.select("target_id").join(models, "target_id", "left_anti").distinct()
        models = models.unionByName(target_entries(files).join(wanted, "target_id", "left_semi"))
    texts = read_files(spark, sources) if isinstance(sources, str) else sources
    known = own.select("asset_id").union(aliases.select("alias"))
    edges = graph.extract_edges(source_listing(pages_of(texts, SOURCE_KEYS, asset_from)[0]), "dataset", ["inode_id", "asset_id", "id"], known=known, normalise=False)
    edges = kept(graph.resolve_aliases(edges.join(own.select(F.col("asset_id").alias("child")), "child", "left_semi"), aliases), "edges")
    return graph.dependency_table(own, edges, models, run_id, created_at)
