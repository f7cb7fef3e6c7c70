"""Folding many edit logs into one inventory table, incrementally and as joins.

A log row has log_name, edit_num, ds_id, ts, metadata (JSON) and edit (JSON). The inventory's key is
(table_name, scan_schema).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.functions.columns import join_key, legacy_flag, org_slug

#: Keys of a log row's metadata that may hold the workbook's url, in order of preference.
URL_KEYS = ("appUrl", "workbookUrl")
#: What enrichment tells of a workbook id.
ENRICHMENT = ("workbook_name", "workbook_path", "object_type", "api_url", "owner_id", "is_archived", "owner_first_name", "owner_last_name", "is_tagged", "version_tag", "parent_workbook_id")
#: The columns of an inventory record, in order.
RECORD = (
    "log_name", "ds_id", "table_name", "scan_schema", "workbook_id", "workbook_url", "org_slug", "input_name", "last_edit_at", "last_edit_by",
    "workbook_name", "workbook_path", "object_type", "table_id", "table_location", "table_created_at", "table_modified_at", "size_bytes",
    "max_edit_num", "log_modified_at", "is_orphaned", "is_deleted", "deleted_at", "is_legacy", "is_tagged", "version_tag", "parent_workbook_id",
    "api_url", "owner_id", "is_archived", "owner_first_name", "owner_last_name",
)


def discover_logs(inventory: DataFrame, prefix: str = "wal", name_col: str = "name") -> DataFrame:
    """(log_name): the tables whose name begins with the prefix, without regard to case."""
    return inventory.filter(F.startswith(F.lower(name_col), F.lit(prefix.lower()))).select(F.col(name_col).alias("log_name")).distinct()


def changed_logs(logs: DataFrame, inventory: DataFrame, scan_schema: str) -> DataFrame:
    """Logs (log_name, last_modified) never seen in the schema, or modified since the stored watermark."""
    marks = inventory.filter(F.col("scan_schema") == scan_schema).groupBy("log_name").agg(F.max("log_modified_at").alias("_mark"))
    return logs.join(marks, "log_name", "left").filter("_mark is null or last_modified > _mark").select(*logs.columns)


def parsed_log(log: DataFrame, url_keys: tuple = URL_KEYS) -> DataFrame:
    """Log rows with what their JSON tells, under the first key present. url_keys: where the workbook's url may be."""
    meta = lambda *keys: F.coalesce(*(F.get_json_object("metadata", f"$.{k}") for k in keys))
    edit = lambda kind: F.get_json_object("edit", f"$.{kind}.blameInfo.updatedBy")
    url = meta(*url_keys)
    return log.select(
        "log_name",
        F.col("edit_num").alias("max_edit_num"),
        F.col("ds_id").cast("string").alias("ds_id"),
        F.col("ts").alias("last_edit_at"),
        meta("tableName").alias("table_name"),
        meta("workbookId").alias("workbook_id"),
        url.alias("workbook_url"),
        meta("elementTitle", "inputTableTitle").alias("input_name"),
        F.coalesce(meta("userEmail"), edit("updateRow"), edit("addRow")).alias("last_edit_by"),
        org_slug(url).alias("org_slug"),
    )


def latest_edit_per_table(log: DataFrame, url_keys: tuple = URL_KEYS) -> DataFrame:
    """The row of the highest edit number of each table in each log; rows without a table name don't count.

    The JSON is parsed once for the name, and in full only for the rows that stay.
    """
    named = log.withColumn("_t", F.get_json_object("metadata", "$.tableName")).filter("_t is not null")
    order = Window.partitionBy("log_name", "_t").orderBy(F.col("edit_num").desc_nulls_last(), F.col("ts").desc_nulls_last(), "metadata", "edit")
    return parsed_log(named.withColumn("_k", F.row_number().over(order)).filter("_k = 1").drop("_k", "_t"), url_keys)


def dedup_across_logs(records: DataFrame) -> DataFrame:
    """One record per table: the highest edit number (null counts as 0), then the smallest log name."""
    order = Window.partitionBy("table_name").orderBy(F.coalesce("max_edit_num", F.lit(0)).desc(), F.col("log_name").asc_nulls_last())
    return records.filter("table_name is not null").withColumn("_k", F.row_number().over(order)).filter("_k = 1").drop("_k")


def orphan_flags(records: DataFrame, tables: DataFrame, name_col: str = "name") -> DataFrame:
    """records with is_orphaned: no table of that name, without regard to case."""
    there = tables.select(F.lower(name_col).alias("_n")).filter("_n is not null").distinct().withColumn("_there", F.lit(True))
    return records.withColumn("_n", F.lower("table_name")).join(there, "_n", "left").withColumn("is_orphaned", F.col("_there").isNull()).drop("_n", "_there")


def orphan_changes(inventory: DataFrame, tables: DataFrame, batch: DataFrame, scan_schema: str, name_col: str = "name") -> DataFrame:
    """(table_name, is_orphaned) of stored tables of the schema, not in this batch, whose flag changes."""
    stored = inventory.filter((F.col("scan_schema") == scan_schema) & F.col("table_name").isNotNull()).select("table_name", F.coalesce("is_orphaned", F.lit(False)).alias("_was")).distinct()
    now = orphan_flags(stored.join(batch.select("table_name"), "table_name", "left_anti"), tables, name_col)
    return now.filter(F.col("is_orphaned") != F.col("_was")).select("table_name", "is_orphaned")


def deletion_flags(inventory: DataFrame, logs: DataFrame, scan_schema: str, as_of: Column, complete: bool = True) -> DataFrame:
    """The inventory with is_deleted and deleted_at set by whether each row's log exists.

    Vanished: deleted, with the time if it wasn't yet. Back again: cleared. Other schemas' rows, rows without
    a log, and all rows if the list of logs is not complete, stay as they are.
    """
    if not complete:
        return inventory
    there = logs.select("log_name").distinct().withColumn("_there", F.lit(True))
    out = inventory.join(there, "log_name", "left")
    here = (F.col("scan_schema") == scan_schema) & F.col("log_name").isNotNull()
    gone = here & F.col("_there").isNull() & ~F.coalesce("is_deleted", F.lit(False))
    back = here & F.col("_there").isNotNull() & F.coalesce("is_deleted", F.lit(False))
    deleted = F.when(gone, True).when(back, False).otherwise(F.col("is_deleted"))
    at = F.when(gone, as_of).when(~back, F.col("deleted_at"))
    return out.withColumns({"is_deleted": deleted, "deleted_at": at}).select(*inventory.columns)


def infer_id_column(df: DataFrame, target_ids: DataFrame) -> DataFrame:
    """One row (id_column, matches): the column with "id" in its name whose values overlap the targets (column id) most.

    Values compare without case and surrounding spaces; of equal columns the first wins. One pass over df.
    """
    names = [c for c in df.columns if "id" in c.lower()] or ["id"]
    cells = df.select(F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.lit(c).alias("id_column"), join_key(F.col(c).cast("string")).alias("v")) for k, c in enumerate(names)))).alias("c")).select("c.*")
    ids = target_ids.select(join_key(F.col("id").cast("string")).alias("v")).distinct()
    found = cells.join(ids, "v", "left_semi").groupBy("k", "id_column").agg(F.countDistinct("v").alias("matches"))
    best = found.agg(F.max_by(F.struct("id_column", "matches"), F.struct("matches", -F.col("k"))).alias("b")).select(F.coalesce("b.id_column", F.lit(names[0])).alias("id_column"), F.coalesce("b.matches", F.lit(0)).alias("matches"))
    return best


def _path(df: DataFrame) -> Column:
    """The column path as text, whether it is one or a list of parts."""
    return F.array_join("path", "/") if df.schema["path"].dataType.typeName() == "array" else F.col("path")


def tag_index(tagged: DataFrame) -> DataFrame:
    """(key, and the parent's attributes) for each tagged version. tagged: workbook_id, name, path (list), url, owner_id, tags[](tagged_id, name)."""
    rows = tagged.select("workbook_id", "name", _path(tagged).alias("path"), "url", "owner_id", F.explode("tags").alias("t")).filter("t.tagged_id is not null")
    rows = rows.select(join_key(F.col("t.tagged_id")).alias("key"), F.col("workbook_id").alias("parent_workbook_id"), F.col("t.name").alias("version_tag"), F.col("name").alias("workbook_name"), F.col("path").alias("workbook_path"), F.col("url").alias("api_url"), "owner_id")
    order = Window.partitionBy("key").orderBy("parent_workbook_id", "version_tag")
    return rows.withColumn("_k", F.row_number().over(order)).filter("_k = 1").drop("_k")


def _listing(df: DataFrame, id_col: str, archived: bool) -> DataFrame:
    """A listing by key: one entry for each."""
    flag = F.coalesce("is_archived", F.lit(False)) if archived else F.lit(False)
    rows = df.filter(F.col(id_col).isNotNull()).select(join_key(F.col(id_col)).alias("key"), F.struct("name", _path(df).alias("path"), "url", "owner_id", flag.alias("archived")).alias("e"))
    return rows.groupBy("key").agg(F.min("e").alias("e"))


def enrich_owner_object(ids: DataFrame, workbooks: DataFrame, models: DataFrame, tags: DataFrame, members: DataFrame) -> DataFrame:
    """(workbook_id, ENRICHMENT) of the ids that a listing knows: workbook before model before tagged version.

    Models are never archived; a tagged version is if its parent is. workbooks and models: id, name, path (list),
    url, owner_id (workbooks: is_archived); tags: tag_index(); members: member_id, first_name, last_name.
    """
    w, m = _listing(workbooks, "id", True), _listing(models, "id", False)
    rows = ids.select("workbook_id").filter("workbook_id is not null").distinct().withColumn("key", join_key(F.col("workbook_id")))
    rows = rows.join(w.select("key", F.col("e").alias("w")), "key", "left").join(m.select("key", F.col("e").alias("m")), "key", "left")
    t = tags.withColumn("p", join_key(F.col("parent_workbook_id"))).join(w.select(F.col("key").alias("p"), F.col("e.archived").alias("archived")), "p", "left").select("key", F.struct(F.col("workbook_name").alias("name"), F.col("workbook_path").alias("path"), F.col("api_url").alias("url"), "owner_id", F.coalesce("archived", F.lit(False)).alias("archived"), "version_tag", "parent_workbook_id").alias("t"))
    rows = rows.join(t, "key", "left").filter("w is not null or m is not null or t is not null")
    kind = F.when(F.col("w").isNotNull(), 0).when(F.col("m").isNotNull(), 1).otherwise(2)
    pick = lambda f: F.when(kind == 0, F.col(f"w.{f}")).when(kind == 1, F.col(f"m.{f}")).otherwise(F.col(f"t.{f}"))
    out = rows.select("workbook_id", pick("name").alias("workbook_name"), pick("path").alias("workbook_path"), F.when(kind == 1, "DATA_MODEL").otherwise("WORKBOOK").alias("object_type"), pick("url").alias("api_url"), pick("owner_id").alias("owner_id"), pick("archived").alias("is_archived"), (kind == 2).alias("is_tagged"), F.when(kind == 2, F.col("t.version_tag")).alias("version_tag"), F.when(kind == 2, F.col("t.parent_workbook_id")).alias("parent_workbook_id"))
    people = members.filter("member_id is not null").groupBy(join_key(F.col("member_id")).alias("_o")).agg(F.min(F.struct("first_name", "last_name")).alias("_m"))
    out = out.withColumn("_o", join_key(F.col("owner_id"))).join(people, "_o", "left")
    return out.select("workbook_id", *(F.col("_m.first_name" if c == "owner_first_name" else "_m.last_name" if c == "owner_last_name" else c).alias(c) for c in ENRICHMENT))


def ids_to_enrich(records: DataFrame, inventory: DataFrame, retry_empty: bool = True) -> DataFrame:
    """(workbook_id) of records that the inventory doesn't know yet; with retry_empty, also those stored without any enrichment."""
    known = inventory.filter("workbook_id is not null")
    if retry_empty:
        known = known.filter(F.coalesce(*(F.col(c).cast("string") for c in ENRICHMENT if c != "is_tagged")).isNotNull())
    return records.select("workbook_id").filter("workbook_id is not null").distinct().join(known.select("workbook_id"), "workbook_id", "left_anti")


def refresh_archived(inventory: DataFrame, workbooks: DataFrame, models: DataFrame) -> DataFrame:
    """(workbook_id, is_archived) of stored ids whose archived flag changes.

    A listed workbook has its listing's flag, a model none, a tagged version its parent's; ids in no listing stay as they are.
    """
    w = _listing(workbooks, "id", True).select("key", F.col("e.archived").alias("_w"))
    m = _listing(models, "id", False).select("key", F.lit(True).alias("_m"))
    stored = inventory.filter("workbook_id is not null").groupBy("workbook_id").agg(F.min(F.struct("table_name", "scan_schema", "object_type", "is_tagged", "parent_workbook_id", "is_archived")).alias("s"))
    rows = stored.withColumn("key", join_key(F.col("workbook_id"))).join(w, "key", "left").join(m, "key", "left")
    rows = rows.withColumn("p", join_key(F.col("s.parent_workbook_id"))).join(w.select(F.col("key").alias("p"), F.col("_w").alias("_p")), "p", "left")
    model = F.col("_m").isNotNull() | (F.col("s.object_type") == "DATA_MODEL")
    now = F.when(F.col("_w").isNotNull(), F.col("_w")).when(model, False).when(F.col("s.is_tagged") == F.lit(True), F.col("_p"))
    rows = rows.select("workbook_id", now.alias("is_archived"), F.col("s.is_archived").alias("_was"))
    return rows.filter(F.col("is_archived").isNotNull() & ~F.col("is_archived").eqNullSafe(F.col("_was"))).select("workbook_id", "is_archived")


def assemble_records(records: DataFrame, logs: DataFrame, tables: DataFrame, fresh: DataFrame, cached: DataFrame | None, scan_schema: str) -> DataFrame:
    """Inventory rows (RECORD): records with their table's details, log's time, flags and enrichment.

    Enrichment is a fresh row as a whole, else the cached one of the id (its first by table name), else empty.
    """
    known = fresh.select("workbook_id", F.struct(*ENRICHMENT).alias("_f"))
    rows = records.join(known, "workbook_id", "left")
    if cached is not None:
        old = cached.filter("workbook_id is not null").groupBy("workbook_id").agg(F.min_by(F.struct(*ENRICHMENT), F.struct("table_name", "scan_schema")).alias("_c"))
        rows = rows.join(old, "workbook_id", "left").withColumn("_f", F.coalesce("_f", "_c")).drop("_c")
    rows = orphan_flags(rows, tables)
    details = tables.groupBy(F.lower("name").alias("_n")).agg(F.min(F.struct("table_id", F.col("location").alias("table_location"), F.col("created_at").alias("table_created_at"), F.col("last_modified").alias("table_modified_at"), "size_bytes")).alias("_d"))
    rows = rows.withColumn("_n", F.lower("table_name")).join(details, "_n", "left").join(logs.select("log_name", F.col("last_modified").alias("log_modified_at")), "log_name", "left")
    for c in ENRICHMENT:
        rows = rows.withColumn(c, F.col(f"_f.{c}"))
    rows = rows.withColumns({"scan_schema": F.lit(scan_schema), "is_deleted": F.lit(False), "deleted_at": F.lit(None).cast("timestamp_ntz"), "is_legacy": legacy_flag(F.col("log_name")), "is_tagged": F.coalesce("is_tagged", F.lit(False))})
    return rows.select("*", "_d.*").select(*RECORD)


def recent_entries(inventory: DataFrame, n: int = 20, by: str = "table_modified_at", scan_schema: str | None = None) -> DataFrame:
    """The n most recently modified rows, of all schemas or of one."""
    if scan_schema is not None:
        inventory = inventory.filter(F.col("scan_schema") == scan_schema)
    return inventory.orderBy(F.col(by).desc_nulls_last(), "table_name").limit(n)
