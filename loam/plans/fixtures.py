"""Catalog-shaped tables derived from the given ones, as SQL that Spark and DuckDB both run.

{ts} stands for the engine's keyword of a timestamp without zone.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-08-02"
SCHEMA = "schema_1"

VIEWS = {
    "fx_asset": """
        select p_partkey as asset_id, 'ds_' || cast(p_partkey as varchar(20)) as name, '/p/' || cast(p_partkey % 7 as varchar(20)) as path,
               'https://h/d/' || cast(p_partkey as varchar(20)) as url,
               case when p_size % 3 = 0 then 'migrated' when p_size % 3 = 1 then 'not-migrated' else 'not-required' end as status,
               case when p_size % 3 = 0 then 'dm_' || cast(p_partkey as varchar(20)) end as target_id,
               case when p_size % 3 = 0 then {ts} '2001-06-01' end as migrated_at
        from part""",
    "fx_target": """
        select 'dm_' || cast(p_partkey as varchar(20)) as target_id, p_name as name, 'https://h/m/' || cast(p_partkey as varchar(20)) as url
        from part where p_size % 3 = 0 and p_partkey % 10 <> 0""",
    "fx_edge": """
        select distinct child, parent from (
          select p_partkey as child, cast(floor(p_partkey / 2) as bigint) as parent from part where p_partkey >= 20 and p_partkey % 11 <> 0
          union all
          select p_partkey as child, cast(floor(p_partkey / 3) as bigint) + 1 as parent from part where p_partkey >= 20 and p_partkey % 11 <> 0 and p_partkey % 4 = 0) e""",
    "fx_workbook": """
        select o_orderkey as workbook_id, case when o_orderkey % 7 = 0 then null else 'wb ' || cast(o_orderkey as varchar(20)) end as name,
               'https://h/w/' || cast(o_orderkey as varchar(20)) as url, '/w' as path, 'own ' || cast(o_custkey % 12 as varchar(20)) as owner_name,
               'o@x' as owner_email, o_orderdate as created_at, o_orderdate as updated_at
        from orders""",
    "fx_source": """
        select l_orderkey as workbook_id,
               case when l_partkey % 9 = 4 then 'table' when (l_partkey + l_suppkey) % 5 in (0, 1) then 'dataset' when (l_partkey + l_suppkey) % 5 in (2, 3) then 'data-model' else 'table' end as source_type,
               case when l_partkey % 9 <> 4 and (l_partkey + l_suppkey) % 5 in (0, 1) then l_partkey end as inode_id,
               case when l_partkey % 9 <> 4 and (l_partkey + l_suppkey) % 5 in (2, 3) then 'dm_' || cast(l_partkey as varchar(20)) end as data_model_id
        from lineitem""",
    "fx_log": """
        select case when event_type in ('click', 'error') then 'wal_ds_' else 'wal_' end || event_type || '_' || cast(user_id % 4 as varchar(20)) as log_name,
               event_id as edit_num, user_id as ds_id, ts,
               case when event_id % 29 = 0 then '{{"workbookId":"x"}}'
                    when event_id % 2 = 0 then '{{"tableName":"in_' || cast(user_id as varchar(20)) || '","workbookId":"wb_' || cast(user_id as varchar(20))
                         || '","appUrl":"https://h/org' || cast(user_id % 3 as varchar(20)) || '/wb/1","elementTitle":"el_' || cast(user_id % 9 as varchar(20)) || '"}}'
                    else '{{"tableName":"in_' || cast(user_id as varchar(20)) || '","workbookId":"wb_' || cast(user_id as varchar(20))
                         || '","workbookUrl":"https://h/org' || cast(user_id % 3 as varchar(20)) || '/wb/2","inputTableTitle":"in_' || cast(user_id % 9 as varchar(20)) || '","userEmail":"u@x"}}' end as metadata,
               case when event_id % 4 = 0 then '{{"updateRow":{{"blameInfo":{{"updatedBy":"up@x"}}}}}}' else '{{"addRow":{{"blameInfo":{{"updatedBy":"add@x"}}}}}}' end as edit
        from events""",
    "fx_map": """
        select 'in_' || cast(c_custkey as varchar(20)) as table_name, 'schema_' || cast(c_nationkey % 3 as varchar(20)) as scan_schema,
               case when c_custkey % 3 = 0 then 'wal_' else 'wal_ds_' end || cast(c_custkey as varchar(20)) as log_name,
               case when c_custkey % 103 = 0 then null else 'wbid_' || cast(c_custkey % 97 as varchar(20)) end as workbook_id,
               case when c_custkey % 5 = 0 then null else 'wb ' || cast(c_custkey % 97 as varchar(20)) end as workbook_name,
               case when (case when c_custkey % 17 = 0 then c_custkey + 1 else c_custkey end) % 97 % 5 = 0 then 'in_0' else 'in_' || cast(c_custkey % 8 as varchar(20)) end as input_name,
               'https://h/org/' || cast(c_custkey as varchar(20)) as workbook_url, 'u' || cast(c_custkey % 11 as varchar(20)) || '@x' as last_edit_by,
               o.last_at as last_edit_at, o.n as max_edit_num, o.mod_at as table_modified_at,
               case when c_custkey % 13 = 0 then null else o.bytes end as size_bytes,
               c_custkey % 13 = 0 as is_orphaned, case when c_custkey % 101 = 0 then null else c_custkey % 11 = 0 end as is_deleted,
               case when c_custkey % 22 = 0 then {ts} '2001-05-05' end as deleted_at,
               c_custkey % 3 = 0 as is_legacy, c_custkey % 17 = 0 as is_tagged, case when c_custkey % 17 = 0 then 'Prod' end as version_tag,
               case when c_custkey % 17 = 0 then 'wbid_' || cast((c_custkey + 1) % 97 as varchar(20)) end as parent_workbook_id,
               case when c_custkey % 10 = 3 then null else 'own_' || cast(c_custkey % 12 as varchar(20)) end as owner_id,
               case when c_custkey % 7 = 0 then true when c_custkey % 7 in (1, 2) then null else false end as is_archived,
               case when c_custkey % 19 = 4 then 'DATA_MODEL' else 'WORKBOOK' end as object_type,
               case when c_custkey % 12 = 5 then null else 'First' || cast(c_custkey % 12 as varchar(20)) end as owner_first_name,
               case when c_custkey % 12 = 6 then null else 'Last' || cast(c_custkey % 12 as varchar(20)) end as owner_last_name,
               o.mod_at as log_modified_at
        from customer
        left join (select o_custkey, max(o_orderdate) as last_at, max(case when o_orderstatus = 'F' then o_orderdate end) as mod_at,
                          cast(sum(cast(floor(o_totalprice) as bigint)) * (o_custkey % 1009) as bigint) as bytes,
                          case when o_custkey % 19 = 0 then 0 else count(*) * (1 + o_custkey % 40) end as n
                   from orders group by o_custkey) o on o.o_custkey = c_custkey""",
    # listings: workbooks, models and tagged versions by supplier, members by nation
    "fx_lst_workbook": "select ' WB_' || cast(s_suppkey as varchar(20)) as id, s_name as name, 'https://h/' || s_name as url, 'M_' || cast(s_nationkey as varchar(20)) as owner_id, case when s_suppkey % 9 = 0 then null else s_suppkey % 5 = 0 end as is_archived from supplier where s_suppkey % 4 in (0, 1)",
    "fx_lst_model": "select 'wb_' || cast(s_suppkey as varchar(20)) as id, s_name as name, 'https://h/m' as url, 'm_' || cast(s_nationkey as varchar(20)) as owner_id from supplier where s_suppkey % 4 = 2",
    "fx_lst_tagged": "select 'wb_' || cast(s_suppkey - 3 as varchar(20)) as workbook_id, s_name as name, 'https://h/t' as url, 'm_' || cast(s_nationkey as varchar(20)) as owner_id, 'wb_' || cast(s_suppkey as varchar(20)) as tagged_id, 'tag' || cast(s_suppkey % 3 as varchar(20)) as tag from supplier where s_suppkey % 4 = 3",
    "fx_member": "select 'm_' || cast(n_nationkey as varchar(20)) as member_id, n_name as first_name, 'L' || cast(n_regionkey as varchar(20)) as last_name from nation where n_nationkey % 6 <> 5",
    # what the catalog holds now
    "fx_table": "select distinct upper('in_' || cast(user_id as varchar(20))) as name from events where user_id % 7 <> 3",
    "fx_logs": "select log_name, max(ts) as last_modified from fx_log group by log_name",
    "fx_marks": """
        select log_name, 'schema_1' as scan_schema, case when log_name like '%_1' then last_modified - interval 1 day else last_modified end as log_modified_at from fx_logs where not log_name like '%_0'
        union all select 'wal_gone' as log_name, 'schema_1' as scan_schema, max(last_modified) as log_modified_at from fx_logs""",
}

DEPENDS = {"fx_logs": ("fx_log",), "fx_marks": ("fx_log", "fx_logs")}
TABLES = ("part", "lineitem", "orders", "events", "customer", "supplier", "nation")


@cache
def sql(name: str, spark: bool) -> str:
    return VIEWS[name].format(ts="timestamp_ntz" if spark else "timestamp")


def with_views(*names: str) -> str:
    """WITH ... for DuckDB, with what the named views need."""
    order = list(dict.fromkeys(x for n in names for x in (*DEPENDS.get(n, ()), n)))
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({sql(n, False)})" for n in order)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as a DataFrame. Only the tables and columns that it names are read."""
    text = sql(name, True)
    sources = {}
    for other in DEPENDS.get(name, ()):
        if re.search(rf"\b{other}\b", text):
            sources[other] = view(spark, sf_dir, other)
    for t in TABLES:
        if re.search(rf"\bfrom {t}\b", text):
            sources[t] = spark.read.parquet(f"{sf_dir}/{t}.parquet")
    # each source by name as a DataFrame argument, so that no temporary view outlives the call
    for s in sources:
        text = re.sub(rf"\bfrom {s}\b", f"from {{{s}}}", text)
    return spark.sql(_quoted(text, sources), **sources)


def _quoted(text: str, sources: dict) -> str:
    """Double all braces but those around the sources' names."""
    out = text.replace("{", "{{").replace("}", "}}")
    for s in sources:
        out = out.replace(f"{{{{{s}}}}}", f"{{{s}}}")
    return out


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")
