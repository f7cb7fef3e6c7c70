"""DuckDB SQL for the registered catalog queries, over the same derived views."""

from __future__ import annotations

from loam.functions import wording as w
from loam.functions.wording import told_sql
from loam.plans.fixtures import AS_OF, with_views

TS = f"timestamp '{AS_OF}'"
#: The current run's dependency rows.
DEP = """
 up AS (SELECT child, count(DISTINCT parent) AS n FROM fx_edge GROUP BY child),
 dn AS (SELECT parent, count(DISTINCT child) AS n FROM fx_edge GROUP BY parent),
 nodes AS (
   SELECT a.*, coalesce(up.n, 0) AS n_parents, coalesce(dn.n, 0) AS n_children,
          CASE WHEN up.n IS NULL THEN 'ROOT' WHEN dn.n IS NULL THEN 'LEAF' ELSE 'INTERNAL' END AS role
   FROM fx_asset a LEFT JOIN up ON up.child = a.asset_id LEFT JOIN dn ON dn.parent = a.asset_id),
 dep AS (
   SELECT n.role, n.asset_id, n.name AS asset_name, n.path AS asset_path, n.url AS asset_url, n.status, n.migrated_at, n.target_id,
          t.name AS target_name, t.url AS target_url, e.parent AS parent_id, coalesce(p.name, CAST(e.parent AS VARCHAR)) AS parent_name, p.status AS parent_status, n.n_parents, n.n_children
   FROM nodes n LEFT JOIN fx_edge e ON e.child = n.asset_id LEFT JOIN fx_asset p ON p.asset_id = e.parent LEFT JOIN fx_target t ON t.target_id = n.target_id)"""
GRAPH = ("fx_asset", "fx_target", "fx_edge")

#: Sources with the asset behind them, and what follows from it.
MAP = f"""{DEP},
 by_target AS (SELECT min(asset_id) AS asset_id, target_id FROM nodes WHERE target_id IS NOT NULL GROUP BY target_id),
 src AS (
   SELECT s.*, coalesce(a.asset_id, t.asset_id) AS asset_id
   FROM fx_source s LEFT JOIN fx_asset a ON s.source_type = 'dataset' AND a.asset_id = s.inode_id
        LEFT JOIN by_target t ON s.source_type = 'data-model' AND t.target_id = s.data_model_id),
 details AS (
   SELECT s.workbook_id, coalesce(w.name, CAST(s.workbook_id AS VARCHAR)) AS workbook_name, s.inode_id, s.data_model_id, s.source_type,
          n.asset_id, n.name AS asset_name, n.url AS asset_url, n.status, n.role, n.target_id, n.migrated_at, t.name AS target_name, t.url AS target_url, n.n_parents, n.n_children
   FROM src s JOIN nodes n ON n.asset_id = s.asset_id LEFT JOIN fx_workbook w ON w.workbook_id = s.workbook_id LEFT JOIN fx_target t ON t.target_id = n.target_id),
 counted AS (
   SELECT workbook_id, count(*) FILTER (asset_id IS NOT NULL AND source_type = 'dataset') AS dataset_sources,
          count(*) FILTER (asset_id IS NOT NULL AND source_type = 'data-model') AS data_model_sources, count(*) FILTER (source_type = 'table') AS table_sources
   FROM src GROUP BY workbook_id),
 summary AS (
   SELECT c.workbook_id, coalesce(w.name, CAST(c.workbook_id AS VARCHAR)) AS workbook_name, w.url AS workbook_url, w.owner_name, w.owner_email,
          dataset_sources + data_model_sources AS total_sources, dataset_sources, data_model_sources, table_sources,
          CASE WHEN dataset_sources = 0 THEN 'FULLY MIGRATED' WHEN data_model_sources = 0 THEN 'NOT MIGRATED' ELSE 'PARTIALLY MIGRATED' END AS migration_status
   FROM counted c LEFT JOIN fx_workbook w USING (workbook_id) WHERE dataset_sources + data_model_sources > 0)"""
BOOKS = (*GRAPH, "fx_workbook", "fx_source")

WALK = f"""{DEP},
 walk AS (
   SELECT DISTINCT asset_id, role, 0 AS depth, [asset_id] AS ids, [asset_name] AS names, [status] AS states FROM dep WHERE role = 'ROOT'
   UNION ALL
   SELECT d.asset_id, d.role, w.depth + 1, list_append(w.ids, d.asset_id), list_append(w.names, d.asset_name), list_append(w.states, d.status)
   FROM walk w JOIN dep d ON d.parent_id = w.asset_id WHERE w.depth < {{hops}})"""

#: Log rows with what their JSON tells.
LOG = """
 parsed AS (
   SELECT log_name, edit_num AS max_edit_num, CAST(ds_id AS VARCHAR) AS ds_id, ts AS last_edit_at,
          json_extract_string(metadata, '$.tableName') AS table_name, json_extract_string(metadata, '$.workbookId') AS workbook_id,
          coalesce(json_extract_string(metadata, '$.appUrl'), json_extract_string(metadata, '$.workbookUrl')) AS workbook_url,
          coalesce(json_extract_string(metadata, '$.elementTitle'), json_extract_string(metadata, '$.inputTableTitle')) AS input_name,
          coalesce(json_extract_string(metadata, '$.userEmail'), json_extract_string(edit, '$.updateRow.blameInfo.updatedBy'), json_extract_string(edit, '$.addRow.blameInfo.updatedBy')) AS last_edit_by
   FROM fx_log),
 per_log AS (
   SELECT *, split_part(workbook_url, '/', 4) AS org_slug FROM parsed WHERE table_name IS NOT NULL
   QUALIFY row_number() OVER (PARTITION BY log_name, table_name ORDER BY max_edit_num DESC) = 1),
 latest AS (SELECT * FROM per_log QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY max_edit_num DESC, log_name) = 1)"""

#: Listings joined to the ids of the latest edits.
ENRICH = f"""{LOG},
 wb AS (SELECT lower(trim(id)) AS key, name, 'b/' || name AS path, url, owner_id, coalesce(is_archived, false) AS archived FROM fx_lst_workbook),
 md AS (SELECT id AS key, name, name AS path, url, owner_id FROM fx_lst_model),
 tg AS (SELECT t.*, 'a/' || t.name AS path, coalesce(wb.archived, false) AS archived FROM fx_lst_tagged t LEFT JOIN wb ON wb.key = t.workbook_id),
 ids AS (SELECT DISTINCT workbook_id FROM latest),
 picked AS (
   SELECT i.workbook_id, coalesce(wb.name, md.name, tg.name) AS workbook_name, coalesce(wb.path, md.path, tg.path) AS workbook_path,
          CASE WHEN wb.key IS NULL AND md.key IS NOT NULL THEN 'DATA_MODEL' ELSE 'WORKBOOK' END AS object_type, coalesce(wb.url, md.url, tg.url) AS api_url,
          coalesce(wb.owner_id, md.owner_id, tg.owner_id) AS owner_id,
          CASE WHEN wb.key IS NOT NULL THEN wb.archived WHEN md.key IS NOT NULL THEN false ELSE tg.archived END AS is_archived,
          wb.key IS NULL AND md.key IS NULL AS is_tagged,
          CASE WHEN wb.key IS NULL AND md.key IS NULL THEN tg.tag END AS version_tag,
          CASE WHEN wb.key IS NULL AND md.key IS NULL THEN tg.workbook_id END AS parent_workbook_id
   FROM ids i LEFT JOIN wb ON wb.key = lower(trim(i.workbook_id)) LEFT JOIN md ON md.key = lower(trim(i.workbook_id)) LEFT JOIN tg ON tg.tagged_id = lower(trim(i.workbook_id))
   WHERE wb.key IS NOT NULL OR md.key IS NOT NULL OR tg.tagged_id IS NOT NULL),
 enriched AS (SELECT p.*, m.first_name AS owner_first_name, m.last_name AS owner_last_name FROM picked p LEFT JOIN fx_member m ON m.member_id = lower(p.owner_id))"""
LISTS = ("fx_log", "fx_lst_workbook", "fx_lst_model", "fx_lst_tagged", "fx_member")

EDIT = "log_name, table_name, max_edit_num, ds_id, last_edit_at, workbook_id, workbook_url, input_name, last_edit_by, org_slug"
OWNER = "trim(coalesce(owner_first_name, '') || ' ' || coalesce(owner_last_name, ''))"
AGE = f"datesub('day', last_edit_at, {TS})"
MB = "round(CAST(coalesce(size_bytes, 0) AS DOUBLE) / 1048576, 2)"
SUM_GB = "round(CAST(sum({}) AS DOUBLE) / 1073741824, 3)"
SIGNAL = "(coalesce(is_orphaned, false) OR coalesce(is_deleted, false) OR coalesce(is_archived, false))"
LIVE = "is_orphaned = false AND is_deleted = false"
TOTALS = f"{SUM_GB.format('coalesce(size_bytes, 0)')} AS total_gb, {SUM_GB.format(f'CASE WHEN {SIGNAL} THEN coalesce(size_bytes, 0) ELSE 0 END')} AS reclaimable_gb"

SCORED = f"""
 aged AS (SELECT *, {AGE} AS days_since_edit, datesub('day', table_modified_at, {TS}) AS days_since_change, {MB} AS size_mb, {OWNER} AS owner FROM fx_map),
 parts AS (
   SELECT *,
     CASE WHEN is_orphaned THEN 30 WHEN is_deleted AND NOT is_orphaned THEN 25 WHEN is_archived AND {LIVE} THEN 20
          WHEN workbook_name IS NULL AND is_archived IS NULL AND {LIVE} THEN 15 ELSE 0 END AS score_status,
     CASE WHEN coalesce(days_since_edit, 999) > 365 THEN 25 WHEN days_since_edit > 180 THEN 18 WHEN days_since_edit > 90 THEN 10 WHEN days_since_edit > 30 THEN 4 ELSE 0 END AS score_edit_recency,
     CASE WHEN coalesce(days_since_change, 999) > 365 THEN 15 WHEN days_since_change > 180 THEN 10 WHEN days_since_change > 90 THEN 5 ELSE 0 END AS score_table_recency,
     CASE WHEN coalesce(max_edit_num, 0) = 0 THEN 10 WHEN max_edit_num <= 10 THEN 8 WHEN max_edit_num <= 50 THEN 5 WHEN max_edit_num <= 200 THEN 2 ELSE 0 END AS score_edit_volume,
     CASE WHEN NOT is_legacy THEN 0 WHEN days_since_edit < 180 THEN 10 ELSE 5 END AS score_legacy,
     CASE WHEN size_bytes > 1073741824 THEN 10 WHEN size_bytes > 104857600 THEN 7 WHEN size_bytes > 10485760 THEN 4 ELSE 1 END AS score_storage,
     CASE WHEN is_tagged THEN -15 ELSE 0 END AS penalty_tagged
   FROM aged),
 total AS (SELECT *, greatest(0, least(100, score_status + score_edit_recency + score_table_recency + score_edit_volume + score_legacy + score_storage + penalty_tagged)) AS total_score FROM parts),
 scored AS (
   SELECT *, CASE {" ".join(f"WHEN total_score >= {least} THEN '{name}'" for least, name in w.TIERS)} END AS tier
   FROM total)"""


def _q(views: tuple, ctes: str, select: str) -> str:
    return with_views(*views) + (f", {ctes}" if ctes else "") + " " + select


def _dep(select: str) -> str:
    return _q(GRAPH, DEP, select)


def _map(select: str) -> str:
    return _q(BOOKS, MAP, select)


def _inv(select: str) -> str:
    return _q(("fx_map",), "", select)


_DETAIL = "{0}name || '  [' || {0}status || ']  ID: ' || {0}id || '  Dataset: ' || coalesce(url, 'no url') || '  DataModel: ' || coalesce(target_url, 'not migrated')"
_URLS = "urls AS (SELECT DISTINCT asset_id AS uid, asset_url AS url, target_url FROM dep)"
_OWN = "asset_id, asset_name, asset_path, asset_url, status, target_id, target_name, target_url"


def _cross(kind: str, points: str, related: str, text: str, total: str, extra: str = "") -> str:
    n = lambda s: f"count(*) FILTER (rstatus = '{s}')"
    return _q(GRAPH, f"""{DEP}, {_URLS},
      pts AS (SELECT DISTINCT {_OWN}{extra}, {points} AS total_{kind} FROM dep WHERE {points} > 1),
      rel AS ({related}),
      agg AS (SELECT pid, {n('migrated')} AS done, {n('not-migrated')} AS waiting, {n('not-required')} AS skipped,
                     string_agg({_DETAIL.format('r')}, '  ||  ' ORDER BY rname, rid) AS details
              FROM rel JOIN urls ON uid = rid GROUP BY pid)""",
      f"""SELECT {", ".join("p." + c.strip() for c in (_OWN + extra).split(","))}, total_{kind}, done AS {kind}_migrated, waiting AS {kind}_not_migrated, skipped AS {kind}_not_required, details AS {total}, {text}
      FROM pts p JOIN agg ON pid = p.asset_id""")  # fmt: skip


def oracle_sql() -> dict[str, str]:
    levels = ", ".join(f"ids[{k + 1}] AS L{k}_asset_id, names[{k + 1}] AS L{k}_asset_name, states[{k + 1}] AS L{k}_status" for k in range(5))
    of = lambda s: f"count(*) FILTER (status = '{s}')"
    book = lambda s: f"count(*) FILTER (migration_status = '{s}')"
    roles = ", ".join(f"count(*) FILTER (role = '{r.upper()}') AS {r}_count" for r in ("root", "internal", "leaf"))
    return {
        "g1_extract_edges": _q(("fx_asset", "fx_edge"), "", """
            SELECT CAST(child AS VARCHAR) AS child, CASE WHEN parent % 3 = 0 THEN 'i_' ELSE '' END || parent AS parent
            FROM fx_edge WHERE parent IN (SELECT asset_id FROM fx_asset)"""),
        "g2_normalise_type": _q(("fx_source",), "", """
            SELECT upper(source_type) || '_x y' AS raw, source_type || '-x-y' AS kind, count(*) AS n FROM fx_source GROUP BY source_type"""),
        "g3_resolve_aliases": _q(("fx_edge",), "", "SELECT CAST(child AS VARCHAR) AS child, CAST(parent AS VARCHAR) AS parent FROM fx_edge"),
        "g4_complete_missing": _q(("fx_asset", "fx_edge"), "", """
            SELECT asset_id, name, status FROM fx_asset WHERE asset_id % 5 <> 0
            UNION ALL
            SELECT DISTINCT e.parent, a.name, CAST(NULL AS VARCHAR) FROM fx_edge e LEFT JOIN fx_asset a ON a.asset_id = e.parent AND a.asset_id % 10 = 0 WHERE e.parent % 5 = 0"""),
        "g5_degrees": _dep("SELECT asset_id, n_parents, n_children FROM nodes"),
        "g6_graph_role": _dep("SELECT asset_id, role FROM nodes"),
        "g7_dependency_table": _dep(f"""
            SELECT 'a1' AS run_id, {TS} AS created_at, * FROM dep UNION ALL SELECT 'f9', timestamp '2001-07-01', * FROM dep WHERE asset_id % 2 = 0"""),
        "g8_build_summary": _dep("""
            SELECT count(*) FILTER (role = 'ROOT') AS root_rows, count(*) FILTER (role = 'INTERNAL') AS internal_rows, count(*) FILTER (role = 'LEAF') AS leaf_rows,
                   count(DISTINCT asset_id) FILTER (n_children > 1) AS fork_points, count(DISTINCT asset_id) FILTER (n_parents > 1) AS merge_points, count(*) AS total_rows
            FROM dep"""),
        "g9_write_snapshot": _dep("SELECT 'a1' AS run_id, role, asset_id, parent_id, status FROM dep UNION ALL SELECT 'f9', role, asset_id, parent_id, status FROM dep WHERE asset_id % 2 = 0"),
        "g10_latest_run": _dep("""
            SELECT 'a1' AS run_id, count(*) AS n, 'created_at' AS by FROM dep UNION ALL SELECT 'f9', count(*), 'run_id' FROM dep WHERE asset_id % 2 = 0"""),
        "m1_dependency_lookup": _map("""
            SELECT 'asset' AS side, CAST(asset_id AS VARCHAR) AS key, asset_id, role, target_id FROM nodes
            UNION ALL SELECT 'target', n.target_id, n.asset_id, n.role, n.target_id FROM nodes n JOIN by_target USING (asset_id)"""),
        "m2_classify_sources": _map("SELECT source_type, asset_id IS NOT NULL AS in_scope, count(*) AS n, count(asset_id) AS known FROM src GROUP BY 1, 2"),
        "m3_source_details": _map("""
            SELECT 'a1' AS run_id, workbook_id, workbook_name, inode_id, data_model_id, source_type, asset_id, asset_name, status, role, target_id, n_parents, n_children FROM details"""),
        "m4_asset_summary": _map("""
            SELECT 'a1' AS run_id, workbook_id, workbook_name, owner_name, total_sources, dataset_sources, data_model_sources, table_sources, migration_status FROM summary"""),
        "m5_mapping_summary": _map(f"""
            SELECT (SELECT count(*) FROM fx_workbook) AS scanned, count(*) AS in_scope, {book('FULLY MIGRATED')} AS fully_migrated, {book('PARTIALLY MIGRATED')} AS partially_migrated,
                   {book('NOT MIGRATED')} AS not_migrated, (SELECT count(*) FROM details) AS relationships FROM summary"""),
        "c1_walk_chains": _q(GRAPH, WALK.format(hops=9), "SELECT asset_id, role, depth, array_to_string(ids, '>') AS ids FROM walk"),
        "c2_dataset_chains": _q(GRAPH, WALK.format(hops=9), f"""
            SELECT {levels}, array_to_string(names, ' → ') AS chain_path, CAST(len(ids) AS INTEGER) AS chain_length,
                   CASE WHEN NOT list_contains(states, 'not-migrated') THEN 'FULLY MIGRATED' WHEN list_contains(states, 'migrated') THEN 'PARTIALLY MIGRATED' ELSE 'NOT MIGRATED' END AS chain_status
            FROM walk w WHERE role = 'LEAF' OR depth = 0 AND NOT EXISTS (SELECT 1 FROM fx_edge e WHERE e.parent = w.asset_id)"""),
        "c3_model_chains": _q(GRAPH, WALK.format(hops=4), f"""
            SELECT w.ids[1] AS L0_asset_id, w.names[1] AS L0_asset_name, a.path AS L0_asset_path, a.url AS L0_asset_url,
                   {", ".join(f"ids[{k + 1}] AS L{k}_asset_id, names[{k + 1}] AS L{k}_asset_name" for k in range(1, 5))}, CAST(len(ids) AS INTEGER) AS chain_length
            FROM walk w JOIN fx_asset a ON a.asset_id = w.ids[1] WHERE depth = 4 OR NOT EXISTS (SELECT 1 FROM fx_edge e WHERE e.parent = w.asset_id)"""),
        "x1_fork_points": _cross("children", "n_children", "SELECT DISTINCT parent_id AS pid, asset_id AS rid, asset_name AS rname, status AS rstatus FROM dep WHERE parent_id IS NOT NULL", f"""
            CASE WHEN status = 'not-migrated' AND done > 0 THEN {told_sql(w.FORK_AHEAD, n="done")}
                 WHEN status = 'not-migrated' THEN {told_sql(w.FORK_FIRST, n="total_children")}
                 WHEN status = 'migrated' AND waiting > 0 THEN {told_sql(w.FORK_GOING, n="waiting")}
                 WHEN status = 'migrated' THEN '{w.FORK_DONE}' ELSE '{w.UNCLEAR}' END AS guidance""", "child_details"),
        "x2_merge_points": _cross("parents", "n_parents", "SELECT DISTINCT asset_id AS pid, parent_id AS rid, parent_name AS rname, parent_status AS rstatus FROM dep WHERE parent_id IS NOT NULL", f"""
            CASE WHEN waiting > 0 AND status = 'migrated' THEN {told_sql(w.MERGE_AHEAD, n="waiting")}
                 WHEN waiting > 0 THEN {told_sql(w.MERGE_BLOCKED, n="waiting", total="total_parents")}
                 WHEN status = 'not-migrated' THEN {told_sql(w.MERGE_READY, total="total_parents")}
                 WHEN status = 'migrated' THEN '{w.MERGE_DONE}' ELSE '{w.UNCLEAR}' END AS readiness""", "parent_details", ", migrated_at"),
        "x3_fork_points_simple": _dep("""
            SELECT n.asset_id, n.name AS asset_name, n.path AS asset_path, n.url AS asset_url, n.role, n.n_children AS direct_dependants, n.n_parents,
                   (SELECT array_to_string(list_sort(list(DISTINCT d.asset_name)), ' | ') FROM dep d WHERE d.parent_id = n.asset_id) AS dependants
            FROM nodes n WHERE n.n_children > 1"""),
        "x4_merge_points_simple": _dep("""
            SELECT n.asset_id, n.name AS asset_name, n.path AS asset_path, n.url AS asset_url, n.role, n.n_parents AS direct_parents, n.n_children,
                   (SELECT array_to_string(list_sort(list(DISTINCT d.parent_name)), ' | ') FROM dep d WHERE d.asset_id = n.asset_id) AS parents
            FROM nodes n WHERE n.n_parents > 1"""),
        "v1_model_overview": _dep(f"""
            SELECT count(*) AS total, {roles}, count(*) FILTER (n_children > 1) AS fork_points, count(*) FILTER (n_parents > 1) AS merge_points,
                   count(*) FILTER (n_children = 0) AS terminal_count, max(n_parents) AS max_parents, max(n_children) AS max_children, round(avg(n_parents), 2) AS avg_parents FROM nodes"""),
        "v2_leaf_assets": _dep(f"""
            SELECT asset_id, name AS asset_name, path AS asset_path, url AS asset_url, role, n_parents,
                   CASE role WHEN 'ROOT' THEN '{w.STANDALONE}' ELSE '{w.LEAF}' END AS classification
            FROM nodes WHERE n_children = 0"""),
        "v3_migration_progress": _dep(f"""
            SELECT count(*) AS total, {of('migrated')} AS migrated, {of('not-migrated')} AS not_migrated, {of('not-required')} AS not_required,
                   count(*) FILTER (status IN ('migrated', 'not-migrated')) AS scope_total, {roles}, count(*) FILTER (n_children = 0) AS terminal,
                   count(*) FILTER (n_children = 0 AND status = 'not-migrated') AS terminal_not_migrated, count(*) FILTER (n_children = 0 AND status = 'migrated') AS terminal_migrated,
                   round(CAST({of('migrated')} AS DOUBLE) * 100 / nullif(count(*) FILTER (status IN ('migrated', 'not-migrated')), 0), 1) AS pct_migrated FROM nodes"""),
        "v4_asset_migration_summary": _map(f"""
            SELECT count(*) AS total, {book('FULLY MIGRATED')} AS fully_migrated, {book('PARTIALLY MIGRATED')} AS partially_migrated, {book('NOT MIGRATED')} AS not_migrated,
                   CAST(sum(dataset_sources) AS BIGINT) AS dataset_sources, CAST(sum(data_model_sources) AS BIGINT) AS data_model_sources, CAST(sum(table_sources) AS BIGINT) AS table_sources,
                   round(CAST({book('FULLY MIGRATED')} AS DOUBLE) * 100 / nullif(count(*), 0), 1) AS pct_fully_migrated FROM summary"""),
        "v5_terminal_assets": _map(f"""
            SELECT DISTINCT asset_id, asset_name, asset_path, asset_url, status, role, n_parents, target_name, target_url, migrated_at,
                   CASE status WHEN 'migrated' THEN '{w.TERMINAL_DONE}' WHEN 'not-migrated' THEN '{w.TERMINAL_EASY}'
                               WHEN 'not-required' THEN '{w.TERMINAL_ORPHANED}' ELSE 'REVIEW' END AS terminal_status
            FROM dep WHERE n_children = 0 AND asset_id NOT IN (SELECT inode_id FROM fx_source WHERE source_type = 'dataset')"""),
        "v6_child_ahead_of_parent": _dep("""
            SELECT 'CHILD AHEAD OF PARENT' AS issue_type, d.parent_id AS blocker_id, d.parent_name AS blocker_name, p.url AS blocker_url,
                   'Parent is not-migrated but child data model exists: ' || d.asset_name || ' → ' || coalesce(d.target_name, 'unknown data model') AS detail, d.asset_url AS child_url, d.target_url AS child_target_url
            FROM dep d JOIN fx_asset p ON p.asset_id = d.parent_id WHERE p.status = 'not-migrated' AND d.status = 'migrated'"""),
        "v7_blocking_assets": _dep(f"""
            SELECT n.asset_id, n.name AS asset_name, n.url AS asset_url, n.role, n.n_children AS total_children, b.c AS not_migrated_children,
                   {told_sql(w.UNBLOCKS, n="b.c")} AS recommendation
            FROM nodes n JOIN (SELECT parent_id, count(DISTINCT asset_id) AS c FROM dep WHERE parent_status = 'not-migrated' AND status = 'not-migrated' GROUP BY parent_id) b ON b.parent_id = n.asset_id"""),
        "v8_repointing_candidates": _map("""
            SELECT workbook_id, s.workbook_name, workbook_url, owner_name, owner_email, migration_status, inode_id AS dataset_id, asset_name, asset_url, target_id, target_name, target_url, migrated_at
            FROM details d JOIN summary s USING (workbook_id) WHERE source_type = 'dataset' AND status = 'migrated'"""),
        "v9_readiness_pipeline": _dep(f"""
            SELECT asset_id, asset_name, asset_path, asset_url, role, n_parents, n_children, b AS parents_blocking, m AS parents_migrated,
                   CASE b WHEN 0 THEN 'READY' ELSE {told_sql(w.BLOCKED_BY, n="b")} END AS readiness,
                   CASE WHEN b > 0 THEN {told_sql(w.WAITING, n="b")} WHEN n_children > 0 THEN {told_sql(w.HIGH, n="n_children")}
                        ELSE '{w.LOW}' END AS priority
            FROM (SELECT asset_id, asset_name, asset_path, asset_url, role, n_parents, n_children, count(*) FILTER (parent_status = 'not-migrated') AS b, count(*) FILTER (parent_status = 'migrated') AS m
                  FROM dep WHERE status = 'not-migrated' GROUP BY ALL)"""),
        "v10_graph_nodes": _map("""
            SELECT CAST(asset_id AS VARCHAR) AS node_id, name AS node_name, 'dataset' AS node_type, role AS node_subtype, status, CAST(10 + n_children AS BIGINT) AS symbol_size FROM nodes
            UNION ALL SELECT CAST(workbook_id AS VARCHAR), workbook_name, 'workbook', migration_status, migration_status, 10 FROM summary"""),
        "v11_graph_edges": _map("""
            SELECT CAST(parent AS VARCHAR) AS source, CAST(child AS VARCHAR) AS target, 'ds-ds' AS edge_type FROM fx_edge
            UNION ALL SELECT DISTINCT CAST(asset_id AS VARCHAR), CAST(workbook_id AS VARCHAR), 'ds-wb' FROM details"""),
        "w1_discover_logs": _q(("fx_log",), "", "SELECT DISTINCT upper(log_name) AS log_name FROM fx_log"),
        "w2_changed_logs": _q(("fx_log",), "", """
            SELECT log_name, max(ts) AS last_modified FROM fx_log WHERE right(log_name, 2) IN ('_0', '_1') GROUP BY log_name"""),
        "w3_latest_edit_per_table": _q(("fx_log",), LOG, f"SELECT {EDIT} FROM per_log"),
        "w4_dedup_across_logs": _q(("fx_log",), LOG, f"SELECT {EDIT} FROM latest"),
        "w5_org_slug": _inv("SELECT CASE WHEN scan_schema <> 'schema_0' THEN 'org' END AS org_slug, count(*) AS n FROM fx_map GROUP BY 1"),
        "w6_table_inventory": _q(("fx_log",), "", "SELECT DISTINCT 'log_name=' || log_name AS name, true AS dated, true AS sized FROM fx_log"),
        "w17_read_listing_pages": _q(("fx_source",), "", "SELECT workbook_id, source_type, inode_id, data_model_id, count(*) AS n FROM fx_source GROUP BY ALL"),
        "w7_orphan_flags": _q(("fx_log", "fx_table"), LOG, "SELECT table_name, upper(table_name) NOT IN (SELECT name FROM fx_table) AS is_orphaned FROM latest"),
        "w7_orphan_changes": _q(("fx_log", "fx_table", "fx_map"), LOG, """
            SELECT table_name, NOT now AS is_orphaned
            FROM (SELECT table_name, coalesce(is_orphaned, false) AS was, upper(table_name) IN (SELECT name FROM fx_table) AS now FROM fx_map
                  WHERE scan_schema = 'schema_1' AND table_name NOT IN (SELECT table_name FROM latest WHERE max_edit_num % 2 = 0))
            WHERE was = now"""),
        "w8_deletion_flags": _inv(f"""
            SELECT table_name, scan_schema,
                   CASE WHEN scan_schema <> 'schema_1' THEN is_deleted WHEN table_name SIMILAR TO '.*[23]' THEN CASE WHEN is_deleted THEN false ELSE is_deleted END ELSE true END AS is_deleted,
                   CASE WHEN scan_schema <> 'schema_1' THEN deleted_at WHEN table_name SIMILAR TO '.*[23]' THEN CASE WHEN NOT coalesce(is_deleted, false) THEN deleted_at END
                        WHEN is_deleted THEN deleted_at ELSE {TS} END AS deleted_at
            FROM fx_map"""),
        "w9_infer_id_column": _q(("fx_log", "fx_lst_workbook"), LOG, """
            SELECT 'workbookId' AS id_column, count(DISTINCT l.workbook_id) AS matches FROM latest l JOIN fx_lst_workbook w ON lower(trim(w.id)) = l.workbook_id"""),
        "w10_tag_index": _q(("fx_lst_tagged",), "", """
            SELECT tagged_id AS key, workbook_id AS parent_workbook_id, tag AS version_tag, name AS workbook_name, 'a/' || name AS workbook_path, url AS api_url, owner_id FROM fx_lst_tagged"""),
        "w11_enrich_owner_object": _q(LISTS, ENRICH, "SELECT * FROM enriched"),
        "w12_refresh_archived": _q(("fx_map", "fx_lst_workbook", "fx_lst_model"), """
            wb AS (SELECT lower(trim(id)) AS key, coalesce(is_archived, false) AS archived FROM fx_lst_workbook),
            st AS (SELECT replace(table_name, 'in_', 'wb_') AS workbook_id, CASE WHEN is_tagged THEN 'wb_' || replace(workbook_id, 'wbid_', '') END AS parent, object_type, is_tagged, is_archived AS was FROM fx_map),
            nw AS (SELECT st.workbook_id, was, CASE WHEN w.key IS NOT NULL THEN w.archived WHEN m.id IS NOT NULL OR object_type = 'DATA_MODEL' THEN false WHEN is_tagged THEN p.archived END AS is_archived
                   FROM st LEFT JOIN wb w ON w.key = st.workbook_id LEFT JOIN fx_lst_model m ON m.id = st.workbook_id LEFT JOIN wb p ON p.key = st.parent)""",
            "SELECT workbook_id, is_archived FROM nw WHERE is_archived IS NOT NULL AND is_archived IS DISTINCT FROM was"),
        "w13_legacy_flag": _q(("fx_log",), "", "SELECT DISTINCT log_name, NOT contains(log_name, 'wal_ds_') AS is_legacy FROM fx_log"),
        "w14_assemble_records": _q((*LISTS, "fx_logs", "fx_table", "fx_map"), f"""{ENRICH},
            fresh AS (SELECT * FROM enriched WHERE workbook_id NOT LIKE '%1'),
            old AS (SELECT replace(table_name, 'in_', 'wb_') AS workbook_id, workbook_name, 'old' AS workbook_path, object_type, CAST(NULL AS VARCHAR) AS api_url, owner_id, is_archived, is_tagged, version_tag, parent_workbook_id, owner_first_name, owner_last_name FROM fx_map),
            rich AS (SELECT * FROM fresh UNION ALL BY NAME SELECT * FROM old WHERE workbook_id NOT IN (SELECT workbook_id FROM fresh))""", f"""
            SELECT l.log_name, l.ds_id, l.table_name, 'schema_1' AS scan_schema, l.workbook_id, l.workbook_url, l.org_slug, l.input_name, l.last_edit_at, l.last_edit_by,
                   r.workbook_name, r.workbook_path, r.object_type, md5(t.name) AS table_id, CASE WHEN t.name IS NOT NULL THEN '/t' END AS table_location,
                   CASE WHEN t.name IS NOT NULL THEN {TS} END AS table_modified_at, CAST(length(t.name) AS BIGINT) AS size_bytes, l.max_edit_num, g.last_modified AS log_modified_at,
                   t.name IS NULL AS is_orphaned, false AS is_deleted, CAST(NULL AS TIMESTAMP) AS deleted_at, NOT contains(l.log_name, 'wal_ds_') AS is_legacy,
                   coalesce(r.is_tagged, false) AS is_tagged, r.version_tag, r.parent_workbook_id, r.api_url, r.owner_id, r.is_archived, r.owner_first_name, r.owner_last_name
            FROM latest l LEFT JOIN rich r USING (workbook_id) LEFT JOIN fx_table t ON t.name = upper(l.table_name) LEFT JOIN fx_logs g USING (log_name)"""),
        "w15_upsert": _inv("""
            SELECT table_name, scan_schema, CASE WHEN k % 3 = 0 THEN max_edit_num + 1 ELSE max_edit_num END AS max_edit_num, size_bytes, CASE WHEN k % 3 = 0 THEN 'new' ELSE 'old' END AS side
            FROM (SELECT *, CAST(substr(table_name, 4) AS BIGINT) AS k FROM fx_map)"""),
        "w16_recent_entries": _inv("SELECT table_name, table_modified_at FROM fx_map ORDER BY table_modified_at DESC NULLS LAST, table_name LIMIT 20"),
        "s1_score_components": _q(("fx_map",), SCORED, """
            SELECT table_name, days_since_edit, days_since_change, size_mb, score_status, score_edit_recency, score_table_recency, score_edit_volume, score_legacy, score_storage, penalty_tagged FROM parts"""),
        "s2_archival_score": _q(("fx_map",), SCORED, "SELECT table_name, scan_schema, workbook_name, owner, total_score, tier, size_mb FROM scored"),
        "s3_tier_rollup": _q(("fx_map",), SCORED, f"""
            SELECT tier, count(*) AS records, {SUM_GB.format('coalesce(size_bytes, 0)')} AS total_gb, round(avg(total_score), 1) AS avg_score,
                   min(days_since_edit) AS min_days_since_edit, max(days_since_edit) AS max_days_since_edit FROM scored GROUP BY tier"""),
        "r1_landscape_overview": _inv(f"""
            SELECT scan_schema, count(*) AS tables, count(*) FILTER (is_orphaned) AS orphaned, count(*) FILTER (is_deleted) AS deleted, count(*) FILTER (is_archived AND {LIVE}) AS archived_active,
                   count(*) FILTER (is_legacy) AS legacy, count(*) FILTER (is_tagged) AS tagged, {TOTALS} FROM fx_map GROUP BY scan_schema"""),
        "r2_reclamation_candidates": _inv(f"""
            SELECT scan_schema, table_name, log_name, workbook_name, {OWNER} AS owner,
                   CASE WHEN is_orphaned THEN 'Orphaned — table gone' WHEN is_deleted THEN 'Deleted — log gone' ELSE 'Workbook archived' END AS signal, is_tagged, version_tag,
                   round(CAST(coalesce(size_bytes, 0) AS DOUBLE) / 1073741824, 3) AS size_gb, last_edit_at, {AGE} AS days_since_edit, max_edit_num, workbook_url
            FROM fx_map WHERE {SIGNAL}"""),
        "r3_stale_active": _inv(f"""
            SELECT scan_schema, table_name, workbook_name, {OWNER} AS owner, last_edit_by, last_edit_at, {AGE} AS days_since_edit,
                   CASE WHEN coalesce({AGE}, 999) > 365 THEN '>365 days' WHEN {AGE} > 180 THEN '181–365 days' WHEN {AGE} > 90 THEN '91–180 days' ELSE '31–90 days' END AS inactivity_band,
                   max_edit_num, {MB} AS size_mb, is_tagged, version_tag, workbook_url
            FROM fx_map WHERE {LIVE} AND is_archived = false AND (last_edit_at IS NULL OR last_edit_at < {TS} - INTERVAL 30 DAY)"""),
        "r4_most_active": _inv(f"""
            SELECT scan_schema, table_name, workbook_name, {OWNER} AS owner, last_edit_by, max_edit_num, last_edit_at, {AGE} AS days_since_edit, {MB} AS size_mb, is_tagged, version_tag, workbook_url
            FROM fx_map WHERE {LIVE} AND max_edit_num > 0"""),
        "r5_owner_summary": _inv(f"""
            SELECT scan_schema, {OWNER} AS owner, owner_id, count(*) AS tables, count(*) FILTER (is_archived) AS archived, count(*) FILTER (is_orphaned) AS orphaned, count(*) FILTER (is_deleted) AS deleted,
                   count(*) FILTER (last_edit_at IS NULL OR last_edit_at < {TS} - INTERVAL 180 DAY) AS stale_180d, {TOTALS}
            FROM fx_map WHERE owner_id IS NOT NULL GROUP BY 1, 2, 3"""),
        "r6_multi_input_assets": _inv(f"""
            SELECT coalesce(parent_workbook_id, workbook_id) AS workbook, coalesce(max(workbook_name) FILTER (NOT is_tagged), max(workbook_name)) AS workbook_name,
                   trim(coalesce(max(owner_first_name), '') || ' ' || coalesce(max(owner_last_name), '')) AS owner, count(DISTINCT input_name) AS input_elements, count(*) AS files,
                   count(*) FILTER (is_tagged) AS tagged_files, count(DISTINCT scan_schema) AS schemas, CAST(sum(max_edit_num) AS BIGINT) AS edits, max(last_edit_at) AS last_edit_at,
                   {SUM_GB.format('coalesce(size_bytes, 0)')} AS total_gb, CASE WHEN bool_or(is_archived) THEN 'Yes' ELSE 'No' END AS archived
            FROM fx_map WHERE workbook_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT input_name) > 1"""),
        "r7_legacy_inventory": _inv(f"""
            SELECT scan_schema, log_name, table_name, workbook_name, {OWNER} AS owner, last_edit_at, {AGE} AS days_since_edit, max_edit_num,
                   CASE WHEN coalesce({AGE}, 999) >= 180 THEN 'Inactive — low urgency' ELSE 'Active — migrate urgently' END AS priority, is_orphaned, is_archived, {MB} AS size_mb, workbook_url
            FROM fx_map WHERE is_legacy"""),
    }
