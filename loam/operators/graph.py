"""Dependency graphs of assets: edges from source listings, degrees, roles and the dependency table.

An asset table has asset_id and any of name, path, url, created_by, owner, status, target_id, migrated_at and
migrated_by; a target table has target_id and any of name, url, path, created_at and updated_at; an edge table has child and parent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions.columns import normalise_type
from loam.sources.runs import stamped

ASSET_FIELDS = ("path", "url", "created_by", "owner", "status", "migrated_at", "migrated_by")
TARGET_FIELDS = ("name", "url", "path", "created_at", "updated_at")


def extract_edges(listing: DataFrame, type_value: str, id_keys: list[str], asset_col: str = "asset_id", sources_col: str = "sources", known: DataFrame | None = None, normalise: bool = True, synonyms: dict[str, str] | None = None) -> DataFrame:
    """(child, parent), distinct: the sources of the wanted type, by the first non-null of the id keys.

    With known (a table with asset_id), only parents in it count.
    """
    rows = listing.select(F.col(asset_col).alias("child"), F.explode(sources_col).alias("s"))
    kind = normalise_type(F.col("s.type"), synonyms) if normalise else F.col("s.type")
    edges = rows.filter(kind == type_value).select("child", F.coalesce(*(F.col(f"s.{k}") for k in id_keys)).alias("parent")).filter("parent is not null").distinct()
    return edges if known is None else edges.join(known.select(F.col("asset_id").alias("parent")), "parent", "left_semi").select("child", "parent")


def resolve_aliases(edges: DataFrame, aliases: DataFrame) -> DataFrame:
    """Edges with both ends in canonical ids. aliases: (alias, canonical); ids without an entry stay."""
    out = edges
    for end in ("child", "parent"):
        names = aliases.select(F.col("alias").alias(end), F.col("canonical").alias("_to")).distinct()
        out = out.join(names, end, "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
    return out.select("child", "parent").distinct()


def with_aliases(assets: DataFrame, aliases: DataFrame) -> DataFrame:
    """Assets with a copy of each under its alias ids: aliases as they are, in place of resolve_aliases.

    dependency_table() of these and of unresolved edges has a ROOT row for each alias that has no parents, and no INTERNAL
    where children and parents are named by different ids: the older rule.
    """
    other = aliases.select(F.col("alias"), F.col("canonical").alias("asset_id")).filter("alias <> asset_id").distinct()
    copies = assets.join(other, "asset_id").withColumn("asset_id", F.col("alias")).select(*assets.columns)
    return assets.unionByName(copies.join(assets.select("asset_id"), "asset_id", "left_anti"))


def complete_missing(assets: DataFrame, referenced: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """Assets plus a row for every referenced id (column asset_id) that they lack, with its metadata if there is any."""
    missing = referenced.select("asset_id").filter("asset_id is not null").distinct().join(assets, "asset_id", "left_anti")
    if metadata is not None:
        missing = missing.join(metadata, "asset_id", "left")
    return assets.unionByName(missing, allowMissingColumns=True).select(*assets.columns)


def degrees(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(asset_id, n_parents, n_children) of every node, 0 where there are none."""
    up = edges.groupBy(F.col("child").alias("asset_id")).agg(F.countDistinct("parent").alias("n_parents"))
    down = edges.groupBy(F.col("parent").alias("asset_id")).agg(F.countDistinct("child").alias("n_children"))
    out = nodes.select("asset_id").distinct().join(up, "asset_id", "left").join(down, "asset_id", "left")
    return out.select("asset_id", F.coalesce("n_parents", F.lit(0)).alias("n_parents"), F.coalesce("n_children", F.lit(0)).alias("n_children"))


def role_of(n_parents: Column, n_children: Column) -> Column:
    return F.when(n_parents == 0, "ROOT").when(n_children > 0, "INTERNAL").otherwise("LEAF")


def graph_roles(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """degrees() with the role: ROOT without parents, INTERNAL with both, LEAF without children."""
    return degrees(edges, nodes).withColumn("role", role_of(F.col("n_parents"), F.col("n_children")))


def dependency_table(assets: DataFrame, edges: DataFrame, targets: DataFrame | None, run_id: str, created_at: str, default_names: bool = True) -> DataFrame:
    """One row per edge with the child's, its target's and the parent's attributes, and a null parent for each ROOT.

    default_names: a missing name is the id. Assets that are no node of an edge are ROOTs.
    """
    has = lambda df, c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    name = F.coalesce("name", F.col("asset_id").cast("string")) if default_names else F.col("name")
    own = assets.select("asset_id", name.alias("asset_name"), *(has(assets, c).alias(f"asset_{c}" if c in ("path", "url", "created_by", "owner") else c) for c in ASSET_FIELDS), has(assets, "target_id").alias("target_id"))
    if targets is None:
        own = own.select("*", *(F.lit(None).cast("string").alias(f"target_{c}") for c in TARGET_FIELDS))
    else:  # assets without a target go past the join, in which their null ids would meet in one task
        aims = targets.select("target_id", *(has(targets, c).alias(f"target_{c}") for c in TARGET_FIELDS))
        own = own.filter("target_id is not null").join(aims, "target_id", "left").unionByName(own.filter("target_id is null"), allowMissingColumns=True)
    # parents are joined to edges, as ROOTs have null parents
    parents = assets.select(F.col("asset_id").alias("parent_id"), F.col("name").alias("parent_name"), has(assets, "status").alias("parent_status"))
    linked = edges.select(F.col("child").alias("asset_id"), F.col("parent").alias("parent_id")).join(parents, "parent_id", "left")
    if default_names:
        linked = linked.withColumn("parent_name", F.coalesce("parent_name", F.col("parent_id").cast("string")))
    out = own.join(graph_roles(edges, assets), "asset_id").join(linked, "asset_id", "left")
    order = ["role", "asset_id", "asset_name", *(f"asset_{c}" if c in ("path", "url", "created_by", "owner") else c for c in ASSET_FIELDS), "target_id", *(f"target_{c}" for c in TARGET_FIELDS), "parent_id", "parent_name", "parent_status", "n_parents", "n_children"]
    return stamped(out.select(*order), run_id, created_at)


def build_summary(dep: DataFrame) -> DataFrame:
    """One row: rows by role and in all, and the numbers of fork and merge points (which count nodes)."""
    rows = dep.agg(*(F.count_if(F.col("role") == r).alias(f"{r.lower()}_rows") for r in ("ROOT", "INTERNAL", "LEAF")), F.count("*").alias("total_rows"), F.countDistinct(F.when(F.col("n_parents") > 1, F.col("asset_id"))).alias("merge_points"), F.countDistinct(F.when(F.col("n_children") > 1, F.col("asset_id"))).alias("fork_points"))
    return rows.select("root_rows", "internal_rows", "leaf_rows", "fork_points", "merge_points", "total_rows")
