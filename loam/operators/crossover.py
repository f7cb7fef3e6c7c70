"""Fork points (several children) and merge points (several parents) of a dependency table of one run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions import wording as w
from loam.functions.wording import told

OWN = ("asset_id", "asset_name", "asset_path", "asset_url", "status", "target_id", "target_name", "target_url")


def _text(*parts) -> Column:
    return F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts))


def _with_related(dep: DataFrame, points: DataFrame, related: DataFrame, kind: str) -> DataFrame:
    """points with counts and details of the related assets (point_id, id, name, status), by url lookup."""
    urls = dep.select(F.col("asset_id").alias("id"), "asset_url", "target_url").distinct()
    found = related.join(urls, "id").withColumnsRenamed({"asset_url": "rel_url", "target_url": "rel_target_url"})
    detail = _text(F.col("rel_name"), "  [", F.col("rel_status"), "]  ID: ", F.col("id").cast("string"), "  Dataset: ", F.coalesce("rel_url", F.lit("no url")), "  DataModel: ", F.coalesce("rel_target_url", F.lit("not migrated")))
    counts = found.groupBy("point_id").agg(
        *(F.count_if(F.col("rel_status") == s).alias(f"{kind}_{s.replace('-', '_')}") for s in ("migrated", "not-migrated", "not-required")),
        # nulls are skipped, as an aggregate of strings does; the id settles equal names
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(detail.isNotNull(), F.struct("rel_name", "id", detail.alias("detail"))))), lambda x: x["detail"]), "  ||  ").alias("detail"),
        F.count("*").alias("_n"),
    )
    counts = counts.withColumn("detail", F.when(F.col("detail") != "", F.col("detail"))).drop("_n")
    return points.join(counts.withColumnRenamed("point_id", "asset_id"), "asset_id")


def _children(dep: DataFrame) -> DataFrame:
    points = dep.filter("n_children > 1").select(F.col("asset_id").alias("point_id")).distinct()
    found = dep.join(points, F.col("parent_id") == F.col("point_id"))
    return found.select("point_id", F.col("asset_id").alias("id"), F.col("asset_name").alias("rel_name"), F.col("status").alias("rel_status")).distinct()


def _parents(dep: DataFrame) -> DataFrame:
    found = dep.filter("n_parents > 1 and parent_id is not null")
    return found.select(F.col("asset_id").alias("point_id"), F.col("parent_id").alias("id"), F.col("parent_name").alias("rel_name"), F.col("parent_status").alias("rel_status")).distinct()


def related(dep: DataFrame, kind: str) -> DataFrame:
    """(point_id, related_id, name, status, url, target_url): fork points' children or merge points' parents, a row each.

    What fork_points and merge_points tell of a point in one text, as rows: of a hub with very many, no row holds all.
    kind: children or parents.
    """
    urls = dep.select(F.col("asset_id").alias("id"), "asset_url", "target_url").distinct()
    found = {"children": _children, "parents": _parents}[kind](dep).join(urls, "id")
    return found.select("point_id", F.col("id").alias("related_id"), F.col("rel_name").alias("name"), F.col("rel_status").alias("status"), F.col("asset_url").alias("url"), "target_url")


def fork_points(dep: DataFrame) -> DataFrame:
    """Assets with several children: their children's counts by status, details and what to do."""
    points = dep.filter("n_children > 1").select(*OWN, F.col("n_children").alias("total_children")).distinct()
    out = _with_related(dep, points, _children(dep), "children")
    done, left = F.col("children_migrated"), F.col("children_not_migrated")
    own = F.col("status")
    guidance = (
        F.when((own == "not-migrated") & (done > 0), told(w.FORK_AHEAD, n=done))
        .when(own == "not-migrated", told(w.FORK_FIRST, n=F.col("total_children")))
        .when((own == "migrated") & (left > 0), told(w.FORK_GOING, n=left))
        .when(own == "migrated", w.FORK_DONE)
        .otherwise(w.UNCLEAR)
    )
    out = out.withColumn("guidance", guidance).withColumnRenamed("detail", "child_details")
    return out.orderBy(F.when(own == "not-migrated", 0).otherwise(1), F.col("total_children").desc(), F.col("asset_name").asc_nulls_last())


def merge_points(dep: DataFrame) -> DataFrame:
    """Assets with several parents: their parents' counts by status, details and whether they can be migrated.

    A parent without a row of its own doesn't count; complete_missing() gives it one.
    """
    points = dep.filter("n_parents > 1").select(*OWN, "migrated_at", F.col("n_parents").alias("total_parents")).distinct()
    out = _with_related(dep, points, _parents(dep), "parents")
    left, own, total = F.col("parents_not_migrated"), F.col("status"), F.col("total_parents")
    readiness = (
        F.when((left > 0) & (own == "migrated"), told(w.MERGE_AHEAD, n=left))
        .when(left > 0, told(w.MERGE_BLOCKED, n=left, total=total))
        .when(own == "not-migrated", told(w.MERGE_READY, total=total))
        .when(own == "migrated", w.MERGE_DONE)
        .otherwise(w.UNCLEAR)
    )
    out = out.withColumn("readiness", readiness).withColumnRenamed("detail", "parent_details")
    rank = F.when((own == "migrated") & (left > 0), 0).when(left > 0, 1).when(own == "not-migrated", 2).otherwise(3)
    return out.orderBy(rank, F.col("total_parents").desc(), F.col("asset_name").asc_nulls_last())


def _names(dep: DataFrame, key: str, name: str) -> DataFrame:
    rows = dep.filter("parent_id is not null").groupBy(F.col(key).alias("asset_id"))
    return rows.agg(F.array_join(F.sort_array(F.collect_set(name)), " | ").alias("names"))


def fork_points_simple(dep: DataFrame) -> DataFrame:
    """Assets with several children, and the children's distinct names."""
    own = dep.filter("n_children > 1").select("asset_id", "asset_name", "asset_path", "asset_url", "role", F.col("n_children").alias("direct_dependants"), "n_parents").distinct()
    out = own.join(_names(dep, "parent_id", "asset_name").withColumnRenamed("names", "dependants"), "asset_id", "left")
    return out.orderBy(F.col("direct_dependants").desc(), F.col("asset_name").asc_nulls_last())


def merge_points_simple(dep: DataFrame) -> DataFrame:
    """Assets with several parents, and the parents' distinct names."""
    own = dep.filter("n_parents > 1").select("asset_id", "asset_name", "asset_path", "asset_url", "role", F.col("n_parents").alias("direct_parents"), "n_children").distinct()
    out = own.join(_names(dep, "asset_id", "parent_name").withColumnRenamed("names", "parents"), "asset_id", "left")
    return out.orderBy(F.col("direct_parents").desc(), F.col("asset_name").asc_nulls_last())
