"""Lineage chains: bounded walks from every ROOT, and their pivoted form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.sources.shared import kept

DATASET_HOPS, MODEL_HOPS = 9, 4
FIELDS = ("asset_id", "asset_name", "asset_path", "asset_url", "status", "target_name", "migrated_at")


def walk_chains(dep: DataFrame, max_hops: int = DATASET_HOPS, mark_cycles: bool = False) -> DataFrame:
    """(asset_id, role, depth, chain): one row per path prefix from a ROOT over at most max_hops edges.

    chain is an array of structs with FIELDS. Nodes that no ROOT reaches yield nothing; a cycle that one reaches
    repeats up to the cap, and is marked in a column cycle on request. Each level is a join of the frontier
    with the edges; the frontier is written as Parquet, so it is computed once and the plan stays as small as one level.
    """
    step = dep.select("role", "parent_id", F.struct(*FIELDS).alias("at")).distinct()
    front = kept(step.filter("role = 'ROOT'").select(F.col("at.asset_id").alias("asset_id"), "role", F.lit(0).alias("depth"), F.array("at").alias("chain"), *([F.lit(False).alias("cycle")] if mark_cycles else [])))
    out, edges = front, step.filter("parent_id is not null")
    for depth in range(1, max_hops + 1):
        seen = [(F.col("cycle") | F.exists("chain", lambda x: x["asset_id"] == F.col("at.asset_id"))).alias("cycle")] if mark_cycles else []
        moved = front.drop("role").join(edges, F.col("asset_id") == F.col("parent_id"))
        front = kept(moved.select(F.col("at.asset_id").alias("asset_id"), "role", F.lit(depth).alias("depth"), F.array_append("chain", F.col("at")).alias("chain"), *seen))
        if front.isEmpty():
            break
        out = out.unionByName(front)
    return out


def complete_paths(chains: DataFrame, dep: DataFrame) -> DataFrame:
    """Chains that end in a LEAF, and ROOTs without a child. Chains cut at the cap don't appear."""
    parents = dep.filter("parent_id is not null").select(F.col("parent_id").alias("asset_id")).distinct()
    alone = chains.filter("depth = 0 and role = 'ROOT'").join(parents, "asset_id", "left_anti")
    return chains.filter("role = 'LEAF'").unionByName(alone)


def terminal_chains(chains: DataFrame, dep: DataFrame, cap: int = MODEL_HOPS) -> DataFrame:
    """Chains that end in a node without children, or at the cap."""
    parents = dep.filter("parent_id is not null").select(F.col("parent_id").alias("asset_id")).distinct().withColumn("_parent", F.lit(True))
    return chains.join(parents, "asset_id", "left").filter(F.col("_parent").isNull() | (F.col("depth") == cap)).drop("_parent")


def chain_path(chain: Column) -> Column:
    """The names on a chain; nulls are left out."""
    return F.array_join(F.transform(chain, lambda x: x["asset_name"]), " → ")


def chain_status(chain: Column) -> Column:
    has = lambda status: F.exists(chain, lambda x: x["status"].eqNullSafe(F.lit(status)))
    return F.when(~has("not-migrated"), "FULLY MIGRATED").when(has("migrated"), "PARTIALLY MIGRATED").otherwise("NOT MIGRATED")


def pivot_levels(chains: DataFrame, levels: int = 5, fields: tuple = FIELDS, first_fields: tuple | None = None) -> DataFrame:
    """Chains as columns L0_..L{levels-1}_ of the fields, null past the end, with path, length and status."""
    cols = [F.get("chain", F.lit(k))[f].alias(f"L{k}_{f}") for k in range(levels) for f in (first_fields if first_fields and not k else fields)]
    return chains.select(*cols, chain_path(F.col("chain")).alias("chain_path"), F.size("chain").alias("chain_length"), chain_status(F.col("chain")).alias("chain_status"))


def dataset_chains(dep: DataFrame, max_hops: int = DATASET_HOPS) -> DataFrame:
    """Complete chains, five levels of every field."""
    out = pivot_levels(complete_paths(walk_chains(dep, max_hops), dep))
    return out.orderBy(F.col("L0_asset_name").asc_nulls_last(), "chain_length", "chain_path")


def model_chains(dep: DataFrame, max_hops: int = MODEL_HOPS) -> DataFrame:
    """Chains up to the cap: the root's fields, ids and names of the others."""
    names = ("asset_id", "asset_name")
    out = pivot_levels(terminal_chains(walk_chains(dep, max_hops), dep, max_hops), max_hops + 1, names, (*names, "asset_path", "asset_url"))
    return out.drop("chain_status", "chain_path").orderBy(F.col("L0_asset_name").asc_nulls_last(), "chain_length", *(F.col(f"L{k}_asset_name").asc_nulls_last() for k in range(1, max_hops + 1)))
