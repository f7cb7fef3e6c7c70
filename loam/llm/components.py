"""Connected components of an edge table, by large-star rounds and contraction.

Each round is one aggregation (combined before the shuffle) and one join of written tables, so that Spark broadcasts
the small side where its size allows and splits a hub's rows elsewhere. What comes out is contracted: a task turns
each batch of its edges into stars around the smallest nodes, before the shuffle by the larger end and after it. The
first time leaves a node one edge a batch, however large a hub it is; the second hangs all smaller neighbours of a node
on the smallest of them, as a small star would, and more of what happens to be in the same task. The aggregation also
tells whether the rounds have settled; only that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.shared import removed, written

#: Edges that a task contracts at once.
BATCH_EDGES = 1 << 20


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as links (node, smallest node of its component), one for each node but the smallest."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, up = ends[: len(a)], ends[len(a) :], np.arange(len(nodes))
    while len(x):
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while (up[up] != up).any():
            up = up[up]
        x, y = up[x], up[y]
        x, y = x[x != y], y[x != y]
    moved = up != np.arange(len(nodes))
    return nodes[moved], nodes[up[moved]]


def _contracted(most: int):
    """Edges (a, b) as stars, so many at a time; where they arrive sorted by a, all edges of an a at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((2, 0), np.int64)
        parts: list[np.ndarray] = []
        size = 0

        def done(edges: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in stars(*edges)], ["a", "b"])

        for batch in batches:
            parts.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
            size += batch.num_rows
            if size >= most:
                held = np.concatenate([held, *parts], axis=1)
                others = np.flatnonzero(held[0] != held[0, -1])
                cut = int(others[-1]) + 1 if len(others) else 0
                if cut:
                    yield done(held[:, :cut])
                held, parts = held[:, cut:].copy(), []
                size = held.shape[1] if cut else 0
        held = np.concatenate([held, *parts], axis=1)
        if held.shape[1]:
            yield done(held)

    return run


def _contract(edges: DataFrame, most: int) -> DataFrame:
    run, schema = _contracted(most), "a long, b long"
    return written(edges.mapInArrow(run, schema).repartition("a").sortWithinPartitions("a").mapInArrow(run, schema), "edges")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select("b", "a")).toDF("u", "v")


def _around(edges: DataFrame) -> DataFrame:
    """(u, m, open): the smallest of each node and its neighbours, and whether the node is not settled yet.

    All is settled once every node hangs on one smaller node at most, and no node that others hang on does itself.
    """
    below, above = F.when(F.col("v") < F.col("u"), F.col("v")), F.count_if(F.col("v") > F.col("u"))
    found = _both_ways(edges).groupBy("u").agg(F.min(below).alias("low"), F.max(below).alias("high"), above.alias("above"))
    return written(found.select("u", F.coalesce("low", "u").alias("m"), F.expr("low is not null and (low <> high or above > 0)").alias("open")), "around")


def _large_star(edges: DataFrame, around: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around it."""
    return _both_ways(edges).filter("v > u").join(around, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def connected_components(edges: DataFrame, batch_edges: int = BATCH_EDGES) -> DataFrame:
    """(node, root) for every node that is not its component's smallest; edges: two long columns, no nulls.

    Nodes without a link to a smaller node don't appear. An empty edge table gives an empty result.
    """
    a, b = (F.col(c) for c in edges.columns)
    now = _contract(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b"), batch_edges)
    while True:
        around = _around(now)
        if around.filter("open").isEmpty():
            removed(around)
            return now.distinct().select(F.col("a").alias("node"), F.col("b").alias("root"))
        after = _contract(_large_star(now, around), batch_edges)
        removed(around, now)
        now = after
