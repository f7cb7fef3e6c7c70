"""Exact top-k search: tiled matrix products, partial selection per tile, tree merging.

Candidates and queries are dealt to a grid: candidate shards of at most SHARD_ROWS rows and some SHARD_BYTES, query
blocks of QUERY_ROWS and QUERY_BYTES, by a hash of the id. A task multiplies one query block with one shard and keeps
each query's best k there (argpartition on a key that holds the score and, for ties, the smaller id). The lists of FAN
shards at a time are merged, level by level, until one is left for each query. Nothing is broadcast or collected but
counts; a task holds one tile, however long the vectors are.

Components become floor(scale * x) as whole numbers, so scores are exact: products run in doubles while the largest
possible score is below 2**53, in 64-bit integers below 2**62, else in whole numbers of any size. A score beyond what
a long holds is given as the nearest long. Components of any finite size are exact, also where scale * x is beyond doubles. Vectors that are null or hold null or non-finite components take no part;
null ids take no part either. Vectors are compared with those of equal length only; empty ones score 0 with each
other. Repeated ids are separate candidates, but none for the queries of the same id; a repeated query id asks once,
with the smallest of its vectors. Ties go to the smaller id. An empty table of candidates or of queries gives an empty
result. Only the named columns are read; others may have any name.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS, QUERY_ROWS, FAN = 32768, 8192, 16
#: Of components as doubles.
SHARD_BYTES, QUERY_BYTES = 16 << 20, 4 << 20
#: Scores held at once.
SCORES = 1 << 22


def finite(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def whole(vector: Column, scale: float) -> tuple[Column, Column]:
    """floor(scale * x) of all components, as ints; or, if one doesn't fit, the components themselves as doubles in the second."""
    plain = F.transform(vector, lambda x: x.cast("double"))
    scaled = F.transform(plain, lambda x: F.lit(float(scale)) * x)
    fits = F.forall(scaled, lambda y: F.abs(y) < float(1 << 31))
    return F.when(fits, F.transform(scaled, lambda y: F.floor(y).cast("int"))), F.when(~fits, plain)


def _matrix(rows: pa.Table, dim: int, scale: float) -> np.ndarray:
    """The vectors of a table with columns v and w, one of them null: doubles that are whole, or Python's integers beyond them."""
    out = np.empty((rows.num_rows, dim))
    for name in ("v", "w"):
        column = rows[name].combine_chunks()
        out[column.is_valid().to_numpy(zero_copy_only=False)] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) if dim else 0
    large = rows["w"].combine_chunks().is_valid().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        scaled = np.floor(out[large] * scale)
    if np.isfinite(scaled).all():
        out[large] = scaled
        return out
    # a component whose product no double holds is whole itself, or the scale is so large that fractions count exactly
    exact = np.empty(out.shape, object)
    scaled = iter(scaled.tolist())
    for k, (row, wide) in enumerate(zip(out.tolist(), large.tolist(), strict=True)):
        exact[k] = [math.floor(Fraction(x) * Fraction(scale)) if math.isinf(y) else int(y) for x, y in zip(row, next(scaled) if wide else row, strict=True)]
    return exact


def _span(x: np.ndarray) -> float | int:
    return max((abs(v) for v in x.reshape(-1).tolist()), default=0) if x.dtype == object else float(np.abs(x).max(initial=0))


def _products(left: np.ndarray, right: np.ndarray, top: float) -> np.ndarray:
    """Whole-number inner products of doubles that are whole, or of integers; top: no product is larger."""
    if top < 2.0**53:
        return (left @ right).astype(np.int64)
    if top < 2.0**62:
        return left.astype(np.int64) @ right.astype(np.int64)
    exact = [x if x.dtype == object else np.array([[int(y) for y in row] for row in x.tolist()], object).reshape(x.shape) for x in (left, right)]
    edge = np.iinfo(np.int64)
    return np.array([[min(max(int(y), edge.min + 1), edge.max) for y in row] for row in exact[0].dot(exact[1]).tolist()], np.int64).reshape(len(left), right.shape[1])


def tile_top_k(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, id, score) of each query's best k among the vectors, but for its own id."""
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    top = _span(queries) * _span(vectors) * max(1, queries.shape[1]) if queries.dtype == vectors.dtype else math.inf
    right, n = np.ascontiguousarray(vectors.T), len(ids)
    step, out = max(1, SCORES // n), []
    for a in range(0, len(queries), step):
        asked = query_ids[a : a + step]
        scores = _products(queries[a : a + step], right, top)
        own = ids[None, :] == asked[:, None]
        if top < 2.0**62 and top * n < 2.0**62:
            # scores first, then the place in id order; a query's own row comes last
            key = scores * n - np.arange(n)
            key[own] = np.iinfo(np.int64).min
            best = np.argpartition(key, n - min(k, n), axis=1)[:, n - min(k, n) :]
        else:
            best = np.stack([np.lexsort((np.arange(n), -s, o))[:k] for s, o in zip(scores, own, strict=True)])
        row = np.repeat(np.arange(len(asked)), best.shape[1])
        col = best.reshape(-1)
        keep = ~own[row, col]
        out.append((asked[row[keep]], ids[col[keep]], scores[row[keep], col[keep]]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _tile(k: int, scale: float):
    names = ["query_id", "shard", "id", "score"]

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({x: pa.array([], pa.int64()) for x in names})
        dim = key[0].as_py()
        q, i, s = tile_top_k(_matrix(left, dim, scale), left["id"].to_numpy(), _matrix(right, dim, scale), right["id"].to_numpy(), k)
        return pa.table({"query_id": q, "shard": np.full(len(q), key[2].as_py(), np.int64), "id": i, "score": s})

    return run


def _best(lists: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def exact_top_k(candidates: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, scale: float = 1024) -> DataFrame:
    """(query_id, rank, id, score): each query's k highest inner products. Ids are whole numbers."""

    def usable(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).filter(F.col("id").isNotNull() & finite(F.col("v")))
        v, w = whole(F.col("v"), scale)
        return rows.select("id", v.alias("v"), w.alias("w"), F.size("v").alias("dim"))

    def parts(df: DataFrame, rows: int, size: int) -> int:
        n, dims = df.agg(F.count("*"), F.sum(F.col("dim").cast("long"))).first()
        return max(1, -(-n // rows), -(-8 * (dims or 0) // size))

    vectors, asked = usable(candidates), usable(queries).groupBy("id", "dim").agg(F.min(F.struct("v", "w")).alias("s")).select("id", "dim", "s.v", "s.w")
    shards, blocks = parts(vectors, SHARD_ROWS, SHARD_BYTES), parts(asked, QUERY_ROWS, QUERY_BYTES)
    deal = lambda of, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(of))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    left = asked.withColumn("block", deal(blocks, 1)).withColumn("shard", F.explode(upto(shards)))
    # repeated ids would meet in one shard, so rows are dealt by their place as well
    right = vectors.withColumn("shard", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(shards))).withColumn("block", F.explode(upto(blocks)))
    tiles = left.groupBy("dim", "block", "shard").cogroup(right.groupBy("dim", "block", "shard"))
    lists = tiles.applyInArrow(_tile(k, float(scale)), "query_id long, shard long, id long, score long")
    while shards > 1:
        lists = _best(lists.withColumn("shard", F.floor(F.col("shard") / FAN)), k, "query_id", "shard").drop("rank")
        shards = -(-shards // FAN)
    return _best(lists, k, "query_id").select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
