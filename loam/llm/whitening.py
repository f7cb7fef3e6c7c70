"""Embedding whitening: covariances by polarisation, principal components, whitened coordinates.

1. Each component c becomes the whole number floor(scale * c) + OFFSET. The fit list holds each distinct vector of
   these once (copies are combined before the shuffle that finds them).
2. n and the sums S of the fit list give a whole centre, the nearest to S / n in each dimension. Tasks add up the squares
   of every centred dimension and of every sum of two centred dimensions; the variance of a sum less those of its
   two parts is twice their covariance. All of that is whole numbers, in 64 bits where a block of rows can't pass
   them and of any size elsewhere; what the centre lacks to S / n is made up for exactly. Only D (D + 1) / 2 totals
   reach the driver (D: the vectors' length), which divides them into doubles and calls eigh.
3. A pass over the fit list measures the whitened covariance; the last one gives every row its coordinates.

Vectors that are null or hold null or non-finite components are dropped. 64 * c beyond a long counts as the nearest one.
Vectors of different lengths are fitted apart, each length by itself; empty vectors have no component and no row.
Components without variance (all, if the fit list holds one vector) have whitened and explained 0 and take no part in
identity_error. Components of equal variance come in the order of eigh. Null and repeated ids and rows stay. An
empty table gives an empty one. deviation beyond a long is the nearest long. Only the named columns are read; others may
have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.llm.shared import small, written
from loam.llm.topk import finite

OFFSET = 1_000_000
#: Rows of vectors that are one matrix at a time.
BLOCK_ROWS = 2048
#: Eigenvalues under this share of the trace are rounding errors.
NOTHING = 1e-13
_SAFE = 1 << 62
#: Bits of the digits in which whole numbers of any size are added up by Spark.
LIMB = 56
_LIMB = (1 << LIMB) - 1
TOTALS = "k int, a long, b long, c long"


@dataclass
class Whitening:
    n: int
    sums: list[int]
    vectors: np.ndarray  # a component in each column
    variances: np.ndarray  # of the components, falling; 0 where there is none
    explained: np.ndarray
    identity_error: float = 0.0


def whole(vector: Column, scale: float) -> Column:
    """floor(scale * c) + OFFSET of all components, as longs."""
    least, most = float(-(1 << 63)), float((1 << 63) - (1 << 21))
    return F.transform(vector, lambda c: F.floor(F.greatest(F.lit(least), F.least(F.lit(most), F.lit(float(scale)) * c.cast("double")))).cast("long") + OFFSET)


def matrices(batches: Iterator[pa.RecordBatch], column: int, rows: int = BLOCK_ROWS) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of bounded rows with the matrix of their vectors, whose lengths are equal."""
    for batch in small(batches, rows):
        x = batch.column(column)
        yield batch, x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def span(x: np.ndarray) -> int:
    """The largest absolute value."""
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def _moved(x: np.ndarray, factor: int, less: list[int], terms: int) -> np.ndarray:
    """factor * x - less: longs if sums of so many squares of them fit in one, else Python's integers."""
    if factor * span(x) + max(map(abs, less), default=0) < _SAFE:
        out = factor * x - np.array(less, np.int64)
        return out if terms * span(out) ** 2 < _SAFE else out.astype(object)
    return factor * x.astype(object) - np.array(less, object)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, total): the number of vectors for k = -1, the sum of dimension k elsewhere."""
    n, total = 0, None
    for _, x in matrices(batches, 0):
        own = [int(a) * (1 << 32) + int(b) for a, b in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), strict=True)]
        n, total = n + len(x), own if total is None else [a + b for a, b in zip(total, own, strict=True)]
    if n:
        yield _totals([n, *total], -1)


def _totals(values: list[int], first: int = 0) -> pa.RecordBatch:
    """Whole numbers of any size in digits of LIMB bits, the last of which holds the sign."""
    limbs = [[v & _LIMB for v in values], [v >> LIMB & _LIMB for v in values], [v >> 2 * LIMB for v in values]]
    return pa.RecordBatch.from_arrays([pa.array(range(first, first + len(values)), pa.int32()), *(pa.array(x, pa.int64()) for x in limbs)], ["k", "a", "b", "c"])


def pair_squares(x: np.ndarray, centre: list[int]) -> list[int]:
    """For i <= j in order: the sum over rows of the square of centred dimension i (i = j) or of dimensions i and j added."""
    y, out = _moved(x, 1, centre, 4 * len(x)), []
    for i in range(y.shape[1]):
        added = y[:, i:] + y[:, i : i + 1]
        added[:, 0] = y[:, i]
        out += (added * added).sum(axis=0).tolist()
    return [int(v) for v in out]


def _squares(centre: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in matrices(batches, 0):
            own = pair_squares(x, centre)
            total = own if total is None else [a + b for a, b in zip(total, own, strict=True)]
        if total:
            yield _totals(total)

    return run


def _summed(rows: DataFrame) -> list[int]:
    digits = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in "abc"]
    return [int(r["a"]) + (int(r["b"]) << LIMB) + (int(r["c"]) << 2 * LIMB) for r in sorted(rows.groupBy("k").agg(*digits).collect(), key=lambda r: r["k"])]


def covariance(squares: list[int], n: int, sums: list[int], centre: list[int]) -> np.ndarray:
    """The covariance matrix, divisor n, from pair_squares of n rows about the centre; each entry is rounded once."""
    dim, rest = len(sums), [s - n * c for s, c in zip(sums, centre, strict=True)]
    square = np.empty((dim, dim), object)
    square[np.triu_indices(dim)] = squares
    out = np.empty((dim, dim))
    for i in range(dim):
        for j in range(i, dim):
            # twice the sum of products; differences of variances for i < j
            double = 2 * square[i, i] if i == j else square[i, j] - square[i, i] - square[j, j]
            out[i, j] = out[j, i] = (n * double - 2 * rest[i] * rest[j]) / (2 * n * n)
    return out


def fitted(vectors: DataFrame, dim: int) -> Whitening | None:
    """The whitening of a table (x) of distinct vectors of a length."""
    counted = _summed(vectors.mapInArrow(_sums, TOTALS))
    if not counted or not dim:
        return None
    n, *sums = counted
    centre = [(2 * s + n) // (2 * n) for s in sums]
    cov = covariance(_summed(vectors.mapInArrow(_squares(centre), TOTALS)), n, sums, centre)
    values, axes = np.linalg.eigh(cov)
    values, axes, trace = values[::-1], np.ascontiguousarray(axes[:, ::-1]), float(np.trace(cov))
    values = np.where(values > NOTHING * trace, values, 0.0)
    return Whitening(n, sums, axes, values, values / trace if trace > 0 else np.zeros(dim))


def centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - S, exact."""
    return _moved(x, model.n, model.sums, x.shape[1])


def projected(shifted: np.ndarray, model: Whitening, most: int) -> np.ndarray:
    """The whitened coordinates of rows n * x - S on the first components."""
    scale = np.where(model.variances > 0, 1 / np.sqrt(np.where(model.variances > 0, model.variances, 1)), 0)[:most]
    return (shifted.astype(float) / model.n) @ model.vectors[:, :most] * scale


def measured(vectors: DataFrame, model: Whitening, most: int) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, added up over the fit list."""
    width = int((model.variances[:most] > 0).sum())
    if not width:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for _, x in matrices(batches, 0):
            z = projected(centred(x, model), model, width)
            total += np.concatenate([z.T @ z, z.sum(axis=0)[None]])
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.reshape(-1))], ["k", "total"])

    rows = vectors.mapInArrow(run, "k int, total double").groupBy("k").agg(F.sum("total").alias("total")).collect()
    flat = np.zeros((width + 1) * width)
    for r in rows:
        flat[r["k"]] = r["total"]
    flat = flat.reshape(width + 1, width) / model.n
    return float(np.abs(flat[:-1] - np.outer(flat[-1], flat[-1]) - np.eye(width)).max())


def _coordinates(model: Whitening, most: int):
    width = min(most, len(model.sums))
    edge = (1 << 63) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in matrices(batches, 1):
            shifted = centred(x, model)
            deviation = [min(int(v), edge) for v in (shifted * shifted).sum(axis=1).tolist()]
            z = projected(shifted, model, width)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, width, dtype=np.int32)), pa.array(z.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.int64()), lists], ["id", "deviation", "z"])

    return run


def whitened(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16, scale: float = 64) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each row and component."""
    spark, vector = table.sparkSession, F.col(vector_col)
    rows = table.select(F.col(id_col).alias("vec_id"), vector.alias("v")).filter(finite(F.col("v"))).select("vec_id", whole(F.col("v"), scale).alias("x"))
    fit = written(rows.select("x").distinct().withColumn("dim", F.size("x")), "fit")
    kind = rows.schema["vec_id"].dataType.simpleString()
    out = None
    for dim in sorted(r["dim"] for r in fit.filter("dim > 0").select("dim").distinct().collect()):
        own = fit.filter(F.col("dim") == dim).select("x")
        model = fitted(own, dim)
        model.identity_error = measured(own, model, components)
        found = rows.filter(F.size("x") == dim).mapInArrow(_coordinates(model, components), f"id {kind}, deviation long, z array<double>")
        explained = F.array(*(F.lit(float(v)) for v in model.explained[:components]))
        part = found.select("id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
            F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", explained[F.col("at")].alias("explained"), F.lit(model.identity_error).alias("identity_error")
        )
        out = part if out is None else out.union(part)
    empty = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return spark.createDataFrame([], empty) if out is None else out
