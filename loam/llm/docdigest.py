"""Document fingerprints: quartile bucket digests.

Every byte triplet of a text (UTF-8) is hashed into one of 256 buckets. A digest holds the text's length on a
logarithmic scale (2 hex digits) and, for every bucket, in which quarter of the sorted counts its count lies
(2 bits, so 128 hex digits). Texts that differ a little move few buckets over a quartile.

Two digests' difference is the sum of the buckets' differences (0 to 3; 3 counts 4) and 4 for each step of
length from the second on, at most LENGTH_MOST; likeness is 1 - difference / largest possible difference.

Null texts are empty texts: every count is 0, in the lowest quarter. Equal texts have equal digests. Whole texts
count, in parts where they are very long. Null and repeated ids and rows stay. An empty table gives an empty one; a
table of one row compares it with itself. Only the named columns are read; others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loam.llm.shared import small, written

BUCKETS = 256
#: Triplets counted at once in a very long text.
COUNT_ROWS = 1 << 20
LENGTH_MOST = 64
_STEP = np.array([0, 1, 2, 4])
MOST = BUCKETS * int(_STEP[-1]) + LENGTH_MOST


def triplet_counts(raw: bytes) -> np.ndarray:
    counts = np.zeros(BUCKETS, np.int64)
    whole = np.frombuffer(raw, np.uint8)
    for at in range(0, len(whole) - 2, COUNT_ROWS):
        b = whole[at : at + COUNT_ROWS + 2].astype(np.uint32)
        mixed = (b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(2654435761)
        counts += np.bincount(mixed >> np.uint32(24), minlength=BUCKETS)
    return counts


def digest(raw: bytes) -> str:
    counts = triplet_counts(raw)
    cuts = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    quarters = (counts[:, None] > cuts[None, :]).sum(1).astype(np.uint8).reshape(-1, 4)
    body = (quarters << np.array([6, 4, 2, 0], np.uint8)).sum(1).astype(np.uint8)
    length = min(255, int(round(8 * np.log2(len(raw) + 1))))
    return f"{length:02x}{body.tobytes().hex()}"


def difference(a: str, b: str) -> int:
    x, y = (np.frombuffer(bytes.fromhex(s), np.uint8) for s in (a, b))
    shifts = np.array([6, 4, 2, 0], np.uint8)
    moved = np.abs((x[1:, None] >> shifts & 3).astype(np.int8) - (y[1:, None] >> shifts & 3).astype(np.int8))
    return int(_STEP[moved].sum()) + min(LENGTH_MOST, 4 * max(0, abs(int(x[0]) - int(y[0])) - 1))


def likeness(a: str, b: str) -> float:
    return 1 - difference(a, b) / MOST


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint): one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([digest(x.as_py() or b"") for x in batch.column(1)], pa.string())], ["id", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, fingerprint string")


def edited(text: str, following: str) -> str:
    """text with its last quarter replaced by as many first characters of the following one, or all it has."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared(doc_id: int | None, text: str, own: str, following: str, following_print: str) -> tuple:
    raw = edited(text, following).encode()
    changed = digest(raw)
    return doc_id, len(text), hashlib.sha256(raw).hexdigest(), own, changed, likeness(own, changed), likeness(own, following_print)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row of a sorted partition with the next; its first and its last row also go out as edges, with texts."""
    names, kinds = [*_NAMES, "edge", "text"], [*_KINDS, pa.int32(), pa.string()]
    table = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    bare = lambda d, t, p, edge: (d, len(t), None, p, None, None, None, edge, t)
    last, out = None, []
    for batch in small(batches):
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = text or ""
            own = digest(text.encode())
            out.append((*compared(*last, text, own), None, None) if last else bare(doc_id, text, own, 0))
            last = doc_id, text, own
        if out:
            yield table(out)
            out = []
    if last:
        yield table([bare(*last, 1)])


def edit_comparison(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each document its digest, that of its text edited with the next document, and their likeness.

    The next document is that of the next id (nulls first; equal ids in the order of their texts' hashes); the first
    follows the last. Documents are range-sorted once; within a partition the next one is the next row.
    Only a partition's first and last document leave it, to be paired with their neighbours'.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the hash only spreads an id that many rows have; rows of equal id and text are alike
    rows = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    found = written(rows.mapInArrow(_pairs, f"{_SCHEMA}, edge int, text string").withColumn("part", F.spark_partition_id()), "compared")
    inner = found.filter("edge is null").select(*_NAMES)
    # two rows for each partition: its first (edge 0) and its last (edge 1); only the partitions' numbers are ordered
    ends = found.filter("edge is not null")
    order = Window.orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = ends.filter("edge = 1").select("part").withColumn("next", F.coalesce(F.lead("part").over(order), F.first("part").over(whole)))
    first = ends.filter("edge = 0").select(F.col("part").alias("next"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    met = ends.filter("edge = 1").select("part", "doc_id", "text", "fingerprint").join(after, "part").join(first, "next")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows = [compared(d, t, p, nt, np_) for d, t, p, nt, np_ in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], _NAMES)

    last = met.select("doc_id", "text", "fingerprint", "next_text", "next_print").mapInArrow(run, _SCHEMA)
    return inner.union(last)
