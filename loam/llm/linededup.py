"""Line dedup with two Bloom filters.

A line's key is the line with white space stripped at both ends and A-Z lower-cased. Keys of at least LEAST code
points that several documents hold lose all their lines except in the document of the smallest id.

1. Each document sets PROBES bits for each of its distinct keys. Bits set by one document or more are the filter of
   keys seen once, bits set by two or more that of keys seen twice. Tasks count the documents of each bit, Spark adds the
   counts up (each task sends a bit once), and only the second filter is kept.
2. Documents are read again. A key whose bits are all in the second filter may be repeated, every other key is not:
   so only suspects go through a shuffle, as 16-byte digests with their document's id.
3. Suspects are confirmed: a digest with two ids is repeated, and its smallest id keeps it. What a document loses
   is joined to it, and only documents that lose lines are cut into lines again.

The filters have BITS_PER_LINE bits a line, MOST_BITS at most: that bounds the second filter, which is broadcast, at 64 MB.
Beyond some 10^8 lines they fill up; then more keys are suspects, at worst all (24 bytes a line), and results stay
exact. Keys are told apart by 128-bit hashes.

Texts of any length are read whole, line by line. Null and empty texts are one empty line. Rows of one id are one
document, in which no row loses lines to another; the rows without an id are one too, behind all others. Documents
without rows don't exist: an empty table gives an empty one. Ids are whole numbers. All columns come back in a struct,
so they may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loam.llm.shared import small, written

LEAST = 10
BITS_PER_LINE, MOST_BITS, PROBES = 16, 1 << 29, 2
#: Bits of a row of the filter on its way to the driver.
WORD_BITS = 1 << 20
WHITE = b" \t\n\x0b\x0c\r"
#: Keys of documents that are one array at a time, unless one document has more.
GROUP_KEYS = 1 << 18


def line_key(line: bytes) -> bytes:
    return line.strip(WHITE).lower()


def is_long(key: bytes, least: int = LEAST) -> bool:
    """Whether it has so many code points."""
    return len(key) >= 4 * least or len(key) >= least and len(key.decode()) >= least


def digests(text: str | None, least: int = LEAST) -> set[bytes]:
    """Of the distinct keys that are long enough."""
    keys = {line_key(x) for x in (text or "").encode().split(b"\n")}
    return {xxhash.xxh3_128_digest(k) for k in keys if is_long(k, least)}


def probes(found: np.ndarray, bits: int) -> np.ndarray:
    """The bits of digests, each a row of two numbers: PROBES columns."""
    step = found[:, 1] | np.uint64(1)
    return np.stack([(found[:, 0] + np.uint64(k) * step) & np.uint64(bits - 1) for k in range(PROBES)], axis=1).astype(np.int64)


def _groups(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(ids, sizes, digests as pairs of numbers) of some documents at a time; batches: id and text."""
    for batch in small(batches):
        at, raw, sizes = 0, [], []
        for k, text in enumerate(batch.column(1)):
            found = digests(text.as_py(), least)
            raw += found
            sizes.append(len(found))
            if len(raw) >= GROUP_KEYS or k + 1 == batch.num_rows:
                yield batch.column(0).slice(at, k + 1 - at), np.array(sizes), np.frombuffer(b"".join(raw), np.uint64).reshape(-1, 2)
                at, raw, sizes = k + 1, [], []


def twice_seen(docs: DataFrame, lines: int, least: int = LEAST) -> np.ndarray:
    """The filter of keys seen twice, as bytes of 8 bits. docs: (id, text)."""
    bits = WORD_BITS
    while bits < min(MOST_BITS, lines * BITS_PER_LINE):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, found in _groups(batches, least):
            # two keys of one document that share a bit count as two: a suspect more
            at, n = np.unique(probes(found, bits), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.minimum(n, 2))], ["at", "n"])

    counted = docs.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).filter("n > 1")
    words = counted.groupBy(F.floor(F.col("at") / WORD_BITS).alias("word")).agg(F.collect_list((F.col("at") % WORD_BITS).cast("int")).alias("at"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 1):
            flags = np.zeros(WORD_BITS, np.uint8)
            flags[batch.column(1).flatten().to_numpy()] = 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.packbits(flags).tobytes()], pa.binary())], ["word", "flags"])

    out = np.zeros(bits // 8, np.uint8)
    for row in words.mapInArrow(packed, "word long, flags binary").toLocalIterator():  # MOST_BITS / 8 bytes at most
        own = np.frombuffer(row["flags"], np.uint8)
        out[row["word"] * len(own) : (row["word"] + 1) * len(own)] = own
    return out


def suspects(docs: DataFrame, twice: np.ndarray, least: int = LEAST) -> DataFrame:
    """(id, digest), distinct in each row: the keys whose bits are all in the filter."""
    shared, bits = docs.sparkSession.sparkContext.broadcast(twice.tobytes()), 8 * len(twice)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(shared.value, np.uint8)
        for ids, sizes, found in _groups(batches, least):
            at = probes(found, bits)
            on = np.flatnonzero((flags[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).all(axis=1))
            rows = np.repeat(np.arange(len(sizes)), sizes)[on]
            digest = pa.Array.from_buffers(pa.binary(16), len(on), [None, pa.py_buffer(np.ascontiguousarray(found[on]))])
            yield pa.RecordBatch.from_arrays([pc.take(ids, pa.array(rows)), digest.cast(pa.binary())], ["id", "digest"])

    return docs.mapInArrow(run, T.StructType([docs.schema["id"], T.StructField("digest", T.BinaryType())]))


def _kept(least: int):
    @F.pandas_udf("kept string, n_dropped long")
    def keep(texts, lost):
        import pandas as pd

        out = []
        for text, gone in zip(texts, lost, strict=True):
            if text is None or gone is None:
                out.append((None, 0))
                continue
            drop, lines = {bytes(x) for x in gone}, text.encode().split(b"\n")
            stay = [x for x in lines if not (is_long(k := line_key(x), least) and xxhash.xxh3_128_digest(k) in drop)]
            out.append((b"\n".join(stay).decode(), len(lines) - len(stay)))
        return pd.DataFrame(out, columns=["kept", "n_dropped"])

    return keep


def repeated(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(id, lost): what each document loses, as digests; documents that lose nothing don't appear. docs: (id, text)."""
    lines = docs.agg(F.sum(F.regexp_count("text", F.lit("\n")) + 1)).first()[0] or 0
    found = written(suspects(docs, twice_seen(docs, lines, least), least), "suspects")
    place = F.struct(F.col("id").isNull().alias("none"), "id")
    firsts = found.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last")
    firsts = written(firsts.select("digest", "first"), "firsts")
    lost = found.join(firsts, "digest").filter(~F.col("first.id").eqNullSafe(F.col("id")))
    return lost.groupBy("id").agg(F.collect_set("digest").alias("lost"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(row, n_lines, n_dropped, kept): each row of docs as a struct, and the text of the lines that stay."""
    lost = written(repeated(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), least), "lost")
    rows = docs.select(F.struct("*").alias("row"))
    text = F.coalesce(F.col("row").getField(text_col), F.lit(""))
    rows = rows.join(lost, F.col("row").getField(id_col).eqNullSafe(F.col("id")), "left")
    cut = _kept(least)(F.when(F.col("lost").isNotNull(), text), "lost")
    rows = rows.select("row", text.alias("text"), (F.regexp_count(text, F.lit("\n")) + 1).cast("long").alias("n_lines"), cut.alias("cut"))
    return rows.select("row", "n_lines", F.col("cut.n_dropped").alias("n_dropped"), F.coalesce("cut.kept", "text").alias("kept"))
