"""Near-dedup by SimHash over shingle sets: whole, exact but for a stated chance, and without pairs of a group.

Texts are alike if the Jaccard similarity of the sets of their word shingles is at least a threshold.

1. Sketches. A text's shingles vote once each on a fingerprint of 256 bits. Equal texts are told by two 64-bit
   hashes and are one node.
2. Meetings. Two sets alike share one of the few shingles of each that are rarest in the corpus (prefix filtering),
   so texts that share such a shingle meet; every pair alike does. Shingles with the same texts are one meeting.
3. Stars. In each meeting all texts are compared with one of them, and each text puts its nearest such star to the
   exact test. This joins most copies with one test a text, however large their group.
4. What remains. Within each meeting the texts not joined yet are compared in bit planes (simhash.py). Links within
   RADIUS between different sets of copies give candidates; their components are cut into blocks, and every pair of
   blocks is one task that holds their texts, finds all pairs within the radius in bit planes and puts them to the
   exact test, unless a link already found joins them.
5. Components of the links that passed are classes. Of each the smallest id stays.

Two sets alike differ in at most 38.8 of 256 bits on average, and exceed RADIUS with the chance that `missed` states
(under 1e-10 for large sets, about 1e-6 for the worst small ones). Texts that share a tenth of their shingles, such as pages of a
template, come within it once in some millions of pairs, so their candidates stay few. With radius 256 nothing is
left to chance: that is the exact mode, which tests all pairs that meet. No meeting, group or text is capped or sampled.

Null texts and texts without words are equal to each other as sets. Repeated rows, and rows of equal text, leave one
row. Rows with a null id take part, last. Texts of any length are read whole. An empty table gives an empty one. All
columns come back as they are; they may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, comb, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.llm.components import connected_components
from loam.llm.shared import removed, small, written
from loam.llm.simhash import BLOCK_ROWS, compare, fingerprint, run_pairs, shingle_hashes, tiles

#: Of 64 bits each in a fingerprint; and the bits that may differ.
LANES, RADIUS = 4, 80
FPS = tuple(f"f{k}" for k in range(LANES))
#: Shingles whose counts order the others by rarity; it changes how many pairs meet, not which are found.
COMMON = 200_000
#: Shingles by which so many texts would meet are dealt out by text as well, since one task may not hold their texts.
HOT_ROWS, SALTS = 50_000, 256
#: Shingles held while they are counted.
COUNT_ROWS = 1 << 20
#: Shingles of the texts in a block of a large group.
BLOCK_SHINGLES = 1 << 19
#: Bytes of texts gathered before a test, unless one group alone is larger.
BUFFER_BYTES = 1 << 24


def missed(similarity: float = 0.8, radius: int = RADIUS, bits: int = 64 * LANES) -> float:
    """The chance that two large sets of equal size and this similarity differ in more bits than the radius."""
    p = acos(2 * similarity / (1 + similarity)) / pi
    return sum(comb(bits, k) * p**k * (1 - p) ** (bits - k) for k in range(radius + 1, bits + 1))


def text_hashes(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes; the first is a text's node."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, words))


def _fresh(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[bytes | None]]]:
    """Nodes and texts of batches (node, text), each node once a task."""
    seen: set[int] = set()
    for batch in small(batches):
        nodes, keep = batch.column(0).to_pylist(), []
        for k, node in enumerate(nodes):
            if node not in seen:
                seen.add(node)
                keep.append(k)
        yield [nodes[k] for k in keep], [batch.column(1)[k].as_py() for k in keep]


def common_shingles(texts: DataFrame, words: int = 5, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """The `most` shingles with the highest counts, ascending, and the counts; texts: (node, text).

    A count is the texts that hold it, but for texts whose neighbours within some million shingles don't. The
    result only orders shingles by rarity, so none need be found.
    """

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        found, count = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found[count > 1].view(np.int64)), pa.array(count[count > 1])], ["shingle", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for _, found in _fresh(batches):
            held += [shingle_set(x, words) for x in found]
            if sum(map(len, held)) >= COUNT_ROWS:
                yield counted(held)
                held = []
        if held:
            yield counted(held)

    top = texts.mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "shingle").limit(most).collect()
    found, count = np.array([r["shingle"] for r in top], np.int64).view(np.uint64), np.array([r["n"] for r in top], np.int64)
    order = np.argsort(found)
    return found[order], count[order]


def rare_first(found: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A shingle set, least common first, in an order that is the same for all texts."""
    names, counts = common
    if not len(names):
        return np.sort(found)
    at = np.minimum(np.searchsorted(names, found), len(names) - 1)
    return found[np.lexsort((found, np.where(names[at] == found, counts[at], 0)))]


def prefix_length(size: int, similarity: float) -> int:
    """Of two sets alike both hold at least `similarity` of either: among all but that many, and one more, one is shared."""
    return size - ceil(similarity * size - 1e-6) + 1


def sketches(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, node, other, size, FPS): one row per document; size is that of its shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            sets = [shingle_set(x.as_py(), words) for x in batch.column(3)]
            lanes = np.array([fingerprint(x, LANES) for x in sets], np.uint64).reshape(-1, LANES)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([len(x) for x in sets], pa.int64()), *(pa.array(np.ascontiguousarray(c).view(np.int64)) for c in lanes.T)], ["id", "node", "other", "size", *FPS]
            )

    node, other = text_hashes(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), node.alias("node"), other.alias("other"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, node long, other long, size long, {', '.join(f'{f} long' for f in FPS)}")


def meetings(texts: DataFrame, common: tuple[np.ndarray, np.ndarray], words: int = 5, similarity: float = 0.8, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(bucket, node): sets of texts that share a shingle that is rare for all of them; every pair alike is in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, found in _fresh(batches):
            kept, sizes = [np.empty(0, np.uint64)], []
            for x in found:
                rare = rare_first(shingle_set(x, words), common)
                n = prefix_length(len(rare), similarity) if len(rare) else 0
                # texts without words meet each other
                kept.append(rare[:n] if n else np.zeros(1, np.uint64))
                sizes.append(max(n, 1))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(kept).view(np.int64)), pa.array(np.repeat(np.array(nodes, np.int64), sizes))], ["bucket", "node"])

    held = written(texts.mapInArrow(run, "bucket long, node long"), "meeting-rows")
    # combined before the shuffle; there are no more of them than hot_rows goes into the rows
    hot = written(held.groupBy("bucket").count().filter(F.col("count") >= hot_rows).select("bucket", F.lit(True).alias("hot")), "hot-shingles")
    rows = held.join(hot, "bucket", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    rows = rows.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("node"), F.lit(SALTS))).otherwise(0))
    rows = rows.repartition("bucket", "salt").distinct()
    same = Window.partitionBy("bucket", "salt")
    # what tells a set of texts: its size and two sums without carry
    marks = [F.count("*").over(same).alias("c"), F.bit_xor("node").over(same).alias("x"), F.bit_xor(F.xxhash64("node")).over(same).alias("y")]
    met = rows.select("bucket", "node", "hot", *marks).filter("hot or c > 1")
    met = written(met.select(F.when(F.col("hot"), F.col("bucket")).otherwise(F.xxhash64("c", "x", "y")).alias("bucket"), "node").distinct(), "meetings")
    removed(held, hot)
    return met


def _distance(a: str, b: str) -> Column:
    return sum((F.bit_count(F.col(f"{a}.{f}").bitwiseXOR(F.col(f"{b}.{f}"))) for f in FPS), F.lit(0))


def _sized(a: Column, b: Column, similarity: float) -> Column:
    """Sets of such sizes can be alike."""
    return F.least(a, b) >= F.greatest(a, b) * similarity - 1e-6


def _with_kin(texts: DataFrame, roots: DataFrame) -> DataFrame:
    return texts.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("kin"), "size", *FPS)


def star_pairs(met: DataFrame, texts: DataFrame, last: bool, similarity: float, radius: int) -> DataFrame:
    """(a, b): for each text the nearest of those that are first (or last) in a meeting with it, if it is near and no kin."""
    star = (F.max if last else F.min)("node").alias("star")
    pairs = met.join(met.groupBy("bucket").agg(star), "bucket").filter("node <> star").select("node", "star").distinct()
    a, b = texts.alias("a"), texts.alias("b")
    ends = pairs.join(a, F.col("a.node") == pairs["node"]).join(b, F.col("b.node") == F.col("star"))
    near = ends.filter(F.col("a.kin") != F.col("b.kin")).filter(_sized(F.col("a.size"), F.col("b.size"), similarity)).select(F.col("a.node").alias("a"), "star", _distance("a", "b").alias("d"))
    return near.filter(F.col("d") <= radius).groupBy("a").agg(F.min_by("star", "d").alias("b"))


def _similar(words: int, least: float):
    """The pairs (a, b) of (a, b, text of a, text of b) whose shingle sets have a Jaccard similarity of at least `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            keep = np.zeros(batch.num_rows, bool)
            for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                keep[k] = alike(shingle_set(x.as_py(), words), shingle_set(y.as_py(), words), least)
            yield batch.filter(pa.array(keep)).select([0, 1])

    return run


def alike(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared >= least * (len(x) + len(y) - shared) - 1e-9


def dealt(rows: DataFrame, weight: Column, block: int) -> DataFrame:
    """rows (bucket, node, kin, ...) of buckets with more than one kin, with the columns that tiles() asks for.

    A bucket of more than `block` in weight is cut into blocks. A kin over that has blocks of its own, which need
    not meet each other; the others share blocks by a hash of their kin.
    """
    sizes = written(rows.groupBy("bucket", "kin").agg(F.sum(weight).alias("w")), "kin-sizes")
    totals = sizes.groupBy("bucket").agg(F.sum("w").alias("w"), F.count("*").alias("kins"), F.sum(F.when(F.col("w") <= block, F.col("w")).otherwise(0)).alias("shared"))
    totals = totals.filter("kins > 1").select("bucket", F.ceil(F.col("shared") / block).cast("int").alias("shared"))
    so_far = Window.partitionBy("bucket").orderBy("kin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    large = sizes.filter(F.col("w") > block).withColumn("k", F.ceil(F.col("w") / block).cast("int")).withColumn("upto", F.sum("k").over(so_far).cast("int"))
    counts = written(totals.join(large.groupBy("bucket").agg(F.sum("k").cast("int").alias("own")), "bucket", "left").select("bucket", "shared", (F.col("shared") + F.coalesce("own", F.lit(0))).alias("n")), "blocks")
    large = written(large.select("bucket", "kin", "k", "upto"), "large-kins")
    met = rows.join(counts, "bucket").join(large, ["bucket", "kin"], "left")
    start = F.col("shared") + F.col("upto") - F.col("k")
    alone = F.col("k").isNotNull()
    return (
        met.withColumn("own", F.when(alone, start + F.pmod(F.xxhash64("node"), F.col("k"))).otherwise(F.pmod(F.xxhash64("kin"), F.greatest("shared", F.lit(1)))).cast("int"))
        .withColumn("pure_from", F.when(alone, start).otherwise(0))
        .withColumn("pure_to", F.when(alone, start + F.col("k")).otherwise(0))
        .drop("shared", "k", "upto")
    )


def _tested(words: int, similarity: float, radius: int):
    """(a, b) of rows (bucket, i, j, node, kin, size, FPS, text), which arrive sorted: links that pass the exact test."""
    width = 6 + LANES

    def links(cols: list[list]) -> pa.RecordBatch:
        rows = np.array(cols[:width], np.int64)
        edge = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(axis=0)) + 1
        lengths = np.diff(np.concatenate(([0], edge, [rows.shape[1]])))
        fps = np.ascontiguousarray(rows[6:].T).view(np.uint64)
        a, b = run_pairs(fps, lengths, radius, rows[4])
        low, high = np.minimum(rows[5][a], rows[5][b]), np.maximum(rows[5][a], rows[5][b])
        keep = low >= similarity * high - 1e-6
        a, b = a[keep], b[keep]
        sets, up, found = {}, {}, []

        def root(k: int) -> int:
            while up.get(k, k) != k:
                k = up[k]
            return k

        for k in np.argsort(np.bitwise_count(fps[a] ^ fps[b]).sum(1), kind="stable"):
            x, y = int(a[k]), int(b[k])
            if (p := root(int(rows[4][x]))) == (q := root(int(rows[4][y]))):
                continue
            for z in (x, y):
                if z not in sets:
                    sets[z] = shingle_set(cols[width][z], words)
            if alike(sets[x], sets[y], similarity):
                up[max(p, q)] = min(p, q)
                found.append((x, y))
        ends = np.array(found, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(rows[3][ends[:, 0]]), pa.array(rows[3][ends[:, 1]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(width + 1)]
        size = 0
        for batch in small(batches, 64):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= BUFFER_BYTES and row[:3] != tuple(c[-1] for c in held[:3]):
                    yield links(held)
                    held, size = [[] for _ in range(width + 1)], 0
                for c, v in zip(held, row, strict=True):
                    c.append(v)
                size += 200 + len(row[width] or b"")
        if held[0]:
            yield links(held)

    return run


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8, radius: int = RADIUS, block_rows: int = BLOCK_ROWS, block_shingles: int = BLOCK_SHINGLES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of docs without near copies: one document of each class stays, with all its columns.

    A class is what links of a similarity of `similarity` or more connect; its smallest id stays (nulls last).
    """
    found = classes(docs, id_col, text_col, words, similarity, radius, block_rows, block_shingles, hot_rows)
    stay = written(found.groupBy("class").agg(F.min(F.struct("rank", "node", "other")).alias("s")).select("s.node", "s.other"), "staying")
    node, other = text_hashes(F.col(text_col))
    rank = F.struct(F.col(id_col).isNull(), F.col(id_col))
    # the first row of each text, found before the shuffle as far as a task sees it
    first = docs.select(F.struct("*").alias("row"), node.alias("node"), other.alias("other"), rank.alias("rank")).groupBy("node", "other").agg(F.min_by("row", "rank").alias("row"))
    return first.join(stay, ["node", "other"], "left_semi").select("row.*")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8, radius: int = RADIUS, block_rows: int = BLOCK_ROWS, block_shingles: int = BLOCK_SHINGLES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(node, other, rank, class): each different text by its two hashes, its smallest id and the class it is in."""
    rank = F.struct(F.col("id").isNull().alias("missing"), F.col("id").alias("id"))
    own = [F.min(c).alias(c) for c in ("size", *FPS)]
    texts = written(sketches(docs, id_col, text_col, words).groupBy("node", "other").agg(*own, F.min(rank).alias("rank")), "texts")
    node, _ = text_hashes(F.col(text_col))
    bodies = docs.select(node.alias("node"), F.col(text_col).cast("binary").alias("text"))
    met = meetings(bodies, common_shingles(bodies, words), words, similarity, hot_rows)
    sketched = texts.groupBy("node").agg(*own, F.count("*").alias("c"))
    # two texts of one node: their node takes no part, so that none goes for a link of the other's
    clashing = written(sketched.filter("c > 1").select("node"), "clashes")
    sketched = written(sketched.filter("c = 1").join(met.select("node").distinct(), "node", "left_semi").drop("c"), "meeting-texts")
    # copies of a text go before the shuffle, as far as a task sees them
    bodies = written(bodies.groupBy("node").agg(F.first("text").alias("text")).join(sketched.select("node"), "node", "left_semi"), "meeting-bodies")
    roots = docs.sparkSession.createDataFrame([], "node long, root long")
    for last in (False, True):
        pairs = written(star_pairs(met, _with_kin(sketched, roots), last, similarity, radius), "star-pairs")
        both = pairs.join(bodies.toDF("a", "text_a"), "a").join(bodies.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")
        # written first, so that no task has workers of both this test and the components
        links = written(both.mapInArrow(_similar(words, similarity), "a long, b long"), "star-links")
        roots = connected_components(links.union(roots))
    kin = written(_with_kin(sketched, roots), "kin")
    apart = met.join(kin, "node").select("bucket", "node", "kin", *FPS)
    several = apart.groupBy("bucket").agg(F.min("kin").alias("low"), F.max("kin").alias("high")).filter("low <> high").select("bucket")
    apart = written(apart.join(several, "bucket"), "apart")
    near = written(tiles(dealt(apart, F.lit(1), block_rows), ["node", "kin", *FPS]).mapInArrow(compare(radius, kin=True), "a long, b long").distinct(), "near")
    removed(met, apart)
    groups = connected_components(near)
    ends = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    members = ends.join(groups, "node", "left").join(kin, "node").select(F.coalesce("root", "node").alias("bucket"), "node", "kin", "size", *FPS)
    blocks = dealt(written(members, "members"), F.col("size") + 1, block_shingles).join(bodies, "node")
    links = written(tiles(blocks, ["node", "kin", "size", *FPS, "text"]).mapInArrow(_tested(words, similarity, radius), "a long, b long"), "links")
    roots = connected_components(links.union(roots))
    removed(near, bodies, kin)
    named = texts.join(roots, "node", "left").join(clashing.withColumn("clash", F.lit(True)), "node", "left")
    name = F.struct(F.coalesce("root", "node").alias("node"), F.when(F.col("clash"), F.col("other")).alias("other"))
    return named.select("node", "other", "rank", name.alias("class"))
