"""SimHash near-duplicate search by bit-sliced comparison.

1. A fingerprint per text: every bit is the majority of that bit over the XXH64 hashes of the text's word
   shingles. Lanes of 64 bits after the first take the majority over the hashes, mixed again.
2. Texts meet in buckets. For radius r, 64 bits are cut into r + 2 blocks, and a table is keyed by each pair of
   blocks: two of them are equal in every pair within the radius, so no link is lost. No bucket is capped. Where
   there are more fingerprints, more and smaller blocks are cut and more of them make up a key, so that buckets
   don't grow with their number.
   (neardup.py brings texts together by rare shingles instead.)
3. A bucket is compared in vertical bit planes: plane k holds bit k of 64 fingerprints a word. Differing
   bits are summed by carry-save counters for 64 pairs at once, and a block of pairs is abandoned once all
   of them exceed the radius. Buckets beyond BLOCK_ROWS are cut into blocks and compared as block pairs in
   separate tasks; a task holds two blocks at most.
4. The links' connected components are classes; their name is the smallest id in them. Each bucket gives a spanning
   forest of its links, as every link counts here and components need no more.

Null texts and texts without words have fingerprint 0 and link like any other. Whole texts vote, in parts where they
are very long. Rows with a null id take part; a class of null ids alone has a null name. Repeated rows stay. An empty
table gives an empty one. Only the named columns are read; others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.components import connected_components
from loam.llm.shared import removed, small, written

#: Fingerprints in a block of a split bucket.
BLOCK_ROWS = 2048
#: Runs up to this length are compared at all offsets within one set of planes.
SHORT_RUN = 64
#: Fingerprints that a bucket of equal bits may hold on average before keys get longer.
BUCKET_ROWS = 16
#: Rows gathered before a comparison, unless one run alone is longer.
BUFFER_ROWS = 32768
#: Hashes voted on at once in a very long text.
VOTE_ROWS = 65536

ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: bytes | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of `words` words of the lower-cased (A-Z) text; of all words if it has fewer."""
    found = (text or b"").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(found) - words + 1)
    last = ends[min(words, len(found)) - 1 :][:n] - 1
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)), np.uint64, n)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Another hash of each hash (the finalizer of splitmix64)."""
    h = h + np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprint(hashes: np.ndarray, lanes: int = 1) -> list[int]:
    """Per lane: bit k is 1 if it is set in over half of the hashes; 0 for none."""
    out = []
    for lane in range(lanes):
        hashes = _mixed(hashes) if lane else hashes
        votes = np.zeros(64, np.int64)
        for at in range(0, len(hashes), VOTE_ROWS):
            part = hashes[at : at + VOTE_ROWS]
            votes += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.uint32)
        out.append(int(np.packbits((2 * votes > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")[0]))
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """(id, fp): one row per document, the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = np.array([fingerprint(shingle_hashes(x.as_py(), words))[0] for x in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, fp long")


def block_masks(radius: int, nodes: int = 0) -> list[tuple[int, ...]]:
    """A mask for every choice of all but `radius` of the blocks that 64 bits are cut into: none of the links is lost.

    There are radius + 2 blocks, and one more for as long as a mask's bits leave over BUCKET_ROWS of so many nodes in a bucket.
    """
    n = radius + 2
    while nodes / 2 ** (64 * (n - radius) / n) > BUCKET_ROWS:
        n += 1
    cuts = [round(64 * k / n) for k in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [(reduce(int.__or__, chosen),) for chosen in combinations(blocks, n - radius)]


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """Rows of words: bit r of word w in plane k is bit k of fingerprint 64 * w + r. fps: a row of lanes each."""
    padded = np.zeros((-(-len(fps) // 64) * 64, fps.shape[1]), "<u8")
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(len(padded), -1), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def _beyond(counts: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Bits of the pairs whose count is over the radius."""
    more, same = over.copy(), np.full_like(over, ONES)
    for k in reversed(range(len(counts))):
        if radius >> k & 1:
            same &= counts[k]
        else:
            more |= same & counts[k]
            same &= ~counts[k]
    return more


def within(difference, shape: tuple, radius: int, planes: int = 64, wanted: np.ndarray | None = None) -> np.ndarray:
    """Words whose bits say which pairs differ in at most `radius` bits.

    difference(k, at): plane k of the pairs' differing bits, at all words (at None) or the given ones.
    Two planes and the lowest counter go through a full adder; the carry ripples into the other counters and
    a sticky overflow. After every 16 planes, words in which all pairs exceed the radius are left out.
    """
    out = np.zeros(int(np.prod(shape)), np.uint64)
    at, live = None, (np.full(out.shape, ONES) if wanted is None else np.broadcast_to(wanted, shape).reshape(-1).copy())
    counts, over = [np.zeros_like(out) for _ in range(max(1, radius.bit_length()))], np.zeros_like(out)
    for k in range(0, planes, 2):
        x, y = difference(k, at), difference(k + 1, at)
        half = counts[0] ^ x
        carry = (counts[0] & x) | (half & y)
        counts[0] = half ^ y
        for level in range(1, len(counts)):
            carry, counts[level] = counts[level] & carry, counts[level] ^ carry
        over |= carry
        if k % 16 == 14:
            live &= ~_beyond(counts, over, radius)
            keep = np.flatnonzero(live)
            if not len(keep):
                return out.reshape(shape)
            if 2 * len(keep) < len(live):
                at = keep if at is None else at[keep]
                counts, over, live = [c[keep] for c in counts], over[keep], live[keep]
    if at is None:
        out[:] = live
    else:
        out[at] = live
    return out.reshape(shape)


def _set_bits(words: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(words.astype("<u8").view(np.uint8), bitorder="little")[:n])


def short_run_links(fps: np.ndarray, lengths: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs linked within consecutive runs of at most SHORT_RUN rows, for all runs at one offset at a time."""
    order = np.argsort(-lengths, kind="stable")
    starts = np.cumsum(lengths) - lengths
    sizes = lengths[order]
    rows = np.repeat(starts[order] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    run, planes = np.repeat(np.arange(len(sizes)), sizes), bit_planes(fps[rows])
    count = len(planes)
    planes = np.concatenate([planes, np.zeros((count, 2), np.uint64)], axis=1)
    left, right = [], []
    for d in range(1, int(sizes[0])):
        n = int(sizes[sizes > d].sum())
        width, word, shift = -(-n // 64), d // 64, np.uint64(d % 64)
        same = np.zeros(width * 64, np.uint8)
        same[: n - d] = run[: n - d] == run[d:n]
        wanted = np.packbits(same, bitorder="little").view("<u8")

        def difference(k: int, at: np.ndarray | None, width=width, word=word, shift=shift, d=d) -> np.ndarray:
            at = np.arange(width) if at is None else at
            moved = planes[k][at + word] >> shift
            if d % 64:
                moved |= planes[k][at + word + 1] << np.uint64(64 - d % 64)
            return planes[k][at] ^ moved

        hits = _set_bits(within(difference, (width,), radius, count, wanted), n)
        left.append(rows[hits])
        right.append(rows[hits + d])
    return np.concatenate(left), np.concatenate(right)


def _near(fps: np.ndarray, planes: np.ndarray, radius: int, strip: int = 128) -> np.ndarray:
    """A row of bits per fingerprint: which are within the radius of it (itself always is)."""
    n, width = len(fps), planes.shape[1]
    near = np.zeros((n, width), np.uint64)
    valid = np.packbits(np.arange(width * 64) < n, bitorder="little").view("<u8")
    for a in range(0, n, strip):
        rows = fps[a : a + strip]
        ask = [np.where(rows[:, k // 64] >> np.uint64(k % 64) & np.uint64(1), ONES, np.uint64(0)) for k in range(len(planes))]

        def difference(k: int, at: np.ndarray | None, ask=ask) -> np.ndarray:
            if at is None:
                return (planes[k][None, :] ^ ask[k][:, None]).reshape(-1)
            return planes[k][at % width] ^ ask[k][at // width]

        near[a : a + strip] = within(difference, (len(rows), width), radius, len(planes), valid[None, :])
    return near


def long_run_links(fps: np.ndarray, radius: int, kin: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs that connect what is linked in one run of any length: a spanning forest, by breadth-first search."""
    n, near = len(fps), _near(fps, bit_planes(fps), radius)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    seen = np.zeros(n, bool)
    for seed in np.flatnonzero(np.bitwise_count(near).sum(1) > 1):
        if seen[seed]:
            continue
        seen[seed], front = True, [seed]
        while front:
            k = front.pop()
            found = _set_bits(near[k], n)
            found = found[~seen[found] if kin is None else ~seen[found] & (kin[found] != kin[k])]
            seen[found] = True
            front += found.tolist()
            left.append(np.full(len(found), k))
            right.append(found)
    return np.concatenate(left), np.concatenate(right)


def spanning_forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The places of links (a, b) over n rows that make up a spanning forest (by Boruvka's rounds)."""
    place, root, chosen = np.arange(len(a)), np.arange(n), []
    while len(place):
        x, y = root[a[place]], root[b[place]]
        place, x, y = place[x != y], x[x != y], y[x != y]
        first = np.full(n, len(a))
        np.minimum.at(first, x, place)
        np.minimum.at(first, y, place)
        best = np.unique(first[first < len(a)])
        chosen.append(best)
        # each set hangs on the other end of its first link; of two that chose the same link the smaller stays
        up = np.arange(n)
        ends = np.stack([root[a[best]], root[b[best]]])
        for own, other in (ends, ends[::-1]):
            mine = first[own] == best
            up[own[mine]] = other[mine]
        twice = (up[up] == np.arange(n)) & (np.arange(n) < up)
        up[twice] = np.flatnonzero(twice)
        while (up[up] != up).any():
            up = up[up]
        root = up[root]
    return np.concatenate(chosen) if chosen else np.empty(0, np.int64)


def run_links(fps: np.ndarray, lengths: np.ndarray, radius: int, kin: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs that connect what is linked within consecutive runs; with kin, over links between different ones alone."""
    return _in_runs(fps, lengths, radius, kin, True)


def run_pairs(fps: np.ndarray, lengths: np.ndarray, radius: int, kin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All row pairs of different kin linked within consecutive runs."""
    return _in_runs(fps, lengths, radius, kin, False)


def _in_runs(fps: np.ndarray, lengths: np.ndarray, radius: int, kin: np.ndarray | None, forest: bool) -> tuple[np.ndarray, np.ndarray]:
    starts, left, right = np.cumsum(lengths) - lengths, [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    short = (lengths > 1) & (lengths <= SHORT_RUN)
    if short.any():
        rows = np.flatnonzero(np.repeat(short, lengths))
        a, b = (rows[x] for x in short_run_links(fps[rows], lengths[short], radius))
        if kin is not None:
            a, b = a[kin[a] != kin[b]], b[kin[a] != kin[b]]
        if forest:
            kept = spanning_forest(len(fps), a, b)
            a, b = a[kept], b[kept]
        left.append(a)
        right.append(b)
    for k in np.flatnonzero(lengths > SHORT_RUN):
        at = slice(starts[k], starts[k] + lengths[k])
        own = None if kin is None else kin[at]
        if forest:
            a, b = long_run_links(fps[at], radius, own)
        else:
            near = _near(fps[at], bit_planes(fps[at]), radius)
            found = [(r, x[(x > r) & (own[x] != own[r])]) for r, x in enumerate(_set_bits(w, lengths[k]) for w in near)]
            a, b = np.repeat([r for r, _ in found], [len(x) for _, x in found]).astype(np.int64), np.concatenate([x for _, x in found])
        left.append(a + starts[k])
        right.append(b + starts[k])
    return np.concatenate(left), np.concatenate(right)


def compare(radius: int, kin: bool = False):
    """(a, b) of rows (bucket, i, j, node, [kin,] lanes...), which arrive sorted: a spanning forest of each run's links."""

    def links(rows: np.ndarray) -> pa.RecordBatch:
        edge = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(axis=0)) + 1
        lengths = np.diff(np.concatenate(([0], edge, [rows.shape[1]])))
        fps = np.ascontiguousarray(rows[5 if kin else 4 :].T).view(np.uint64)
        a, b = run_links(fps, lengths, radius, rows[4] if kin else None)
        return pa.RecordBatch.from_arrays([pa.array(rows[3][a]), pa.array(rows[3][b])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
            if sum(x.shape[1] for x in held) >= BUFFER_ROWS:
                rows = np.concatenate(held, axis=1)
                last = np.flatnonzero((rows[:3] != rows[:3, -1:]).any(axis=0))
                cut = int(last[-1]) + 1 if len(last) else 0
                held = [rows[:, cut:]]
                if cut:
                    yield links(np.ascontiguousarray(rows[:, :cut]))
        if held and (rows := np.concatenate(held, axis=1)).shape[1]:
            yield links(rows)

    return run


def tiles(rows: DataFrame, names: list[str]) -> DataFrame:
    """(bucket, i, j and the names), sorted: each bucket, or each pair of its blocks, in one run.

    rows: bucket, n blocks of it (null: one), the row's own block, the names. Rows may have pure_from and pure_to:
    blocks from the one to before the other need no comparison with them.
    """
    every = F.sequence(F.lit(0), F.greatest(F.col("n"), F.lit(1)) - 1)
    if "pure_from" in rows.columns:
        every = F.filter(every, lambda x: (x < F.col("pure_from")) | (x >= F.col("pure_to")))
    other = F.explode(F.when(F.coalesce("n", F.lit(1)) <= 1, F.array(F.lit(0))).otherwise(every))
    met = rows.withColumn("own", F.coalesce("own", F.lit(0))).withColumn("other", other)
    return met.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *names).repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")


def fingerprint_links(nodes: DataFrame, masks: list[tuple[int, ...]], radius: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b): nodes linked, enough to connect all that are within the radius and meet under a mask.

    nodes: node and f0, f1..., all long, one row per node.
    """
    lanes = [c for c in nodes.columns if c != "node"]
    signed = lambda m: F.lit(m - (1 << 64) if m >> 63 else m).cast("long")
    keys = F.array(*(F.xxhash64(F.lit(t), *(F.col(f).bitwiseAND(signed(m)) for f, m in zip(lanes, mask, strict=True))) for t, mask in enumerate(masks)))
    rows = nodes.select(F.explode(keys).alias("bucket"), "node", *lanes)
    hot = written(rows.groupBy("bucket").count().filter(F.col("count") > block_rows).select("bucket", F.ceil(F.col("count") / block_rows).cast("int").alias("n")), "hot-buckets")
    rows = rows.join(hot, "bucket", "left").withColumn("own", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))
    return tiles(rows, ["node", *lanes]).mapInArrow(compare(radius), "a long, b long")


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, radius: int = 4) -> DataFrame:
    """(id, fp, component_id) for every row; component_id is the smallest id reachable over links of 64-bit fingerprints."""
    own = written(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = written(own.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    links = fingerprint_links(nodes.select(F.col("fp").alias("node"), F.col("fp").alias("f0")), block_masks(radius, nodes.count()), radius)
    roots = written(connected_components(links), "roots")
    linked = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = written(linked.groupBy("root").agg(F.min("least").alias("component_id")), "class-names")
    classes = written(linked.join(names, "root").select("fp", "component_id"), "classes")
    removed(nodes, roots, names)
    return own.join(classes, "fp").select("id", "fp", "component_id")


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
