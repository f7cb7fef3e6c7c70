"""Phrase collocations by Toivonen mining: a sample proposes, a full pass counts proposals and their border exactly.

A phrase that occurs LEAST times has parts that do. So phrases of k words are counted where both their parts of k - 1
words are known; known are at first the words and phrases of a sample of documents (a share SHARE, chosen by a hash)
that occur there LOWERED times its share of LEAST, once at least.

1. The first full pass counts all words, and each phrase with known parts: those that are known themselves are
   the proposals, the others the negative border. Counts are exact, by language.
2. What turns out frequent but wasn't known is a failure of the border: it becomes known, and one more pass counts the
   phrases that have known parts only now. This goes on until a pass has no failures; then every frequent phrase
   has been counted, in exactly one pass, whatever the sample held.
3. Frequent phrases are scored, and those that a frequent enough longer one holds are dropped.

Known phrases of each length are bits of a hash filter of BITS a phrase, MOST_BITS in all: that bounds what is broadcast,
at 32 MB a length. Where it says "known" wrongly, or where it is full, more phrases are counted; none is lost. A task counts some
GROUP_WORDS words at once, so that a hot phrase leaves it once a group; Spark adds these counts up.

Texts are read whole, A-Z lower-cased, cut into pieces at `[.,;:!?\\x0A-\\x0D]` and into words at spaces and tabs. Null texts have no words;
a null language is `und`. Ids choose the sample alone; null and repeated ones, and repeated rows, all count.
Counts stay under 10^15. An empty table gives an empty result. Only the named columns are read; others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loam.llm.shared import removed, small, written

SHARE, LOWERED = 0.25, 0.8
BITS, MOST_BITS = 16, 1 << 28
#: Words that a task counts at once; bytes of text that are words at once, unless one text is longer.
GROUP_WORDS, GROUP_BYTES = 1 << 21, 1 << 22
#: Parts of a language whose phrases are ranked apart first.
PARTS = 64
#: Rows that a task hands on at once.
OUT_ROWS = 1 << 18
#: What ends a piece becomes this one.
END = b"."
_ENDS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", END * 9)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Ids(dict):
    """Numbers of words in order of appearance; END is 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def word_hash(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def extended(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases with a word more each."""
    mixed = (hashes ^ (hashes >> np.uint64(29))) * _MIX + words
    return mixed ^ (mixed >> np.uint64(32))


@dataclass
class Known:
    """Known words and phrases, by length: bits of hash filters."""

    flags: list[np.ndarray] = field(default_factory=list)

    def has(self, length: int, hashes: np.ndarray) -> np.ndarray:
        flags = self.flags[length - 1]
        at = hashes & np.uint64(8 * len(flags) - 1)
        return (flags[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

    @classmethod
    def of(cls, phrases: DataFrame, lengths: int) -> Known:
        """Of a table (lang, words, phrase); bits are found by tasks, and no more than MOST_BITS for each length reach the driver."""
        found = cls()
        for k in range(1, lengths + 1):
            own = phrases.filter(F.col("words") == k)
            bits, n = 1 << 16, own.count()
            while bits < min(MOST_BITS, n * BITS):
                bits *= 2
            found.flags.append(np.zeros(bits // 8, np.uint8))
            for at, byte in _bytes(own, bits):
                found.flags[-1][at] = byte
        return found

    def with_more(self, phrases: DataFrame) -> Known:
        """Those and the phrases of a table, in filters of the same sizes."""
        out = Known([f.copy() for f in self.flags])
        for k, flags in enumerate(out.flags):
            for at, byte in _bytes(phrases.filter(F.col("words") == k + 1), 8 * len(flags)):
                flags[at] |= byte
        return out


def phrase_hashes(langs: list[str], phrases: list[bytes]) -> np.ndarray:
    """The hashes that _phrases finds, of phrases of equal or different lengths."""
    split = [p.split(b" ") for p in phrases]
    seeds = {lang: xxhash.xxh64_intdigest(lang.encode()) for lang in set(langs)}
    digest = xxhash.xxh64_intdigest
    flat = np.fromiter((digest(w, seeds[lang]) for lang, words in zip(langs, split, strict=True) for w in words), np.uint64)
    sizes = np.array([len(w) for w in split], np.int64)
    first = np.cumsum(sizes) - sizes
    out = flat[first]
    for k in range(1, int(sizes.max(initial=0))):
        longer = np.flatnonzero(sizes > k)
        out[longer] = extended(out[longer], flat[first[longer] + k])
    return out


def _bytes(phrases: DataFrame, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The bytes of a filter that aren't 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 1 << 16):
            langs, texts = batch.column(0).to_pylist(), [x.encode() for x in batch.column(1).to_pylist()]
            at = np.unique(phrase_hashes(langs, texts) & np.uint64(bits - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 3), pa.array(1 << (at & 7))], ["at", "flag"])

    # bytes in groups of 65,536, so that few rows reach the driver
    each = phrases.select("lang", "phrase").mapInArrow(run, "at long, flag long").groupBy("at").agg(F.bit_or("flag").alias("flag"))
    packed = each.groupBy(F.floor(F.col("at") / 65536).alias("part")).agg(F.collect_list(F.struct("at", "flag")).alias("x"))
    for row in packed.select(F.col("x.at").alias("at"), F.col("x.flag").alias("flag")).toLocalIterator():
        yield np.array(row["at"], np.int64), np.array(row["flag"], np.uint8)


def _counted(batches: Iterator[pa.RecordBatch], longest: int, now: Known | None, before: Known | None) -> Iterator[pa.RecordBatch]:
    """(lang, words, phrase, n) of all words, if before is None, and of phrases whose parts are known now but not before.

    Without now all phrases count. batches: (lang, text). Each group of words is counted by itself.
    """
    ids: dict[str, _Ids] = {}
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def add(lang: str, texts: list[bytes]) -> int:
        tokens = b" . ".join(texts).lower().translate(_ENDS).replace(END, b" . ").split()
        known = ids.setdefault(lang, _Ids({END: 0}))
        tokens.append(END)
        held.setdefault(lang, []).append(np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens)))
        return len(tokens)

    def done() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            yield from _phrases(lang, list(ids[lang]), np.concatenate(parts), longest, now, before)

    for batch in small(batches, 4096):
        waiting: dict[str, list[bytes]] = {}
        held_bytes: dict[str, int] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py()
            if not text:
                continue
            raw = text.encode()
            waiting.setdefault(lang, []).append(raw)
            held_bytes[lang] = held_bytes.get(lang, 0) + len(raw)
            if held_bytes[lang] >= GROUP_BYTES:
                size += add(lang, waiting.pop(lang))
                held_bytes[lang] = 0
        for lang, texts in waiting.items():
            size += add(lang, texts)
        if size >= GROUP_WORDS:
            yield from done()
            ids, held, size = {}, {}, 0
    yield from done()


def _phrases(lang: str, words: list[bytes], text: np.ndarray, longest: int, now: Known | None, before: Known | None) -> Iterator[pa.RecordBatch]:
    spelled = pa.array(words, pa.binary()).cast(pa.string())

    def rows(length: int, starts: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(starts), OUT_ROWS):
            at, own = starts[k : k + OUT_ROWS], n[k : k + OUT_ROWS]
            parts = [pc.take(spelled, pa.array(text[at + j])) for j in range(length)]
            phrase = pc.binary_join_element_wise(*parts, " ") if length > 1 else parts[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(np.full(len(at), length, np.int32)), phrase, pa.array(own.astype(np.int64))], ["lang", "words", "phrase", "n"])

    hashed = word_hash(lang, words)[text]
    on = text > 0
    if before is None:
        total = np.bincount(text, minlength=len(words))
        first = np.zeros(len(words), np.int64)
        first[text[::-1]] = np.arange(len(text) - 1, -1, -1)
        found = np.flatnonzero(total[1:]) + 1
        yield from rows(1, first[found], total[found])
    # at each place: whether a phrase of the length so far begins there, and its hash
    hashes = hashed
    for length in range(2, longest + 1):
        end = len(text) - length + 1
        if end <= 0:
            return
        last, on = on, on[:end] & (text[length - 1 :] > 0)
        wanted = on
        for known, meant in ((now, True), (before, False)):
            if known is not None:
                parts = np.zeros(end + 1, bool)
                at = np.flatnonzero(last)
                parts[at] = known.has(length - 1, hashes[at])
                both = parts[:-1] & parts[1:]
                wanted = wanted & (both if meant else ~both)
        at = np.flatnonzero(wanted)
        if len(at):
            # equal phrases have equal numbers of all but the last word, and an equal last word
            number = text[at].astype(np.int64)
            for k in range(1, length):
                keys = (number << 32) | text[at + k]
                if k < length - 1:
                    number = np.unique(keys, return_inverse=True)[1]
            order = np.argsort(keys, kind="stable")
            edges = np.flatnonzero(np.concatenate(([True], np.diff(keys[order]) != 0)))
            yield from rows(length, at[order[edges]], np.diff(np.append(edges, len(order))))
        if length < longest:
            hashes = extended(hashes[:end], hashed[length - 1 :])


def phrase_counts(docs: DataFrame, longest: int, now: Known | None = None, before: Known | None = None, least: int = 1) -> DataFrame:
    """(lang, words, phrase, n) of docs (lang, text): see _counted; of those that occur `least` times, and single words."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((now, before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted(batches, longest, *shared.value)

    # a task's groups have combined what can be: most phrases are rare, and a hash table before the shuffle would only spill
    dealt = docs.mapInArrow(run, "lang string, words int, phrase string, n long").repartition("lang", "words", "phrase")
    counted = dealt.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return counted.filter((F.col("n") >= least) | (F.col("words") == 1))


def frequent_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", longest: int = 3, least: int = 10, share: float = SHARE) -> tuple[DataFrame, DataFrame]:
    """(phrases, sizes): (lang, words, phrase, n) of all phrases of at most `longest` words that occur `least` times, and (lang, n) in words."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(lang_col, F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    chosen = F.pmod(F.xxhash64("id", F.lit(13)), F.lit(1 << 20)) < round(share * (1 << 20))
    texts, sample = rows.select("lang", "text"), rows.filter(chosen).select("lang", "text")
    proposed = phrase_counts(sample, longest - 1).filter(F.col("n") >= max(1, int(LOWERED * share * least)))
    proposed = written(proposed.select("lang", "words", "phrase"), "proposed")
    before, now = None, Known.of(proposed, longest - 1)
    removed(proposed)
    found = sizes = None
    while True:
        counted = written(phrase_counts(texts, longest, now, before, least), "counted")
        own = counted.filter(F.col("n") >= least)
        if sizes is None:
            sizes = counted.filter("words = 1").groupBy("lang").agg(F.sum("n").alias("n"))
        found = own if found is None else found.union(own)
        failures = written(_unknown(own.filter(F.col("words") < longest), now), "failures")
        if failures.isEmpty():
            return found, sizes
        before, now = now, now.with_more(failures)


def _unknown(phrases: DataFrame, known: Known) -> DataFrame:
    """Those of a table (lang, words, phrase, n) that aren't known."""
    shared = phrases.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 1 << 16):
            hashes = phrase_hashes(batch.column(0).to_pylist(), [x.encode() for x in batch.column(2).to_pylist()])
            lengths, on = batch.column(1).to_numpy(), np.zeros(batch.num_rows, bool)
            for k in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == k)
                on[at] = ~shared.value.has(k, hashes[at])
            yield batch.filter(pa.array(on))

    return phrases.mapInArrow(run, phrases.schema)


def scored(phrases: DataFrame, sizes: DataFrame, longest: int = 3) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of the phrases of 2 words or more, with their lowest-scoring cut.

    phrases: as frequent_phrases gives them. Every part of one is in it too.
    """
    long, found = phrases.filter("words > 1").withColumnRenamed("n", "a"), None
    part = lambda name: phrases.select("lang", F.col("phrase").alias(f"{name}_phrase"), F.col("n").alias(name))
    words = F.split("phrase", " ")
    for k in range(1, longest):
        cut = long.filter(F.col("words") > k).select(
            "*", F.lit(k).alias("k"), F.array_join(F.slice(words, 1, k), " ").alias("l_phrase"), F.array_join(F.slice(words, k + 1, F.col("words") - k), " ").alias("r_phrase")
        )
        found = cut if found is None else found.union(cut)
    found = found.join(part("l"), ["lang", "l_phrase"]).join(part("r"), ["lang", "r_phrase"])
    exact = lambda c: F.col(c).cast("decimal(15,0)")
    found = found.withColumns({"over": exact("a") * exact("a") * F.lit(1_000_000).cast("decimal(7,0)"), "under": exact("l") * exact("r")})
    cuts = found.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(F.expr("over div under").alias("score"), "k", "l", "r")).alias("cut"))
    return cuts.join(sizes, "lang").select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")


def maximal(phrases: DataFrame, share: int = 50, longest: int = 3) -> DataFrame:
    """The rows of phrases (lang, phrase, words, a) but for those inside a longer one that has this percentage of their count."""
    inside, words = None, F.split("phrase", " ")
    for length in range(2, longest):
        longer = phrases.filter(F.col("words") > length)
        at = F.sequence(F.lit(1), F.col("words") - length + 1)
        each = longer.select("lang", F.explode(at).alias("at"), words.alias("all"), F.col("a").alias("of")).select("lang", F.array_join(F.slice("all", F.col("at"), F.lit(length)), " ").alias("phrase"), "of")
        inside = each if inside is None else inside.union(each)
    if inside is None:
        return phrases
    most = inside.groupBy("lang", "phrase").agg(F.max("of").alias("of"))
    held = phrases.join(most, ["lang", "phrase"], "left")
    return held.filter(F.col("of").isNull() | (100 * F.col("of") < share * F.col("a"))).select(*phrases.columns)


def top_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", longest: int = 3, least: int = 10, most: int = 2000, share: float = SHARE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases by score, count and phrase."""
    phrases, sizes = frequent_phrases(docs, id_col, text_col, lang_col, longest, least, share)
    best = maximal(scored(phrases, sizes, longest), 50, longest)
    # the first of each part of a language, then of the language: no task sorts more than PARTS times `most` of them
    for keys in ([F.col("lang"), F.pmod(F.xxhash64("phrase"), F.lit(PARTS))], [F.col("lang")]):
        order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
        best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    ranked = best
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
