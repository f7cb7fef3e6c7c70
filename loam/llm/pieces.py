"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

A text gets a dummy prefix and its spaces become U+2581, as the model file says. No piece holds that sign
behind another one, so a text falls into chunks (a run of the sign with what follows, or a control sign that
no longer piece holds) whose best segmentations join to the text's. All new chunks of a group of texts go through the
trie side by side, from every character at once. A place that no piece found crosses cuts a chunk further, so that
texts without spaces fall apart too. Long runs of one sign, which have no such place, are walked until the path repeats. Of each part, all of them side by side, the path of highest summed log scores is
taken; of equal ones that whose last pieces begin first, as in SentencePiece. A character that no piece covers costs
ten less than the lowest score and is written as byte pieces (or as the unknown piece, if the model has none). Results
of chunks of at most KEPT_BYTES are kept in a dictionary of some CACHE_BYTES, which is emptied when full.

Whole texts are encoded. Null texts give null ids and decode to null; empty texts give no ids. Decoding turns
U+2581 into a space, byte pieces into UTF-8 (broken bytes into U+FFFD) and takes the dummy prefix away, so all
texts without U+2581 come back exactly. Repeated rows get equal ids. An empty table gives an empty one. All columns come
back in a struct, so they may have any name. Only identity normalization is supported; a model with another raises
ValueError. Models are read from a path and never trained. The model goes to the tasks within the function: its size is
that of a vocabulary.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
KEPT_BYTES, CACHE_BYTES = 64, 64 << 20
#: A sign that comes so many times in a row, or more, is a run of its own kind.
RUN = 512
_RUN = re.compile(rf"(?s)(.)\1{{{RUN - 1},}}")
#: Bytes of chunks that are segmented side by side, unless one alone is longer.
STEP_BYTES = 1 << 17
#: Characters of texts that are Python objects with their chunks and ids at once, unless one text alone is longer.
GROUP_CHARS = 1 << 19
#: Lists of ids that are texts at once; ids that become bytes at once.
DECODED, STEP_IDS = 128, 1 << 18
#: Pieces that are tried one by one rather than side by side.
FEW = 32
#: Bytes that a cached chunk takes besides its own and its ids'.
OVERHEAD = 240
UNKNOWN_PENALTY = 10.0


class DoubleArray:
    """A trie over bytes in two arrays: from node s, byte c leads to base[s] + c if check there is s."""

    def __init__(self, keys: list[bytes], values: list[int]):
        tree: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for key, value in zip(keys, values, strict=True):
            node = 0
            for c in key:
                if c not in tree[node]:
                    tree[node][c] = len(tree)
                    tree.append({})
                node = tree[node][c]
            ends[node] = value
        size = 2 * len(tree) + 512
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        taken, place, low, wide = bytearray(size), {0: 0}, 256, 256
        taken[0] = 1
        for node, children in enumerate(tree):  # parents come before their children
            s = place[node]
            value[s] = ends.get(node, -1)
            if not children:
                continue
            codes = sorted(children)
            while taken[low]:
                low += 1
            at = first = (low if len(codes) == 1 else wide) - codes[0]
            while any(at + c < len(taken) and taken[at + c] for c in codes):
                at += 1
            if at + 512 > len(taken):
                taken.extend(bytes(size))
                base, check, value = (np.concatenate([x, np.full(size, fill, np.int32)]) for x, fill in ((base, 0), (check, -1), (value, -1)))
            if at - first > 64:  # it is full around here; nodes with several children look further on
                wide = at + codes[0]
            base[s] = at
            for c in codes:
                taken[at + c] = 1
                check[at + c] = s
                place[children[c]] = at + c
        # no slot under 256 is used, so that a leaf, whose base is 0, leads nowhere
        self.base, self.check, self.value = base, check, value
        self.depth = max(map(len, keys), default=0)


@dataclass
class PieceModel:
    pieces: list[str]
    scores: np.ndarray
    kinds: list[int]  # 1 normal, 2 unknown, 3 control, 4 user-defined, 5 unused, 6 byte
    dummy_prefix: bool = True
    escape: bool = True

    @classmethod
    def load(cls, path: str) -> PieceModel:
        """From a SentencePiece model file, whose pieces and scores are used as they are."""
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        n = proto.normalizer_spec
        if n.precompiled_charsmap or n.remove_extra_whitespaces:
            raise ValueError("only identity normalization is supported")
        return cls([p.piece for p in proto.pieces], np.array([p.score for p in proto.pieces], float), [p.type for p in proto.pieces], n.add_dummy_prefix, n.escape_whitespaces)

    def prepared(self) -> Segmenter:
        return Segmenter(self)


class Segmenter:
    def __init__(self, model: PieceModel):
        self.model = model
        normal = [k for k, t in enumerate(model.kinds) if t in (1, 4)]
        self.trie = DoubleArray([model.pieces[k].encode() for k in normal], normal)
        self.lowest = min((model.scores[k] for k in normal if model.kinds[k] == 1), default=0.0) - UNKNOWN_PENALTY
        self.unknown = next((k for k, t in enumerate(model.kinds) if t == 2), 0)
        named = {model.pieces[k]: k for k, t in enumerate(model.kinds) if t == 6}
        self.bytes = [named.get(f"<0x{b:02X}>") for b in range(256)]
        texts = [model.pieces[k] for k in normal]
        long_signs = set("".join(t for t in texts if len(t) > 1))
        alone = "".join(c for c in "\n\r\t" if c not in long_signs)
        cuts = all(SPACE not in t.lstrip(SPACE) for t in texts)
        self.pattern = f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|[{alone}]" if alone else "") if cuts else "(?s:.+)"
        self.chunks = re.compile(self.pattern).findall
        self.known: dict[str, list[int]] = {}
        self.held = 0
        self.byte_ids = np.array([-1 if k is None else k for k in self.bytes], np.int32)

    def __getstate__(self) -> dict:
        """All but the cache and what pickle can't take: a task gets the arrays, not the work of making them."""
        return {k: v for k, v in self.__dict__.items() if k not in ("chunks", "known", "held")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state, chunks=re.compile(state["pattern"]).findall, known={}, held=0)

    def _edges(self, text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of all pieces in the text, and of characters that no piece is (piece -1)."""
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        lead = text[at]
        wide = at + 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
        single = np.zeros(len(text) + 1, bool)  # characters that are pieces, by their end
        found, live, node = [], at, np.zeros(len(at), np.int32)
        end_of = np.zeros(len(text), np.int64)
        end_of[at] = wide
        for depth in range(self.trie.depth):
            to = base[node] + text[live + depth]
            on = check[to] == node
            live, node = live[on], to[on]
            if not len(live):
                break
            got = value[node]
            hit = got >= 0
            start = live[hit]
            found.append((start, start + depth + 1, got[hit]))
            single[start[end_of[start] == start + depth + 1] + depth + 1] = True
        bare = ~single[wide]
        found.append((at[bare], wide[bare], np.full(int(bare.sum()), -1, np.int32)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _from(self, raw: bytes, at: int) -> list[tuple[int, int, float]]:
        """(length, piece, gain) of the pieces at a place, and of its character if that is none (piece -1)."""
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        lead = raw[at]
        wide = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
        node, out = 0, []
        for k in range(at, min(at + self.trie.depth, len(raw))):
            to = int(base[node]) + raw[k]
            if check[to] != node:
                break
            node = to
            if value[node] >= 0:
                out.append((k + 1 - at, int(value[node]), float(self.model.scores[value[node]])))
        return out if any(n == wide for n, _, _ in out) else [*out, (wide, -1, self.lowest)]

    def _with_runs(self, chunk: str) -> list[int]:
        """The ids of a chunk that holds long runs of a sign, place by place; within a run only until its path repeats.

        What follows from a place depends on the text ahead and on how the scores of paths that reach beyond it differ. Once
        those differences are what they were at an earlier place of the run, all choices between the two repeat to its end.
        Where scores have fractions, it may settle for another of several paths that are equal but for rounding.
        """
        raw, depth = chunk.encode(), self.trie.depth
        size = len(raw)
        best, last, named = np.full(size + depth + 1, -np.inf), np.zeros(size + depth + 1, np.int64), np.full(size + depth + 1, -1, np.int64)
        best[0] = 0
        runs, at = [], 0
        for m in _RUN.finditer(chunk):
            a = len(chunk[: m.start()].encode()) if not runs else runs[-1][1] + len(chunk[at : m.start()].encode())
            runs.append((a, a + len(m[0].encode()), len(m[1].encode())))
            at = m.end()
        run, reach, i, same, seen = iter([*runs, (size, size, 1)]), 0, 0, None, {}
        low, high, sign = next(run)
        while i < size:
            if i >= high:
                (low, high, sign), same, seen = next(run), None, {}
            inside = low <= i and i + depth <= high
            if reach <= i:
                best[i] = 0
            if inside:
                ahead = slice(i, i + depth, sign)
                # where the paths come from is a part of it, as of equal ones the first stays
                found = np.isfinite(best[ahead][1:])
                mark = (best[ahead] - best[i]).tobytes() + np.where(found, last[ahead][1:] - i, 0).tobytes() + named[ahead][1:].tobytes() + bytes([reach > i])
                if mark in seen and (period := i - seen[mark]) and (times := (high - depth - i) // period) > 0:
                    gain, far = float(best[i] - best[i - period]) if reach > i else 0.0, i + times * period
                    end = min(depth, size - i)
                    coming = best[i : i + end + 1].copy(), last[i : i + end + 1] - i, named[i : i + end + 1].copy()
                    back = last[i - period + 1 : i + 1] - np.arange(i - period + 1, i + 1)
                    last[i + 1 : far + 1] = np.tile(back, times) + np.arange(i + 1, far + 1)
                    named[i + 1 : far + 1] = np.tile(named[i - period + 1 : i + 1], times)
                    best[far : far + end + 1], last[far + 1 : far + end + 1], named[far + 1 : far + end + 1] = coming[0] + times * gain, coming[1][1:] + far, coming[2][1:]
                    reach, i, seen = reach + far - i, far, {}
                    continue
                if len(seen) == 4 * FEW * depth:  # no path repeats, as scores with fractions are rounded
                    seen = {}
                seen[mark] = i
                same = edges = same or self._from(raw, i)
            else:
                edges = self._from(raw, i)
            for n, piece, gain in edges:
                if best[i] + gain > best[i + n]:
                    best[i + n], last[i + n], named[i + n] = best[i] + gain, i, piece
                reach = max(reach, i + n)
            i += sign if inside else 1
            while i < size and raw[i] & 0xC0 == 0x80:
                i += 1
        ids, at, came, names = [], size, last.tolist(), named.tolist()
        while at:
            if names[at] >= 0:
                ids.append(names[at])
            else:
                spelled = [self.bytes[b] for b in raw[came[at] : at]]
                ids += [self.unknown] if None in spelled else spelled[::-1]
            at = came[at]
        return ids[::-1]

    @staticmethod
    def _one_by_one(start, end, piece, gain, cut, best, last, named) -> None:
        score, came = best.tolist(), {}
        for k, (s, e, g, first) in enumerate(zip(start.tolist(), end.tolist(), gain.tolist(), cut[start].tolist(), strict=True)):
            total = g if first else score[s] + g
            if total > score[e]:
                score[e], came[e] = total, k
        at, k = np.fromiter(came, np.int64, len(came)), np.fromiter(came.values(), np.int64, len(came))
        best[at], last[at], named[at] = np.array(score)[at], start[k], piece[k]

    def _segmented(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk, as the bytes of 32-bit integers. A chunk is its bytes and one more place, its end; 256 is there, a byte no piece has."""
        raws = [c.encode() for c in chunks]
        ends = np.cumsum([len(r) + 1 for r in raws]) - 1
        text = np.frombuffer(b"\xff".join(raws) + b"\xff" * (self.trie.depth + 1), np.uint8).astype(np.int32)
        text[ends] = text[ends[-1] :] = 256
        at = np.flatnonzero(((text & 0xC0) != 0x80) & (text < 256))
        start, end, piece = self._edges(text, at)
        # a place is a cut if no piece from before it ends behind it
        reach = np.arange(ends[-1] + 1)
        np.maximum.at(reach, start, end)
        cut = np.concatenate(([True], np.maximum.accumulate(reach)[:-1] <= np.arange(1, len(reach))))
        cut[1:][text[: len(cut) - 1] == 256] = True  # the start of a chunk
        own = np.maximum.accumulate(np.where(cut, np.arange(len(cut)), 0))
        gain = np.where(piece >= 0, self.model.scores[piece], self.lowest)
        order = np.argsort(start - own[start], kind="stable")
        start, end, piece, gain = start[order], end[order], piece[order], gain[order]
        steps = np.flatnonzero(np.diff(start - own[start])) + 1
        # best score of a path to a place from the cut before it, and where its last piece begins
        best, last, named = np.full(len(cut), -np.inf), np.zeros(len(cut), np.int64), np.full(len(cut), -1, np.int32)
        for a, b in zip([0, *steps.tolist()], [*steps.tolist(), len(start)], strict=True):
            if b - a < FEW and len(start) - a > 512 * FEW:  # a few very long parts are left
                self._one_by_one(start[a:], end[a:], piece[a:], gain[a:], cut, best, last, named)
                break
            s, e = start[a:b], end[a:b]
            total = np.where(cut[s], 0.0, best[s]) + gain[a:b]
            up = total > best[e]
            e = e[up]
            best[e], last[e], named[e] = total[up], s[up], piece[a:b][up]
        path = np.flatnonzero(cut & np.isfinite(best))
        on = np.zeros(len(cut), bool)
        while len(path):
            on[path] = True
            path = last[path]
            path = path[~cut[path]]
        token = np.flatnonzero(on)
        begin, kind = last[token], named[token]
        width = token - begin
        spelled = kind < 0  # by its bytes, if the model has pieces for all of them
        for k in range(4):
            spelled &= (k >= width) | (self.byte_ids[text[np.minimum(begin + k, token - 1)] & 0xFF] >= 0)
        count = np.where(spelled, width, 1)
        ids = np.repeat(np.where(kind >= 0, kind, self.unknown), count)
        first = np.cumsum(count) - count
        for k in range(4):
            some = spelled & (width > k)
            ids[first[some] + k] = self.byte_ids[text[begin[some] + k]]
        upto = (4 * np.concatenate(([0], np.cumsum(count)))[np.searchsorted(token, ends, side="right")]).tolist()
        ids = ids.astype(np.int32).tobytes()
        return [ids[a:b] for a, b in zip([0, *upto[:-1]], upto, strict=True)]

    def encode(self, texts: Iterable[str | None]) -> list[list[int] | None]:
        return [None if ids is None else np.frombuffer(ids, np.int32).tolist() for group in self.groups(texts) for ids in group]

    def groups(self, texts: Iterable[str | None]) -> Iterator[list[bytes | None]]:
        """The ids of the texts, as the bytes of 32-bit integers, some GROUP_CHARS of the texts at a time."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text or "")
            if size >= GROUP_CHARS:
                yield self._encoded(held)
                held, size = [], 0
        if held:
            yield self._encoded(held)

    def _encoded(self, texts: list[str | None]) -> list[bytes | None]:
        split = [None if t is None else self._chunks(t) for t in texts]
        if self.held > CACHE_BYTES:
            self.known, self.held = {}, 0
        known, new, size, once = self.known, [], 0, {}
        for chunk in dict.fromkeys(chain.from_iterable(s for s in split if s)):
            if chunk in known:
                continue
            if len(chunk) >= RUN and _RUN.search(chunk):
                once[chunk] = np.array(self._with_runs(chunk), np.int32).tobytes()
                continue
            new.append(chunk)
            size += len(chunk)
            if size >= STEP_BYTES:
                once.update(zip(new, self._segmented(new), strict=True))
                new, size = [], 0
        if new:
            once.update(zip(new, self._segmented(new), strict=True))
        known.update(once)
        out = [None if s is None else b"".join(map(known.__getitem__, s)) for s in split]
        for chunk, ids in once.items():
            if len(chunk) > KEPT_BYTES:
                del known[chunk]
            else:
                self.held += OVERHEAD + len(chunk) + len(ids)
        return out

    def _chunks(self, text: str) -> list[str]:
        if not text:
            return []
        text = " " + text if self.model.dummy_prefix else text
        return self.chunks(text.replace(" ", SPACE) if self.model.escape else text)

    def decode(self, ids: Iterable[int]) -> str:
        return Decoder.of(self.model).decode(ids)


@dataclass
class Decoder:
    text: np.ndarray  # of all pieces, as bytes
    begin: np.ndarray
    size: np.ndarray
    dummy_prefix: bool

    @classmethod
    def of(cls, model: PieceModel) -> Decoder:
        kinds = zip(model.pieces, model.kinds, strict=True)
        plain = [b"" if t == 3 else bytes([int(p[3:5], 16)]) if t == 6 else " ⁇ ".encode() if t == 2 else p.replace(SPACE, " ").encode() for p, t in kinds]
        size = np.array([len(p) for p in plain], np.int64)
        return cls(np.frombuffer(b"".join(plain), np.uint8), np.cumsum(size) - size, size, model.dummy_prefix)

    def decode(self, ids: list[int]) -> str:
        return next(self.decoded(np.asarray(ids, np.int64), np.array([0, len(ids)])))

    def decoded(self, ids: np.ndarray, offsets: np.ndarray) -> Iterator[str]:
        """The texts of lists of ids, one after the other in ids. offsets: where they begin, and the last one's end."""
        raw, ends = [], [np.zeros(1, np.int64)]
        for at in range(0, len(ids), STEP_IDS):
            some = ids[at : at + STEP_IDS]
            size = self.size[some]
            end = np.cumsum(size)
            raw.append(self.text[np.repeat(self.begin[some] - (end - size), size) + np.arange(end[-1])].tobytes())
            ends.append(end + ends[-1][-1])
        whole, cuts = b"".join(raw), np.concatenate(ends)[offsets].tolist()
        for a, b in zip(cuts, cuts[1:], strict=False):
            text = whole[a:b].decode(errors="replace")
            yield text.removeprefix(" ") if self.dummy_prefix else text


def encoder(model: PieceModel):
    """A function of a column of texts to ids. Arrow brings a task the texts alone; it hands on a bounded group at a time."""
    segmenter = model.prepared()

    @F.arrow_udf("array<int>")
    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            for ids in segmenter.groups(x.as_py() for x in part):
                flat = np.frombuffer(b"".join(x for x in ids if x), np.int32)
                offsets = np.cumsum([0, *(len(x or b"") // 4 for x in ids)]).astype(np.int32)
                yield pa.ListArray.from_arrays(pa.array(offsets, mask=np.array([*(x is None for x in ids), False])), pa.array(flat))

    return encode


def encoded(docs: DataFrame, model: PieceModel, text_col: str = "text") -> DataFrame:
    """(row, ids): each row of docs as a struct with the ids of its text, a string column."""
    rows = docs.select(F.struct("*").alias("row"))
    return rows.select("row", encoder(model)(F.col("row").getField(text_col)).alias("ids"))


def decoder(model: PieceModel):
    """A function of a column of ids to text."""
    plain = Decoder.of(model)

    @F.arrow_udf("string")
    def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            for at in range(0, max(1, len(part)), DECODED):
                some = part.slice(at, DECODED)
                # null lists are empty in what is flattened
                texts = plain.decoded(some.flatten().to_numpy(), np.concatenate(([0], np.cumsum(some.value_lengths().fill_null(0).to_numpy()))))
                yield pa.array([text if valid else None for text, valid in zip(texts, some.is_valid().to_pylist(), strict=True)], pa.string())

    return decode
