"""URL filters: all glob rules at once, by a bit-parallel automaton.

A canonical URL is "." + host + path (host in lower case, no scheme, query or fragment), so that a host
and its subdomains both end in "." + host. A glob is literal but for `?` (one character but `/`), `*` (any
run without `/`) and `**` (any run). Its states, one bit each, say how many of its literals are matched;
a wildcard is a loop on the state before it. The states of all globs stand side by side in 64-bit words.
Reading one byte moves every state of every glob at once:

    states = (states << 1 across words) & takes[byte]  |  states & loops[byte]

and a batch of URLs is read position by position with one such step for all of them.

Null URLs and URLs without `://` have an empty host and path, which only globs that match "." can hit; they
are allowed by default. Repeated rows get equal verdicts; an empty table gives an empty one. Globs see
UTF-8 bytes, so `?` takes one byte. URLs of any length are read whole, the long ones of a batch beyond the others' ends.
All is functions of one column, so a table's other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: URLs that are read side by side.
LANES = 4096


@dataclass(frozen=True)
class Rule:
    """A glob with the verdict it gives. Of the rules that match, the highest rank wins, then the first."""

    glob: str
    verdict: str
    rank: int = 0
    name: str | None = None


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """A host with its subdomains, and a path's beginning; the longest such rule wins."""
    return Rule(f"*.{host}{path}**", verdict, 1 + len(host) + len(path), host + path)


class GlobAutomaton:
    def __init__(self, globs: list[str]):
        bits = sum(1 + len(self._parts(g)[0]) for g in globs)
        self.words = max(1, -(-bits // 64))
        takes, loops = np.zeros((256, self.words), np.uint64), np.zeros((256, self.words), np.uint64)
        self.start, self.accept, at = np.zeros(self.words, np.uint64), [], 0
        any_byte = np.arange(256)
        in_segment = any_byte[any_byte != ord("/")]
        for glob in globs:
            literals, stars = self._parts(glob)
            for k in range(len(literals) + 1):
                word, bit = (at + k) // 64, np.uint64(1) << np.uint64((at + k) % 64)
                if k in stars:
                    loops[any_byte if stars[k] == "**" else in_segment, word] |= bit
                if k:
                    takes[in_segment if literals[k - 1] is None else literals[k - 1], word] |= bit
            self.start[at // 64] |= np.uint64(1) << np.uint64(at % 64)
            at += len(literals)
            self.accept.append((at // 64, np.uint64(at % 64)))
            at += 1
        self.takes, self.loops = takes, loops

    @staticmethod
    def _parts(glob: str) -> tuple[list[int | None], dict[int, str]]:
        """Its literals (None: `?`) and the wildcards, by the number of literals before them."""
        literals: list[int | None] = []
        stars: dict[int, str] = {}
        raw, k = glob.encode(), 0
        while k < len(raw):
            if raw[k : k + 1] == b"*":
                double = raw[k : k + 2] == b"**"
                if double or stars.get(len(literals)) != "**":
                    stars[len(literals)] = "**" if double else "*"
                k += 1 + double
            else:
                literals.append(None if raw[k : k + 1] == b"?" else raw[k])
                k += 1
        return literals, stars

    def matches(self, urls: list[bytes]) -> np.ndarray:
        """A row of flags per URL: which globs match all of it."""
        out = np.zeros((len(urls), len(self.accept)), bool)
        order = sorted(range(len(urls)), key=lambda k: -len(urls[k]))
        for a in range(0, len(order), LANES):
            lanes = order[a : a + LANES]
            lengths = np.array([len(urls[k]) for k in lanes])
            text = np.frombuffer(b"".join(urls[k] for k in lanes), np.uint8)
            starts = np.cumsum(lengths) - lengths
            states = np.repeat(self.start[None, :], len(lanes), axis=0)
            for at in range(int(lengths[0])):
                n = int(np.searchsorted(-lengths, -at))  # lanes are sorted, so the first n are longer than at
                byte, now = text[starts[:n] + at], states[:n]
                moved = now << np.uint64(1)
                moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
                states[:n] = (moved & self.takes[byte]) | (now & self.loops[byte])
            for g, (word, bit) in enumerate(self.accept):
                out[lanes, g] = (states[:, word] >> bit & np.uint64(1)).astype(bool)
        return out


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without one."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    return F.concat(F.lit("."), host_of(url), path_of(url))


def judged(rules: list[Rule], default: str = "allow"):
    """A function of a column of canonical URLs to struct(rule, verdict): rule is the winner's name or glob, or null."""
    ranked = sorted(rules, key=lambda r: -r.rank)

    @F.pandas_udf("rule string, verdict string")
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = GlobAutomaton([r.glob for r in ranked])
        names = np.array([r.name or r.glob for r in ranked] + [None], object)
        verdicts = np.array([r.verdict for r in ranked] + [default], object)
        for part in parts:
            hits = automaton.matches([x.encode() for x in part]) if len(part) else np.zeros((0, len(ranked)), bool)
            first = np.where(hits.any(axis=1), hits.argmax(axis=1), len(ranked)) if ranked else np.zeros(len(part), int)
            yield pd.DataFrame({"rule": names[first], "verdict": verdicts[first]})

    return judge
