"""Sentences of the reports: fixed values, once for the operators and for the SQL that they are held against."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

FORK_AHEAD = "ACTION REQUIRED — {n} child(ren) already migrated but this source dataset is not. Child data models are sitting on an unmigrated source."
FORK_FIRST = "HIGH PRIORITY — migrate this dataset first. It blocks {n} downstream dataset(s)."
FORK_GOING = "IN PROGRESS — this fork point is migrated. {n} child(ren) still pending."
FORK_DONE = "COMPLETE — this fork point and all its children are migrated."
MERGE_AHEAD = "ACTION REQUIRED — this dataset is migrated but {n} parent(s) are not. Data model is sourcing from unmigrated datasets."
MERGE_BLOCKED = "BLOCKED — {n} of {total} parent(s) not yet migrated. Migrate parents first."
MERGE_READY = "READY — all {total} parent(s) are migrated. This dataset can be migrated now."
MERGE_DONE = "COMPLETE — all parents and this dataset are migrated."
UNCLEAR = "REVIEW — migration not required or status unknown."
STANDALONE = "STANDALONE — no parents or children"
LEAF = "LEAF — end of a dependency chain"
TERMINAL_DONE = "DONE — migrated, no dependants"
TERMINAL_EASY = "EASY WIN — not migrated, no dependants"
TERMINAL_ORPHANED = "ORPHANED — not-required, no dependants"
UNBLOCKS = "Migrate this dataset to unblock {n} downstream dataset(s)."
BLOCKED_BY = "BLOCKED by {n} parent(s)"
WAITING = "WAITING — resolve {n} upstream blockers first"
HIGH = "HIGH — migrating this unblocks {n} dataset(s)"
LOW = "LOW — ready to migrate, no downstream impact"
TIERS = ((75, "TIER 1 — Strong candidate (quarantine now)"), (50, "TIER 2 — Likely candidate (review with owner)"), (25, "TIER 3 — Monitor (check in 90 days)"), (0, "TIER 4 — Keep (active or protected)"))


def _parts(sentence: str) -> list[tuple[str, bool]]:
    """Its texts and, marked, the names of its gaps."""
    return [(x, k % 2 == 1) for k, x in enumerate(re.split(r"\{(\w+)\}", sentence)) if x]


def told(sentence: str, **gaps: Column) -> Column:
    """The sentence as a column, its gaps filled."""
    return F.concat(*(gaps[x].cast("string") if gap else F.lit(x) for x, gap in _parts(sentence)))


def told_sql(sentence: str, **gaps: str) -> str:
    return " || ".join(gaps[x] if gap else f"'{x}'" for x, gap in _parts(sentence))
