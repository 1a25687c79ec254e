"""Which folders hold the folded rows of a store, and which of them a compaction merges.

A compaction folds the pending deltas into a run of level 1. When a level holds `fan_out` runs, they are
merged into one run of the next level, so a row is rewritten once a level and not at every compaction.
A run lies in one folder per tier and span. A span is a bucket, `all` for the tier without
buckets, or what lies before or after the buckets that get folders of their own, so that odd dates of clients
cannot make folders without end. A merge rewrites the spans that several of its runs hold and takes over the
others as they are; a bucket that is too old is dropped by leaving its folder out.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import asdict, dataclass, replace
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewrank.clock import Clock, day_text, hour_text

FAN_OUT = 4
ALL, EARLIER, LATER = "all", "earlier", "later"
# Months that get a folder each.
OWN_YEARS = 10


@dataclass(frozen=True, order=True)
class Part:
    """Folder of one tier and span with the counts of batches `first` to `last`, one row per key."""

    level: int
    first: int
    last: int
    tier: str
    span: str
    run: str

    @property
    def folder(self) -> str:
        return f"run={self.run}/tier={self.tier}/span={self.span}"


def _own_buckets(tier: str, clock: Clock) -> tuple[str, str]:
    """First and last bucket with a folder of its own."""
    tomorrow = clock.hour_start + timedelta(days=1)
    if tier == "hour":
        return clock.keep_hours_from, hour_text(tomorrow)
    if tier == "day":
        return clock.keep_days_from, day_text(tomorrow)
    this_year = clock.as_of.year
    return f"{max(this_year - OWN_YEARS, 0):04d}-01", f"{min(this_year + 1, 9999):04d}-01"


def span_of(tier: str, bucket: Column, clock: Clock) -> Column:
    if tier == "all_time":
        return F.lit(ALL)
    first, last = _own_buckets(tier, clock)
    return F.when(bucket < first, EARLIER).when(bucket > last, LATER).otherwise(bucket)


def keeps_from(clock: Clock) -> dict[str, str]:
    """First bucket that retention keeps, of the tiers that it trims."""
    return {"hour": clock.keep_hours_from, "day": clock.keep_days_from}


def retained(parts: Iterable[Part], clock: Clock) -> list[Part]:
    """Parts without the buckets that are too old. `later` may hold some of both and stays."""
    keep = keeps_from(clock)
    return [p for p in parts if p.tier not in keep or p.span == LATER or p.span >= keep[p.tier]]


def within(parts: Iterable[Part], tier: str, low: str = "", high: str | None = None) -> list[Part]:
    """Parts of a tier that can hold buckets from `low` up to, and without, `high`."""
    own = [p for p in parts if p.tier == tier]
    return [
        p for p in own if p.span in (ALL, EARLIER, LATER) or (p.span >= low and (high is None or p.span < high))
    ]


def full_levels(parts: Iterable[Part], fan_out: int = FAN_OUT) -> int:
    """Level up to which runs are merged: each is full, counting what the one below hands up. 0: none."""
    runs = defaultdict(set)
    for part in parts:
        runs[part.level].add((part.first, part.last))
    top = 0
    while len(runs[top + 1]) + (top > 0) >= fan_out:
        top += 1
    return top


def split_for_merge(parts: Iterable[Part], top: int) -> tuple[list[Part], list[Part], tuple[int, int]]:
    """Parts that stay (those taken over into level `top` + 1 among them), parts to rewrite for it, its batches."""
    taken = [p for p in parts if p.level <= top]
    first, last = min(p.first for p in taken), max(p.last for p in taken)
    held = defaultdict(list)
    for part in taken:
        held[part.tier, part.span].append(part)
    alone = [replace(own[0], level=top + 1, first=first, last=last) for own in held.values() if len(own) == 1]
    rewrite = [p for own in held.values() if len(own) > 1 for p in own]
    return [p for p in parts if p.level > top] + alone, rewrite, (first, last)


def as_text(parts: Iterable[Part], told: dict, keeps_from: dict[str, str]) -> str:
    """A list of parts, with what was counted while they were written and the first buckets that retention kept."""
    return json.dumps({"parts": [asdict(p) for p in sorted(parts)], "told": told, "keeps_from": keeps_from})


def from_text(text: str) -> tuple[list[Part], dict, dict[str, str]]:
    listed = json.loads(text)
    return [Part(**fields) for fields in listed["parts"]], listed["told"], listed["keeps_from"]
