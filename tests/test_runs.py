"""Levels of runs, bucket folders that stay, and the first rows of their sums."""

from __future__ import annotations

import os
import random
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import rows
from viewrank.clock import Clock
from viewrank.operators import ranking, summaries
from viewrank.operators.counting import count_by_hour
from viewrank.plans.snapshot import rank_slots, refresh_snapshot, slots_from_tiers
from viewrank.schema import TIER_SCHEMA
from viewrank.session import new_work_folder
from viewrank.sources.runs import Part, as_text, from_text, full_levels, retained, split_for_merge, within
from viewrank.sources.store import TierStore

NOW = Clock(datetime(2024, 1, 30, 12, 45))


def part(level, first, last, tier="all_time", span="all", run=None):
    return Part(level, first, last, tier, span, run or f"{last}-{level}{first}")


def test_a_level_is_merged_when_it_is_full():
    assert full_levels([], 2) == 0
    assert full_levels([part(1, 0, 0)], 2) == 0
    assert full_levels([part(1, 0, 0), part(1, 1, 1)], 2) == 1
    # What level 1 hands up fills level 2; level 3 stays as it is.
    parts = [part(3, 0, 7), part(3, 8, 15), part(2, 16, 17), part(1, 18, 18), part(1, 19, 19)]
    assert full_levels(parts, 4) == 0 and full_levels(parts, 3) == 0
    assert full_levels(parts[2:], 2) == 2
    assert full_levels(parts, 2) == 3


@settings(max_examples=30, deadline=None)
@given(st.integers(2, 5), st.integers(1, 60))
def test_levels_grow_with_the_logarithm_and_cover_all_batches(fan_out, batches):
    parts, rewritten = [], Counter()
    for batch in range(batches):
        parts.append(part(1, batch, batch, run=str(batch)))
        top = full_levels(parts, fan_out)
        if top:
            stay, rewrite, covered = split_for_merge(parts, top)
            for own in rewrite:
                rewritten.update(range(own.first, own.last + 1))
            parts = [*stay, part(top + 1, *covered, run=f"{batch}-m")]
        assert sorted(b for p in parts for b in range(p.first, p.last + 1)) == list(range(batch + 1))
        levels = Counter(p.level for p in parts)
        assert all(n < fan_out for n in levels.values())
        assert max(levels) <= 1 + sum(fan_out**k <= batch + 1 for k in range(1, 7))
    assert all(times <= 6 for times in rewritten.values())


def test_spans_of_one_run_are_taken_over():
    parts = [
        part(1, 0, 1, "day", "2024-01-28", "1-a"), part(1, 0, 1, "day", "2024-01-29", "1-a"),
        part(1, 2, 2, "day", "2024-01-29", "2-b"), part(2, -9, -1, "day", "2024-01-29", "0-c"),
    ]
    stay, rewrite, covered = split_for_merge(parts, 1)
    assert covered == (0, 2) and rewrite == [parts[1], parts[2]]
    assert stay == [parts[3], part(2, 0, 2, "day", "2024-01-28", "1-a")]
    assert from_text(as_text(parts, {"views": 3}, {"day": "x"})) == (sorted(parts), {"views": 3}, {"day": "x"})


def test_folders_outside_of_what_is_asked_are_left_out():
    spans = ["2023-12-29", "2023-12-30", "2024-01-29", "2024-01-30", "later"]
    days = [part(1, 0, 0, "day", span) for span in spans]
    assert [p.span for p in retained(days, NOW)] == spans[1:]
    assert [p.span for p in within(days, "day", "2023-12-31", "2024-01-30")] == ["2024-01-29", "later"]
    months = [part(1, 0, 0, "month", span) for span in ("earlier", "2023-11", "2024-01")]
    assert retained(months, NOW) == months and within(months, "day") == []


ARRIVALS = [
    [("vid_1", "2024-01-10 09:00", 2), ("vid_2", "2023-12-31 10:00"), ("vid_3", "1999-05-05 10:00")],
    [("vid_1", "2024-01-28 09:00"), ("vid_2", "2024-01-29 13:00", 3), ("vid_4", "2025-06-01 10:00")],
    [("vid_2", "2024-01-30 10:00", 2), ("vid_5", "2024-01-30 12:30")],
    [("vid_1", "2024-01-30 12:40", 4), ("vid_6", "2023-11-30 12:30")],
    [("vid_7", "2024-01-30 12:41", 9), ("vid_1", "2024-01-28 10:00")],
]


@pytest.fixture
def store(spark):
    return TierStore(spark, new_work_folder(spark, "runs"))


def data_files(store, pattern):
    return {f: os.stat(f).st_mtime_ns for f in map(str, Path(store.root).glob(pattern)) if f.endswith(".parquet")}


def compacted(store, views_of, arrivals, fan_out=2, start=0):
    for batch_id, arrival in enumerate(arrivals, start):
        store.write_delta(batch_id, count_by_hour(views_of(arrival)))
        store.compact(NOW, fan_out=fan_out)


def parts_of(store):
    return store._listing()[0].parts


def test_a_compaction_reads_no_run_of_a_level_that_is_not_full(store, views_of):
    compacted(store, views_of, ARRIVALS[:2])
    high = [p for p in parts_of(store) if p.level == 2]
    assert {(p.first, p.last) for p in high} == {(0, 1)}
    contents = {f: Path(f).read_bytes() for p in high for f in data_files(store, f"runs/{p.folder}/*")}
    for file in contents:
        Path(file).write_bytes(b"not to be read")
    compacted(store, views_of, ARRIVALS[2:3], start=2)
    assert [p for p in parts_of(store) if p.level == 2] == high
    for file, content in contents.items():
        Path(file).write_bytes(content)
    compacted(store, views_of, ARRIVALS[3:4], start=3)  # fills levels 1 and 2
    assert {(p.level, p.first, p.last) for p in parts_of(store)} == {(3, 0, 3)}
    whole = TierStore(store.spark, new_work_folder(store.spark, "whole"))
    whole.write_delta(0, count_by_hour(views_of([v for a in ARRIVALS[:4] for v in a])))
    whole.compact(NOW)
    for tier in TIER_SCHEMA:
        assert rows(store.tier(tier)) == rows(whole.tier(tier))


def test_buckets_that_no_delta_names_keep_their_files(store, views_of):
    compacted(store, views_of, ARRIVALS[:2])
    old = ["runs/run=*/tier=day/span=2024-01-10/*", "runs/run=*/tier=month/span=2023-12/*"]
    before = {pattern: data_files(store, pattern) for pattern in old}
    assert all(len(files) == 1 for files in before.values())
    compacted(store, views_of, ARRIVALS[2:4], start=2)
    store.clean_up()
    assert {pattern: data_files(store, pattern) for pattern in old} == before
    assert ("vid_1", "2024-01-10", 2) in rows(store.tier("day")) and ("vid_2", "2023-12", 1) in rows(store.tier("month"))
    # A month later the old days are left out; the month stays where it is.
    later = Clock(NOW.as_of + timedelta(days=31))
    store.write_delta(9, count_by_hour(views_of([("vid_8", "2024-03-01 12:00")])))
    store.compact(later, fan_out=9)
    assert {p.span for p in within(parts_of(store), "day")} == {"2024-01-30", "2024-03-01", "later"}
    store.write_delta(10, count_by_hour(views_of([])))
    store.compact(later, fan_out=9)
    store.clean_up()
    assert data_files(store, old[0]) == {} and data_files(store, old[1]) == before[old[1]]
    assert all(row.day_bucket >= later.keep_days_from for row in store.tier("day").collect())


def test_a_folder_holds_few_files_whatever_the_number_of_tasks(spark, store, views_of):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        many = [(f"vid_{i}", f"2024-01-{29 + i % 2} {i % 12:02d}:00") for i in range(400)]
        compacted(store, views_of, [many])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(parts_of(store)) == 10
    assert all(len(data_files(store, f"runs/{part.folder}/*")) == 1 for part in parts_of(store))


def test_odd_dates_share_a_folder(store, views_of):
    compacted(store, views_of, ARRIVALS[:2])
    spans = {(p.tier, p.span) for p in parts_of(store)}
    assert {("month", "earlier"), ("month", "later"), ("day", "later"), ("hour", "later")} <= spans
    assert ("vid_3", "1999-05", 1) in rows(store.tier("month")) and ("vid_4", "2025-06-01", 1) in rows(store.tier("day"))
    # What was in the future may become too old without its folder being rewritten.
    store.write_delta(5, count_by_hour(views_of([])))
    store.compact(Clock(datetime(2025, 9, 1)), fan_out=9)
    assert rows(store.tier("day")) == [] and rows(store.tier("hour")) == []


@pytest.mark.parametrize("compactions", [0, 3, 5])
def test_answers_from_runs_and_deltas_equal_all_sums(store, views_of, compactions):
    for batch_id, arrival in enumerate(ARRIVALS):
        store.write_delta(batch_id, count_by_hour(views_of(arrival)))
        if batch_id < compactions:
            store.compact(NOW, fan_out=3)
    refresh_snapshot(store, NOW)
    expected = rank_slots(slots_from_tiers(store.tiers(), NOW))
    assert rows(store.snapshot().select(*expected.columns)) == rows(expected)


COUNTS = st.dictionaries(st.sampled_from("abcdefghijklmnop"), st.integers(1, 6), max_size=12)


@settings(max_examples=8, deadline=None)
@given(st.lists(COUNTS, max_size=3), st.integers(1, 5), st.booleans())
def test_first_rows_of_sums_equal_brute_force(spark, counted, k, small):
    """Ties, relations with fewer than k rows, lists of k known rows only, with and without a broadcast."""
    runs = [spark.createDataFrame(list(c.items()), TIER_SCHEMA["all_time"]) for c in counted]
    known = [sorted(c.items(), key=lambda row: (-row[1], row[0]))[:k] for c in counted]
    lists = spark.createDataFrame([row for own in known for row in own], TIER_SCHEMA["all_time"])
    total = sum((Counter(c) for c in counted), Counter())
    expected = sorted(total.items(), key=lambda row: (-row[1], row[0]))[:k]
    limit, ranking.BROADCAST_BYTES = ranking.BROADCAST_BYTES, ranking.BROADCAST_BYTES if small else -1
    try:
        with ranking.top_k_of_runs(ranking.CountedRuns(runs, lists), k) as best:
            got = [tuple(row) for row in best.orderBy("rank").collect()]
    finally:
        ranking.BROADCAST_BYTES = limit
    assert got == [(n, *row) for n, row in enumerate(expected, 1)]


def test_all_time_counts_are_not_shuffled_whole(spark, store, views_of):
    many = [(f"vid_{i}", "2024-01-29 10:00", 1) for i in range(300)]
    compacted(store, views_of, [many + ARRIVALS[0] * 9, ARRIVALS[1] * 9, ARRIVALS[2]], fan_out=9)
    runs = store.recent(NOW).all_time
    with ranking.top_k_of_runs(runs, 2) as best:
        assert rows(best) == [(1, "vid_2", 39), (2, "vid_1", 28)]
        plan = best._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    # Rows meet the candidates before the only shuffle of counts.
    semi, shuffle = final.index("LeftSemi"), final.index("Exchange hashpartitioning(video_id")
    assert shuffle < semi and "SortMergeJoin" not in final
    assert final.count("GreaterThanOrEqual(count,") >= 1


@pytest.mark.parametrize(("tracked", "spread"), [(64, 5), (64, 4000), (4000, 4000)])
def test_a_merged_summary_bounds_every_count(spark, tracked, spread):
    """Few ids, many ids of about the same count, and many with room for all of them."""
    rng = random.Random(8)
    views = [(f"vid_{int(rng.paretovariate(0.6)) % spread}",) for _ in range(6000)]
    parts = [spark.createDataFrame(views[n::3], "video_id STRING") for n in range(3)]
    states = [summaries.summarize(part, tracked) for part in parts]
    true = Counter(v for (v,) in views)
    with summaries.merged(states[0].unionByName(states[1]).unionByName(states[2])) as listed:
        estimates = {row.video_id: row.estimate for row in listed.ids.collect()}
        assert all(estimates[v] >= true[v] for v in estimates)
        assert all(n <= listed.unlisted for v, n in true.items() if v not in estimates)
        assert len(estimates) <= tracked


@pytest.mark.parametrize(("tracked", "compactions"), [(4096, 0), (4096, 2), (16, 2), (16, 0)])
def test_summaries_of_deltas_give_the_same_answer(spark, store, views_of, tracked, compactions):
    """With room enough the summaries prove the candidates; with 16 ids the pending rows are added up instead."""
    rng = random.Random(9)
    for batch_id in range(4):
        batch = [(f"vid_{int(rng.paretovariate(0.5)) % 700}", "2024-01-29 10:00") for _ in range(3000)]
        views = views_of(batch)
        store.write_summary(batch_id, summaries.summarize(views, tracked))
        store.write_delta(batch_id, count_by_hour(views))
        if batch_id < compactions:
            store.compact(NOW, fan_out=9)
    counted = store.recent(NOW).all_time
    assert len(counted.runs) == compactions and counted.summaries is not None
    with ranking.top_k_of_runs(counted, 20) as best:
        got = rows(best)
        plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert got == rows(ranking.top_k(store.tier("all_time"), 20))
    # One sum only, that of the candidates, unless the pending rows had to be added up before.
    sums = 2 if (tracked, compactions) == (16, 2) else 1
    assert plan.count("Aggregate [video_id") == sums and ("LeftSemi" in plan) == ((tracked, compactions) != (16, 0))
    store.compact(NOW)
    store.clean_up()
    assert store._finished("summaries") == {}
