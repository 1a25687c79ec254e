from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest

from conftest import rows
from viewrank.clock import Clock
from viewrank.operators.counting import as_tier, count_by_hour, fold
from viewrank.plans.maintenance import maintain
from viewrank.plans.snapshot import refresh_snapshot, replay_snapshot, top_videos
from viewrank.schema import TIER_KEYS
from viewrank.session import new_work_folder
from viewrank.sources.requests import parse_requests
from viewrank.sources.store import TierStore
from viewrank.sources.views import stream_requests, stream_table
from viewrank.streaming.closed_hours import open_hours, start_closed_hours
from viewrank.streaming.settled_hours import hours_by_fate, start_settled_hours
from viewrank.streaming.view_counts import start_request_counts, start_view_counts

ONCE = {"availableNow": True}
ARRIVALS = [
    [("vid_1", "2024-01-30 10:05", 2), ("vid_2", "2024-01-30 11:00")],
    [("vid_1", "2024-01-30 12:01"), ("vid_2", "2024-01-30 11:30", 4)],
    [("vid_1", "2024-01-10 08:00", 5), ("vid_3", "2023-11-02 00:00"), ("vid_2", "2024-01-30 12:40")],
]
EVERYTHING = [view for arrival in ARRIVALS for view in arrival]


@pytest.fixture
def folder(spark):
    return new_work_folder(spark, "test")


@pytest.fixture
def store(spark, folder):
    return TierStore(spark, f"{folder}/store")


def arrive(views, folder):
    views.coalesce(1).write.mode("append").parquet(f"{folder}/in")


def run(spark, folder, store, views_of, **options):
    stream = stream_table(spark, f"{folder}/in", views_of([]).schema, max_files=1)
    start_view_counts(stream, store, ONCE, **options).awaitTermination()


def check_all_tiers(store, views):
    hours = count_by_hour(views)
    for tier in TIER_KEYS:
        assert rows(store.tier(tier)) == rows(fold([as_tier(hours, tier)], tier)), tier


def test_every_arrival_is_counted_once_late_ones_too(spark, folder, store, views_of):
    for number, arrival in enumerate(ARRIVALS, 1):
        arrive(views_of(arrival), folder)
        run(spark, folder, store, views_of)
        assert store.batches() == list(range(number))
        check_all_tiers(store, views_of([v for a in ARRIVALS[:number] for v in a]))


def test_one_file_per_batch(spark, folder, store, views_of):
    for arrival in ARRIVALS:
        arrive(views_of(arrival), folder)
    run(spark, folder, store, views_of)
    assert store.batches() == [0, 1, 2]
    check_all_tiers(store, views_of(EVERYTHING))


def test_failure_between_delta_and_commit_is_replayed_once(spark, folder, store, views_of):
    class Failing(TierStore):
        def write_delta(self, batch_id, delta):
            super().write_delta(batch_id, delta)
            if batch_id == 1:
                raise RuntimeError("lost before the commit")

    for arrival in ARRIVALS:
        arrive(views_of(arrival), folder)
    with pytest.raises(Exception, match="lost before the commit"):
        run(spark, folder, Failing(spark, store.root), views_of)
    assert store.batches() == [0, 1]
    run(spark, folder, store, views_of)
    check_all_tiers(store, views_of(EVERYTHING))


def test_replay_after_compaction_counts_once(spark, folder, store, views_of, now):
    deltas = [count_by_hour(views_of(arrival)) for arrival in ARRIVALS[:2]]
    for batch_id, delta in enumerate(deltas):
        store.write_delta(batch_id, delta)
    assert store.compact(now) == 1
    store.write_delta(1, deltas[1])
    check_all_tiers(store, views_of([v for a in ARRIVALS[:2] for v in a]))


def test_compaction_keeps_totals_and_trims_old_buckets(store, views_of, now):
    for batch_id, arrival in enumerate(ARRIVALS):
        store.write_delta(batch_id, count_by_hour(views_of(arrival)))
        assert store.compact(now) == batch_id
        assert store.compact(now) == batch_id
    assert [row.hour_bucket for row in store.tier("hour").collect() if row.hour_bucket < now.keep_hours_from] == []
    assert ("vid_1", "2024-01-10", 5) in rows(store.tier("day"))
    assert all(row.day_bucket >= now.keep_days_from for row in store.tier("day").collect())
    assert ("vid_3", "2023-11", 1) in rows(store.tier("month"))
    assert rows(store.tier("all_time")) == [("vid_1", 8), ("vid_2", 6), ("vid_3", 1)]
    store.clean_up()
    assert store.batches() == []
    assert rows(store.tier("all_time")) == [("vid_1", 8), ("vid_2", 6), ("vid_3", 1)]
    assert list(store._finished("base")) == [2]


def test_a_second_maintenance_deletes_nothing_that_readers_may_hold(store, views_of, now):
    for batch_id, arrival in enumerate(ARRIVALS[:2]):
        store.write_delta(batch_id, count_by_hour(views_of(arrival)))
        maintain(store, now)
    maintain(store, now)
    assert (store.batches(), list(store._finished("base"))) == ([0, 1], [0, 1])


def test_visible_without_markers_of_the_writers(spark, store, views_of, now):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        store.write_delta(0, count_by_hour(views_of(ARRIVALS[0])))
        store.compact(now)
        refresh_snapshot(store, now)
    finally:
        hadoop.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert (store.batches(), store.base_version(), store.snapshot().isEmpty()) == ([0], 0, False)


@pytest.mark.parametrize("compacted", [False, True])
def test_a_new_checkpoint_goes_on_behind_the_old_one(spark, folder, store, views_of, now, compacted):
    arrive(views_of(ARRIVALS[0]), folder)
    run(spark, folder, store, views_of)
    if compacted:
        store.compact(now)
    store.checkpoint = f"{store.root}/checkpoint-2"
    run(spark, folder, store, views_of)  # reads everything again, as a new checkpoint does
    assert store.batches() == [0, 1]
    check_all_tiers(store, views_of(ARRIVALS[0] * 2))


def test_an_older_state_published_later_is_not_served(store, views_of, now):
    store.write_delta(0, count_by_hour(views_of(ARRIVALS[0])))
    store.publish(replay_snapshot(views_of(ARRIVALS[0]), now), now, 5)
    store.publish(replay_snapshot(views_of(ARRIVALS[1]), now), now, 3)
    assert {row.batch_id for row in store.snapshot().collect()} == {5}


def test_compaction_in_parts_equals_compaction_at_once(spark, folder, views_of, now):
    parts, whole = TierStore(spark, f"{folder}/parts"), TierStore(spark, f"{folder}/whole")
    for batch_id, arrival in enumerate(ARRIVALS):
        for store in (parts, whole):
            store.write_delta(batch_id, count_by_hour(views_of(arrival)))
    assert [parts.compact(now, through=b) for b in (0, 1, 2)] == [0, 1, 2]
    whole.compact(now)
    for tier in TIER_KEYS:
        assert rows(parts.tier(tier)) == rows(whole.tier(tier))


def test_unfinished_delta_and_base_are_not_read(store, views_of, now):
    store.write_delta(0, count_by_hour(views_of(ARRIVALS[0])))
    store.compact(now)
    store.write_delta(1, count_by_hour(views_of(ARRIVALS[1])))
    for name in ("base/v=1-lost", "deltas/batch_id=1"):
        count_by_hour(views_of(ARRIVALS[1])).write.mode("overwrite").parquet(f"{store.root}/{name}")
    check_all_tiers(store, views_of(ARRIVALS[0]))


def test_flush_refreshes_the_snapshot(spark, folder, store, views_of, now):
    arrive(views_of(ARRIVALS[0]), folder)
    run(spark, folder, store, views_of, on_flush=lambda s, batch_id: refresh_snapshot(s, now))
    assert rows(top_videos(store.snapshot(), "last day", 5)) == [
        ("last day", 5, 1, "vid_1", 2),
        ("last day", 5, 2, "vid_2", 1),
    ]
    published = store.snapshot().select("as_of", "batch_id").distinct()
    assert rows(published) == [(now.as_of, 0)]
    # Time alone changes the answer, without a view arriving.
    refresh_snapshot(store, Clock(datetime(2024, 1, 31, 11, 30)))
    assert rows(top_videos(store.snapshot(), "last day", 5)) == [("last day", 5, 1, "vid_2", 1)]


def test_flush_without_rows_and_failing_callback(spark, folder, store, views_of):
    calls = []

    def on_flush(flushed, batch_id):
        calls.append(batch_id)
        raise RuntimeError("snapshot failed")

    arrive(views_of([]), folder)
    run(spark, folder, store, views_of, on_flush=on_flush)
    assert calls == []
    arrive(views_of(ARRIVALS[0]), folder)
    run(spark, folder, store, views_of, on_flush=on_flush)
    assert len(calls) == 1
    check_all_tiers(store, views_of(ARRIVALS[0]))


def test_maintenance_compacts_and_refreshes(store, views_of, now):
    store.write_delta(0, count_by_hour(views_of(ARRIVALS[0])))
    maintain(store, now, timedelta(0))
    assert store.base_version() == 0
    assert top_videos(store.snapshot(), "all time", 5).count() == 2
    # What a run replaced stays for running readers until the next run.
    assert store.batches() == [0]
    store.write_delta(1, count_by_hour(views_of(ARRIVALS[1])))
    maintain(store, now, timedelta(0))
    assert (store.batches(), list(store._finished("base"))) == ([1], [0, 1])
    check_all_tiers(store, views_of(ARRIVALS[0] + ARRIVALS[1]))
    for _ in range(3):
        refresh_snapshot(store, now)
    store.clean_up(keep_snapshots=2)
    assert list(store._finished("snapshot")) == [3, 4]


def test_requests_as_text_files(spark, folder, store):
    bodies = [
        {"videoId": " vid_1 ", "timestamp": "2024-01-30T12:00:00+02:00"},
        {"videoId": "vid_1", "timestamp": "2024-01-30T12:59"},
        {"videoId": " ", "timestamp": "2024-01-30T12:59"},
        {"videoId": "vid_1", "timestamp": "soon"},
    ]
    lines = spark.createDataFrame([(json.dumps(b),) for b in bodies], "value STRING")
    lines.write.text(f"{folder}/in")
    requests = stream_requests(spark, "text", {"maxFilesPerTrigger": "1"}, f"{folder}/in")
    valid, _ = parse_requests(requests)
    start_view_counts(valid, store, ONCE).awaitTermination()
    assert rows(store.tier("hour")) == [("vid_1", "2024-01-30-12", 2)]
    assert rows(store.rejects()) == []
    both = TierStore(spark, f"{folder}/both")
    start_request_counts(requests, both, ONCE).awaitTermination()
    assert rows(both.tier("hour")) == rows(store.tier("hour"))
    assert [row.reason for row in both.rejects().orderBy("reason").collect()] == ["bad_timestamp", "empty_video_id"]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_closed_hours_are_final(spark, folder, views_of, zone):
    """The open hour is held back; a view older than the watermark of the last batch is dropped."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for arrival in (
            [("vid_1", "2024-01-30 10:05", 2), ("vid_1", "2024-01-30 12:00:30")],
            [("vid_2", "2024-01-30 11:30", 4), ("vid_2", "2024-01-30 10:59")],
            [("vid_3", "2024-01-30 13:00:59")],
            [("vid_3", "2024-01-30 13:01")],
        ):
            arrive(views_of(arrival), folder)
            stream = stream_table(spark, f"{folder}/in", views_of([]).schema)
            start_closed_hours(stream, f"{folder}/out", f"{folder}/cp", ONCE).awaitTermination()
        # After the first batch the watermark is 11:59:30: hour 10 is closed, hour 11 is not.
        assert rows(spark.read.parquet(f"{folder}/out")) == [
            ("vid_1", "2024-01-30-10", 2),
            ("vid_1", "2024-01-30-12", 1),
            ("vid_2", "2024-01-30-11", 4),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_closed_and_open_hours_hold_every_view_on_time(spark, folder, views_of):
    on_time = []
    for arrival, late in (
        ([("vid_1", "2024-01-30 10:05", 2), ("vid_1", "2024-01-30 12:00:30")], []),
        ([("vid_2", "2024-01-30 11:30", 4), ("vid_1", "2024-01-30 12:10")], [("vid_2", "2024-01-30 10:59")]),
        ([("vid_3", "2024-01-30 13:20"), ("vid_2", "2024-01-30 12:59", 3)], [("vid_9", "2023-01-30 13:20")]),
    ):
        arrive(views_of(arrival + late), folder)
        on_time += arrival
        stream = stream_table(spark, f"{folder}/in", views_of([]).schema)
        start_closed_hours(stream, f"{folder}/out", f"{folder}/cp", ONCE).awaitTermination()
        both = spark.read.parquet(f"{folder}/out").unionByName(open_hours(spark, f"{folder}/cp"))
        assert rows(both) == rows(count_by_hour(views_of(on_time)))
    assert {row.hour_bucket for row in open_hours(spark, f"{folder}/cp").collect()} == {"2024-01-30-13"}


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_settled_hours_hold_every_view_once(spark, folder, views_of, zone):
    """Closed, late and open hours after each arrival, with times before 1970 and to the second of a border."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    everything, late = [], []
    try:
        for arrival, too_late in (
            ([("vid_1", "2024-01-30 10:05", 2), ("vid_1", "2024-01-30 12:00:30")], []),
            ([("vid_2", "2024-01-30 11:30", 4), ("vid_1", "2024-01-30 12:10")], [("vid_2", "2024-01-30 10:59", 2)]),
            ([("vid_3", "2024-01-30 13:01"), ("vid_2", "2024-01-30 12:59:59", 3)], [("vid_9", "1960-05-01 13:20")]),
            ([("vid_3", "2024-01-30 13:00")], [("vid_2", "2024-01-30 10:58"), ("vid_1", "2024-01-30 12:59:59.999999")]),
        ):
            arrive(views_of(arrival + too_late), folder)
            everything, late = everything + arrival + too_late, late + too_late
            stream = stream_table(spark, f"{folder}/in", views_of([]).schema)
            start_settled_hours(stream, f"{folder}/out", f"{folder}/cp", ONCE).awaitTermination()
            found = hours_by_fate(spark, f"{folder}/out", f"{folder}/cp")
            by_fate = {fate: rows(found.filter(found.fate == fate).drop("fate")) for fate in ("closed", "late", "open")}
            assert by_fate["late"] == rows(count_by_hour(views_of(late)))
            on_time = views_of([view for view in everything if view not in late])
            assert sorted(by_fate["closed"] + by_fate["open"]) == rows(count_by_hour(on_time))
        assert {row[1] for row in by_fate["open"]} == {"2024-01-30-13"}
        assert len(by_fate["closed"]) == len(set(row[:2] for row in by_fate["closed"]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_settled_and_closed_hours_agree(spark, folder, views_of):
    for arrival in ARRIVALS:
        arrive(views_of(arrival), folder)
        for name, start in (("a", start_closed_hours), ("b", start_settled_hours)):
            stream = stream_table(spark, f"{folder}/in", views_of([]).schema)
            start(stream, f"{folder}/{name}", f"{folder}/cp-{name}", ONCE).awaitTermination()
    closed = spark.read.parquet(f"{folder}/b").filter("fate = 'closed'").drop("fate")
    assert rows(closed) == rows(spark.read.parquet(f"{folder}/a"))
    held = hours_by_fate(spark, f"{folder}/b", f"{folder}/cp-b").filter("fate = 'open'").drop("fate")
    assert rows(held) == rows(open_hours(spark, f"{folder}/cp-a"))
