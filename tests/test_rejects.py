"""Refused requests by day, and what batches observe in flight."""

from __future__ import annotations

import json
import os
from pathlib import Path

import pytest

from conftest import rows
from viewrank.operators.counting import count_by_hour
from viewrank.session import new_work_folder
from viewrank.sources.store import TierStore
from viewrank.sources.views import stream_requests
from viewrank.streaming.view_counts import start_request_counts

SCHEMA = "reason STRING, body STRING"


@pytest.fixture
def store(spark):
    return TierStore(spark, new_work_folder(spark, "rejects"))


def refuse(store, batch_id, day, *bodies):
    rejects = store.spark.createDataFrame([("bad_timestamp", body) for body in bodies], SCHEMA)
    store.write_rejects(batch_id, rejects, day=day)


def files(store, day):
    """Files of a day that the newest version names."""
    folders = [f"refused_runs/{part.folder}" for part in store._refused()[0].parts if part.span == day]
    found = [f for folder in folders for f in Path(store.root, folder).glob("*.parquet")]
    return {str(f): os.stat(f).st_mtime_ns for f in found}


def test_rejects_are_merged_by_day_and_counted_once(store):
    expected = []
    for batch_id, (day, bodies) in enumerate(
        [("2024-01-29", "ab"), ("2024-01-29", "c"), ("2024-01-30", "de"), ("2024-01-30", ""), ("2024-01-31", "fg")]
    ):
        refuse(store, batch_id, day, *bodies)
        expected += [(day, batch_id, "bad_timestamp", body) for body in bodies]
        assert rows(store.dated_rejects()) == sorted(expected)
        assert store.merge_rejects(fan_out=2) == batch_id
        refuse(store, batch_id, day, *bodies)  # replayed
        assert rows(store.dated_rejects()) == sorted(expected)
        if batch_id == 1:
            store.clean_up()
            first_day = files(store, "2024-01-29")
    assert rows(store.rejects()) == sorted(row[2:] for row in expected)
    store.clean_up()
    assert list(store._finished("rejects")) == [] and rows(store.dated_rejects()) == sorted(expected)
    # Merged once, then left alone.
    assert len(first_day) == 1 and files(store, "2024-01-29") == first_day
    assert store.observed()["refused"] == len(expected)
    refuse(store, 5, "2024-02-01", "h")
    store.merge_rejects(fan_out=9, keep_from="2024-01-30")
    assert {row.day for row in store.dated_rejects().collect()} == {"2024-01-30", "2024-01-31", "2024-02-01"}


def test_a_day_reads_its_own_folders(store):
    refuse(store, 0, "2024-01-29", "a")
    refuse(store, 1, "2024-01-30", "b")
    store.merge_rejects()
    plan = store.dated_rejects().filter("day = '2024-01-30'")
    assert "PartitionFilters: [isnotnull(span" in plan._jdf.queryExecution().executedPlan().toString()
    assert rows(plan) == [("2024-01-30", 1, "bad_timestamp", "b")]


def test_valid_and_refused_make_up_what_was_received(spark, store, now):
    folder = new_work_folder(spark, "observed")
    for n in range(3):
        bodies = [{"videoId": f"vid_{n}", "timestamp": f"2024-01-30T1{k}:00"} for k in range(n + 1)]
        bodies += [{"videoId": " ", "timestamp": "2024-01-30T12:00"}] * (2 - n)
        lines = spark.createDataFrame([(json.dumps(b),) for b in bodies], "value STRING")
        lines.coalesce(1).write.mode("append").text(f"{folder}/in")
        requests = stream_requests(spark, "text", {}, f"{folder}/in")
        start_request_counts(requests, store, {"availableNow": True}).awaitTermination()
        valid, refused = sum(range(1, n + 2)), sum(range(2 - n, 3))
        assert store.observed() == {"received": valid + refused, "valid": valid, "refused": refused}
        if n < 2:
            store.compact(now)
            store.merge_rejects()
            store.clean_up()
            assert store.observed() == {"received": valid + refused, "valid": valid, "refused": refused}


def test_observed_numbers_need_no_rows(store, views_of):
    assert store.observed() == {"received": 0, "valid": 0, "refused": 0}
    store.write_delta(0, count_by_hour(views_of([("vid_1", "2024-01-30 12:00", 3), ("vid_2", "2024-01-30 11:00")])))
    store.write_delta(1, count_by_hour(views_of([])))
    for file in Path(store.root).glob("deltas/*/*.parquet"):
        file.write_bytes(b"not to be read")
    assert store.observed()["valid"] == 4
    assert [store.delta_is_empty(b) for b in (0, 1)] == [False, True]
