"""Each hour of a series equals the replay at its end."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from conftest import rows
from viewrank.plans.replay import replay_counts
from viewrank.plans.series import moments, running_counts, top_k_series
from viewrank.plans.snapshot import replay_snapshot

VIEWS = [
    ("vid_1", "2024-02-28 22:59:59.999999", 3), ("vid_1", "2024-02-28 23:00", 2), ("vid_2", "2024-02-29 00:00", 4),
    ("vid_3", "2024-02-29 01:30"), ("vid_1", "2024-02-29 01:30", 5), ("vid_4", "2024-01-29 00:00", 9),
    ("vid_5", "2024-01-30 23:59", 7), ("vid_6", "2024-01-28 23:59", 8), ("vid_7", "2024-01-29 23:30", 6),
    ("vid_2", "2024-02-27 22:30", 2), ("vid_2", "2024-02-28 00:15"), ("vid_8", "2024-03-01 04:00"),
    ("vid_9", "2023-02-28 23:10", 2), ("vid_10", "2024-03-02 23:10", 2), ("vid_3", "2024-02-28 21:59", 3),
]


@pytest.mark.parametrize(("start", "hours"), [(datetime(2024, 2, 28, 22), 30), (datetime(2024, 2, 29), 1)])
def test_series_equals_a_replay_of_each_hour(spark, views_of, start, hours):
    views = views_of(VIEWS)
    series = top_k_series(views, start, hours, k=100).collect()
    for clock in moments(start, hours)[:: max(1, hours // 6)]:
        bucket = f"{clock.as_of:%Y-%m-%d-%H}"
        own = sorted(tuple(row)[1:] for row in series if row.hour_bucket == bucket)
        assert own == rows(replay_snapshot(views, clock)), bucket


def test_counts_of_every_hour_equal_their_replay(spark, views_of):
    views, start = views_of(VIEWS), datetime(2024, 2, 28, 23)
    counted = running_counts(views, start, 28).collect()
    for place, clock in list(enumerate(moments(start, 28)))[::9]:
        for timeframe in ("last day", "last month", "all time"):
            own = sorted((r.video_id, r["count"]) for r in counted if (r.place, r.timeframe) == (place, timeframe))
            assert own == rows(replay_counts(views, timeframe, clock)), (clock, timeframe)


def test_short_lists_and_no_views(spark, views_of):
    assert top_k_series(views_of([]), datetime(2024, 2, 28), 24).collect() == []
    short = top_k_series(views_of(VIEWS), datetime(2024, 2, 29, 1), 1, k=2)
    assert [tuple(r)[2:] for r in short.filter("timeframe = 'all time'").orderBy("rank").collect()] == [
        (1, "vid_1", 10), (2, "vid_4", 9),
    ]
    with pytest.raises(ValueError):
        moments(datetime(2024, 2, 29, 1, 30), 2)
    with pytest.raises(ValueError):
        top_k_series(views_of([]), datetime(2024, 2, 29), 0)


def test_one_scan_answers_all_hours(spark, tmp_path, views_of):
    views_of(VIEWS).write.parquet(f"{tmp_path}/views")
    plan = top_k_series(spark.read.parquet(f"{tmp_path}/views"), datetime(2024, 2, 28), 24)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("WindowGroupLimit") == 4
    assert "LessThanOrEqual(ts" in text and "BroadcastNestedLoopJoin" not in text
    assert moments(datetime(2024, 2, 28), 2)[1].as_of + timedelta(microseconds=1) == datetime(2024, 2, 28, 2)
