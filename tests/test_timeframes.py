from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import model
from conftest import rows
from viewrank.clock import Clock
from viewrank.operators.counting import Tiers, count_all_time, count_by_day, count_by_hour, count_by_month
from viewrank.operators.ranking import top_k
from viewrank.operators.timeframes import counts_for, counts_last_month, counts_today
from viewrank.plans.replay import replay_counts, replay_tiers
from viewrank.plans.snapshot import rank_slots, slots_from_tiers, slots_from_views
from viewrank.schema import TIMEFRAMES, VIEW


def tiers_of(views):
    return Tiers(count_by_hour(views), count_by_day(views), count_by_month(views), count_all_time(views))


def test_shard_without_running_hour_falls_back(views_of, now):
    views = views_of(
        [
            ("vid_1", "2024-01-30 12:10"),
            ("vid_1", "2024-01-30 11:10", 4),
            ("vid_2", "2024-01-30 11:59", 3),
            ("vid_3", "2024-01-30 10:59", 9),
        ]
    )
    expected = [("vid_1", 1), ("vid_2", 3)]
    assert rows(replay_counts(views, "last hour", now)) == expected
    assert rows(counts_for("last hour", tiers_of(views), now)) == expected


def test_videos_of_one_shard_share_the_fallback(views_of, now):
    # vid_6 and vid_7 live in shard 3: a running hour of one hides the previous hour of the other.
    views = views_of([("vid_6", "2024-01-30 12:00"), ("vid_7", "2024-01-30 11:30", 5)])
    assert rows(replay_counts(views, "last hour", now)) == [("vid_6", 1)]
    assert rows(rank_slots(slots_from_views(views, now)).filter("timeframe = 'last hour'")) == [
        ("last hour", 1, "vid_6", 1)
    ]


def test_last_day_edge(views_of, now):
    views = views_of([("vid_1", "2024-01-29 12:00"), ("vid_2", "2024-01-29 11:59:59.999999")])
    assert rows(replay_counts(views, "last day", now)) == [("vid_1", 1)]
    assert rows(counts_for("last day", tiers_of(views), now)) == [("vid_1", 1)]


def test_last_month_edge(views_of):
    clock = Clock(datetime(2024, 2, 5, 12, 45))
    views = views_of([("vid_1", "2024-01-06 00:00"), ("vid_2", "2024-01-05 23:59")])
    assert rows(replay_counts(views, "last month", clock)) == [("vid_1", 1)]
    assert rows(counts_for("last month", tiers_of(views), clock)) == [("vid_1", 1)]


def test_a_view_of_today_counts_once(views_of, now):
    views = views_of([("vid_1", "2024-01-30 03:00")])
    assert rows(counts_last_month(count_by_day(views), count_by_hour(views), now)) == [("vid_1", 1)]
    assert rows(counts_today(count_by_hour(views), now)) == [("vid_1", 1)]


def test_future_views_wait_in_replay(views_of, now):
    views = views_of([("vid_1", "2024-01-30 12:46")])
    for timeframe in TIMEFRAMES:
        assert rows(replay_counts(views, timeframe, now)) == []


def test_no_views(views_of, now):
    empty = views_of([])
    for timeframe in TIMEFRAMES:
        assert rows(replay_counts(empty, timeframe, now)) == []
    assert rows(rank_slots(slots_from_views(empty, now))) == []


def test_unknown_timeframe(views_of, now):
    with pytest.raises(ValueError, match="last week"):
        replay_counts(views_of([]), "last week", now)
    with pytest.raises(ValueError, match="last week"):
        counts_for("last week", tiers_of(views_of([])), now)


NOW = datetime(2024, 2, 14, 0, 30)
moments = st.one_of(
    st.integers(0, 3 * 60), st.integers(0, 27 * 60), st.integers(0, 34 * 24 * 60), st.just(-5)
).map(lambda minutes: NOW - timedelta(minutes=minutes))
view_lists = st.lists(st.tuples(st.integers(1, 14).map(lambda i: f"vid_{i}"), moments), max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(view_lists)
def test_all_routes_agree_with_plain_python(spark, views):
    clock, df = Clock(NOW), spark.createDataFrame(views, VIEW)
    k = 3
    past = spark.createDataFrame([v for v in views if v[1] <= NOW], VIEW)
    from_views = rows(rank_slots(slots_from_views(df, clock), k))
    from_tiers = rows(rank_slots(slots_from_tiers(tiers_of(past), clock), k))
    expected = []
    for timeframe in TIMEFRAMES:
        counted = model.counts(views, timeframe, NOW)
        best = model.top(counted, k)
        expected += [(timeframe, *row) for row in best]
        replayed = replay_counts(df, timeframe, clock)
        assert rows(replayed) == sorted(counted.items())
        assert rows(counts_for(timeframe, replay_tiers(df, clock, timeframe), clock)) == sorted(counted.items())
        assert rows(top_k(replayed, k)) == best
    assert from_views == from_tiers == sorted(expected)
