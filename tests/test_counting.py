from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows
from viewrank.clock import Clock
from viewrank.operators import counting, monitor, ranking, rollup
from viewrank.plans.replay import day_rows, hour_rows

VIEWS = [
    ("a", "2024-01-29 23:10", 2),
    ("a", "2024-01-30 00:00"),
    ("a", "2024-02-01 05:59:59"),
    ("b", "2024-01-30 00:30", 3),
    ("b", "1969-12-31 23:30"),
]


def test_tiers_agree(views_of):
    views = views_of(VIEWS)
    hours = counting.count_by_hour(views)
    assert rows(hours) == [
        ("a", "2024-01-29-23", 2),
        ("a", "2024-01-30-00", 1),
        ("a", "2024-02-01-05", 1),
        ("b", "1969-12-31-23", 1),
        ("b", "2024-01-30-00", 3),
    ]
    direct = {
        "hour": hours,
        "day": counting.count_by_day(views),
        "month": counting.count_by_month(views),
        "all_time": counting.count_all_time(views),
    }
    together = counting.all_tiers(hours)
    for tier, counted in direct.items():
        assert rows(counting.fold([counting.as_tier(hours, tier)], tier)) == rows(counted)
        assert together.filter(F.col("tier") == tier).agg(F.sum("count")).first()[0] == 8
        assert together.filter(F.col("tier") == tier).count() == counted.count()
    assert rows(together.filter("tier = 'month'").select("video_id", "bucket", "count")) == rows(direct["month"])


def test_fold_in_any_split_is_one_count(views_of):
    whole = counting.count_by_hour(views_of(VIEWS * 2))
    parts = [counting.count_by_hour(views_of(part)) for part in (VIEWS[:2], VIEWS[2:], VIEWS)]
    assert rows(counting.fold(parts, "hour")) == rows(whole)
    assert rows(counting.fold([hour_rows(views_of(VIEWS * 2))], "hour")) == rows(whole)


def test_roll_up_is_repeatable_and_takes_one_bucket(views_of):
    views = views_of(VIEWS)
    hours = counting.count_by_hour(views)
    once = rollup.roll_hour_to_day(hours, "2024-01-30-00")
    assert rows(once) == [("a", "2024-01-30", 1), ("b", "2024-01-30", 3)]
    assert rows(rollup.roll_hour_to_day(hours, "2024-01-30-00")) == rows(once)
    assert rows(rollup.roll_day_to_month(day_rows(views), "2024-01-29")) == [("a", "2024-01", 2)]


def test_retention_edges(spark):
    clock = Clock(datetime(2024, 1, 30, 12, 45))
    hours = spark.sql(
        """SELECT 'v' AS video_id, date_format(t, 'yyyy-MM-dd-HH') AS hour_bucket, 1L AS count FROM (
        SELECT explode(sequence(TIMESTAMP'2024-01-29 11:00', TIMESTAMP'2024-01-30 12:00', INTERVAL 1 HOUR)) t)"""
    )
    days = spark.sql(
        """SELECT 'v' AS video_id, string(d) AS day_bucket, 1L AS count FROM (
        SELECT explode(sequence(DATE'2023-12-29', DATE'2024-01-30')) d)"""
    )
    kept = [row.hour_bucket for row in rollup.retain_hours(hours, clock).collect()]
    assert (len(kept), min(kept)) == (25, "2024-01-29-12")
    kept = [row.day_bucket for row in rollup.retain_days(days, clock).collect()]
    assert (len(kept), min(kept)) == (32, "2023-12-30")


def counts_of(spark, pairs):
    return spark.createDataFrame(pairs, "video_id STRING, count BIGINT")


def test_ties_at_the_cut_go_to_the_smaller_id(spark):
    counts = counts_of(spark, [("a", 5), ("c", 3), ("b", 3), ("d", 3)])
    assert rows(ranking.top_k(counts, 2)) == [(1, "a", 5), (2, "b", 3)]


def test_top_k_is_a_prefix_and_merging_changes_nothing(spark):
    counts = counts_of(spark, [(f"vid_{i}", i % 7) for i in range(300)])
    longer = rows(ranking.top_k(counts, 40))
    assert rows(ranking.top_k(counts, 39)) == longer[:39]
    per_shard = ranking.top_k_per_shard(counts, 40)
    assert rows(ranking.merge_top_k(per_shard, 40)) == longer
    three = ranking.top_k_per_shard(counts, 3)
    assert three.count() == 30
    assert {row.rank for row in three.collect()} == {1, 2, 3}


def test_reconcile(spark, views_of):
    served = spark.createDataFrame(
        [(1, "vid_4", 25), (2, "vid_2", 2), (3, "gone", 1)], "rank INT, video_id STRING, count BIGINT"
    )
    views = views_of([("vid_4", "2024-01-01 00:00", 28), ("vid_2", "2024-01-01 00:00", 2), ("other", "2024-01-01 00:00")])
    assert rows(monitor.reconcile(served, views)) == [
        (1, "vid_4", 25, 28, 3, "+3 unflushed"),
        (2, "vid_2", 2, 2, 0, "in sync"),
        (3, "gone", 1, 0, -1, "+-1 unflushed"),
    ]


def test_totals_share_and_shards(spark):
    counts = counts_of(spark, [("vid_6", 15), ("vid_7", 23), ("vid_4", 28)])
    assert rows(monitor.view_totals(counts)) == [(66, 28)]
    assert rows(monitor.view_share(counts)) == [("vid_4", 28, 42.4), ("vid_6", 15, 22.7), ("vid_7", 23, 34.8)]
    load = rows(monitor.shard_load(counts))
    assert [row[0] for row in load] == list(range(10))
    assert [row for row in load if row[1]] == [(0, 1, 28), (3, 2, 38)]
    assert rows(monitor.shard_videos(counts)) == [(0, "vid_4", 28), (3, "vid_6", 15), (3, "vid_7", 23)]
    nothing = counts_of(spark, [])
    assert rows(monitor.view_totals(nothing)) == [(0, 0)]
    assert rows(monitor.view_share(nothing)) == []
    assert rows(monitor.view_share(counts_of(spark, [("a", 0)]))) == [("a", 0, 0.0)]
