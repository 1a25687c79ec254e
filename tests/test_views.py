from __future__ import annotations

from datetime import datetime

from conftest import rows
from viewrank.plans.replay import replay_counts
from viewrank.sources.views import refused_from, views_between, views_from


def test_any_table_gives_views(spark):
    table = spark.sql(
        """SELECT * FROM VALUES (1L, TIMESTAMP_NTZ'2024-01-30 12:00', 'x'), (NULL, TIMESTAMP_NTZ'2024-01-30 12:00', 'x'),
        (2L, NULL, 'x') AS t(item, at, other)"""
    )
    views = views_from(table, "item", "at", prefix="vid_")
    assert rows(views) == [("vid_1", datetime(2024, 1, 30, 12))]
    assert rows(views_from(table, "item", "at")) == [("1", datetime(2024, 1, 30, 12))]


def test_text_ids_are_stripped_and_refused_rows_have_a_reason(spark):
    at = datetime(2024, 1, 30, 12)
    table = spark.createDataFrame([(" a\t", at), ("a", at), ("", at), ("\u3000", at), (None, at), ("b", None)], "item STRING, at TIMESTAMP_NTZ")
    assert rows(views_from(table, "item", "at")) == [("a", at)] * 2
    refused = refused_from(table, "item", "at").select("reason")
    assert rows(refused) == [("empty_video_id",)] * 2 + [("missing_timestamp",), ("missing_video_id",)]


def test_times_with_a_zone_keep_the_wall_clock_of_the_session(spark):
    table = spark.sql("SELECT 'a' AS item, TIMESTAMP'2024-01-30 12:00:00' AS at")
    assert rows(views_from(table, "item", "at")) == [("a", datetime(2024, 1, 30, 12))]


def test_range_is_inclusive(views_of, now):
    views = views_of([("a", "2024-01-30 12:45"), ("b", "2024-01-30 12:45:00.000001"), ("c", "2024-01-29 12:00")])
    assert [row[0] for row in rows(views_between(views, now.last_day_start, now.as_of))] == ["a", "c"]
    assert rows(replay_counts(views, "last day", now)) == [("a", 1), ("c", 1)]
