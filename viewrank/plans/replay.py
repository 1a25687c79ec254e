"""Answers computed straight from views, as they stood at a chosen moment.

A view counts if `ts <= as_of`. Each plan reads only the time range its timeframe can use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewrank.clock import Clock
from viewrank.functions.buckets import day_text_of, hour_text_of, month_of
from viewrank.operators.counting import Tiers, count_all_time
from viewrank.operators.ranking import top_k
from viewrank.operators.timeframes import counts_last_hour
from viewrank.schema import MAX_K, check_timeframe
from viewrank.sources.views import views_between


def hour_rows(views: DataFrame) -> DataFrame:
    """Each view as an hour row that adds one."""
    return views.select("video_id", hour_text_of(F.col("ts")).alias("hour_bucket"), _one())


def day_rows(views: DataFrame) -> DataFrame:
    return views.select("video_id", day_text_of(F.col("ts")).alias("day_bucket"), _one())


def month_rows(views: DataFrame) -> DataFrame:
    month = month_of(day_text_of(F.col("ts")))
    return views.select("video_id", month.alias("month_bucket"), _one())


def _one() -> Column:
    return F.lit(1).cast("bigint").alias("count")


def replay_counts(views: DataFrame, timeframe: str, clock: Clock) -> DataFrame:
    """Counts per video: one range scan and one shuffle on video_id.

    Counting views from the start of the timeframe equals summing its buckets, since every start
    is a bucket boundary. Only last hour needs the bucket itself, for its fallback.
    """
    check_timeframe(timeframe)
    in_range = views_between(views, clock.start_of(timeframe), clock.as_of)
    if timeframe == "last hour":
        return counts_last_hour(hour_rows(in_range), clock)
    return count_all_time(in_range)


def replay_top_k(views: DataFrame, timeframe: str, clock: Clock, k: int = MAX_K) -> DataFrame:
    return top_k(replay_counts(views, timeframe, clock), k)


def replay_tiers(views: DataFrame, clock: Clock, timeframe: str) -> Tiers:
    """Views up to `as_of` in the form of tiers, for the operators that read tiers.

    A filter on a computed bucket does not reach the scan, so each tier is cut to the time range
    that `timeframe` reads from it. Last month takes closed days, and hours of today only.
    """
    start = clock.today_start if timeframe == "last month" else clock.start_of(timeframe)
    until_now = views_between(views, None, clock.as_of)
    return Tiers(
        hour=hour_rows(views_between(views, start, clock.as_of)),
        day=day_rows(views_between(views, clock.last_month_start, clock.today_start)),
        month=month_rows(until_now),
        all_time=until_now.select("video_id", _one()),
    )
