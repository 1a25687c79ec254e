"""Counts per video for each timeframe, read from tiers.

The inputs may hold several rows per key (see `counting`): every function sums, in one shuffle.
Filters compare the stored bucket text, which reaches Parquet as pushed or partition filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewrank.clock import Clock, day_text, hour_text
from viewrank.functions.shards import shard_of
from viewrank.operators.counting import Tiers
from viewrank.schema import check_timeframe


def _sum_by_video(rows: DataFrame) -> DataFrame:
    return rows.groupBy("video_id").agg(F.sum("count").alias("count"))


def counts_last_hour(hours: DataFrame, clock: Clock) -> DataFrame:
    """The running hour, or the previous one for a shard that has no row in the running hour.

    Which shards have a running hour is a scalar subquery, a list of at most ten numbers; a
    window over the shard would sort all videos of a shard in one task. The subquery reads both
    sums so that its shuffle is the one of the main query: Spark then scans and counts once.
    """
    running, previous = hour_text(clock.hour_start), hour_text(clock.previous_hour_start)
    hour, shard = F.col("hour_bucket"), shard_of(F.col("video_id"))
    per_video = (
        hours.filter(hour.isin(running, previous))
        .groupBy("video_id")
        .agg(
            F.sum(F.when(hour == running, F.col("count"))).alias("running"),
            F.sum(F.when(hour == previous, F.col("count"))).alias("previous"),
        )
    )
    busy = F.collect_set(F.when(F.col("running") > 0, shard))
    summary = per_video.agg(F.struct(busy.alias("shards"), F.sum("previous").alias("previous"))).scalar()
    count = F.when(F.array_contains(summary["shards"], shard), F.col("running")).otherwise(F.col("previous"))
    return per_video.select("video_id", count.alias("count")).filter(F.col("count") > 0)


def counts_last_day(hours: DataFrame, clock: Clock) -> DataFrame:
    return _sum_by_video(hours.filter(F.col("hour_bucket") >= hour_text(clock.last_day_start)))


def hours_of_today(hours: DataFrame, clock: Clock) -> DataFrame:
    return hours.filter(F.col("hour_bucket").startswith(day_text(clock.today_start) + "-"))


def closed_days_of_month(days: DataFrame, clock: Clock) -> DataFrame:
    return days.filter(
        (F.col("day_bucket") >= day_text(clock.last_month_start))
        & (F.col("day_bucket") < day_text(clock.today_start))
    )


def counts_today(hours: DataFrame, clock: Clock) -> DataFrame:
    return _sum_by_video(hours_of_today(hours, clock))


def counts_last_month(days: DataFrame, hours: DataFrame, clock: Clock) -> DataFrame:
    """Closed days from the day tier and today from the hour tier: each view once."""
    closed = closed_days_of_month(days, clock).select("video_id", "count")
    today = hours_of_today(hours, clock).select("video_id", "count")
    return _sum_by_video(closed.unionByName(today))


def counts_all_time(totals: DataFrame) -> DataFrame:
    return _sum_by_video(totals)


def counts_for(timeframe: str, tiers: Tiers, clock: Clock) -> DataFrame:
    check_timeframe(timeframe)
    if timeframe == "last hour":
        return counts_last_hour(tiers.hour, clock)
    if timeframe == "last day":
        return counts_last_day(tiers.hour, clock)
    if timeframe == "last month":
        return counts_last_month(tiers.day, tiers.hour, clock)
    return counts_all_time(tiers.all_time)
