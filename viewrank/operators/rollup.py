"""Roll-up of one closed bucket into the next tier, and retention.

A roll-up is a function of its input only: running it again gives the same rows, which replace
the earlier ones instead of being added to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewrank.clock import Clock
from viewrank.functions.buckets import day_of, month_of


def roll_hour_to_day(hours: DataFrame, hour_bucket: str) -> DataFrame:
    """What one hour adds to its day."""
    return _roll(hours, "hour_bucket", hour_bucket, "day_bucket", day_of)


def roll_day_to_month(days: DataFrame, day_bucket: str) -> DataFrame:
    """What one day adds to its month."""
    return _roll(days, "day_bucket", day_bucket, "month_bucket", month_of)


def _roll(rows: DataFrame, source: str, bucket: str, target: str, shorten) -> DataFrame:
    return (
        rows.filter(F.col(source) == bucket)
        .groupBy("video_id", shorten(F.col(source)).alias(target))
        .agg(F.sum("count").alias("count"))
    )


def retain_hours(hours: DataFrame, clock: Clock) -> DataFrame:
    return hours.filter(F.col("hour_bucket") >= clock.keep_hours_from)


def retain_days(days: DataFrame, clock: Clock) -> DataFrame:
    return days.filter(F.col("day_bucket") >= clock.keep_days_from)
