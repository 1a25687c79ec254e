"""The top-K lists at the end of every hour of a stretch of time, in one plan.

Asking hour by hour would scan the views once for each. Here every hour count enters a timeframe at the hour in which
its views fall and leaves it at the hour that no longer reaches back to it: two events, +n and -n. A video's counts
are the running sums of its events, and change at those hours only. One scan and one shuffle of views, counted
per hour first, answer all hours.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewrank.clock import Clock
from viewrank.functions.buckets import hour_text_of, wall_clock
from viewrank.functions.shards import shard_of
from viewrank.plans.snapshot import rank_candidates
from viewrank.schema import MAX_K, check_length
from viewrank.sources.views import views_between

_HOUR = timedelta(hours=1)
# Hours that a closed hour stays in the last day, and days that a day stays in the last month.
_LAST_DAY_HOURS, _LAST_MONTH_DAYS = 25, 31


def moments(start: datetime, hours: int) -> list[Clock]:
    """The last instant of each hour from `start`, which lies on a full hour."""
    if (start.minute, start.second, start.microsecond) != (0, 0, 0):
        raise ValueError(f"a series starts on a full hour, not at {start}")
    if hours < 1:
        raise ValueError(f"a series holds at least one hour, not {hours}")
    return [Clock(start + (n + 1) * _HOUR - timedelta(microseconds=1)) for n in range(hours)]


def _stays(own: Column, day: Column, start: datetime) -> list[Column]:
    """Timeframes with the places (hours from the start) at which a count comes and goes."""
    midnight = F.date_diff(day, F.lit(start.date().isoformat()).cast("date")) * 24 - start.hour
    ends = {
        ("last hour", 0): (own, own + 1),
        ("last hour", 1): (own + 1, own + 2),
        ("last day", 0): (own, own + _LAST_DAY_HOURS),
        ("last month", 0): (own, midnight + 24 * _LAST_MONTH_DAYS),
        ("all time", 0): (own, F.lit(None)),
    }
    return [
        F.struct(
            F.lit(timeframe).alias("timeframe"),
            F.lit(preference).alias("preference"),
            F.greatest(enters, F.lit(0)).cast("int").alias("enters"),
            leaves.cast("int").alias("leaves"),
        )
        for (timeframe, preference), (enters, leaves) in ends.items()
    ]


def running_counts(views: DataFrame, start: datetime, hours: int) -> DataFrame:
    """`place, timeframe, preference, video_id, count` for every hour and video with a count above zero."""
    until = moments(start, hours)[-1]
    counted = (
        views_between(views, None, until.as_of)
        .groupBy("video_id", F.to_date("ts").alias("day"), F.hour("ts").alias("hour"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    own = F.date_diff(F.col("day"), F.lit(start.date().isoformat()).cast("date")) * 24 + F.col("hour") - start.hour
    stays = counted.select("video_id", "n", F.inline(F.array(*_stays(own, F.col("day"), start))))
    seen = stays.filter((F.col("enters") < hours) & (F.col("leaves").isNull() | (F.col("leaves") > 0)))
    events = F.array(
        F.struct(F.col("enters").alias("place"), F.col("n").alias("change")),
        F.struct(F.col("leaves").alias("place"), (-F.col("n")).alias("change")),
    )
    keys = ["video_id", "timeframe", "preference"]
    changes = (
        seen.select(*keys, F.inline(events))
        .filter(F.col("place") < hours)  # drops what never leaves, too
        .groupBy(*keys, "place")
        .agg(F.sum("change").alias("change"))
    )
    in_time = Window.partitionBy(*keys).orderBy("place")  # at most one row an hour
    totals = changes.select(
        *keys,
        "place",
        F.sum("change").over(in_time).alias("count"),
        (F.lead("place", 1, hours).over(in_time) - 1).alias("until"),
    )
    return totals.filter(F.col("count") > 0).select(
        F.explode(F.sequence("place", "until")).alias("place"), "timeframe", "preference", "video_id", "count"
    )


def top_k_series(views: DataFrame, start: datetime, hours: int = 24, k: int = MAX_K) -> DataFrame:
    """`hour_bucket, timeframe, rank, video_id, count`: all four lists as they stood when each hour ended."""
    check_length(k)
    rows = running_counts(views, start, hours).withColumn("shard", shard_of(F.col("video_id")))
    ranked = rank_candidates(rows, k, "place")
    hour = wall_clock(start) + F.make_dt_interval(hours=F.col("place"))
    return ranked.select(hour_text_of(hour).alias("hour_bucket"), "timeframe", "rank", "video_id", "count")
