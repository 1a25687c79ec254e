"""Views to counted rows, and counted rows to tiers.

A tier is a relation of rows that each add `count` views to a key. Rows of one key may repeat
(a base table and later deltas, for example): readers sum, so nothing has to be merged first.
`fold` gives the form with one row per key.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewrank.functions.buckets import day_of, join_hour, month_of
from viewrank.schema import BUCKET_COLUMN, TIER_KEYS


@dataclass(frozen=True)
class Tiers:
    """The four counted relations a question can be answered from."""

    hour: DataFrame
    day: DataFrame
    month: DataFrame
    all_time: DataFrame


def _view_count() -> Column:
    return F.count(F.lit(1)).alias("count")


def count_by_hour(views: DataFrame) -> DataFrame:
    """Views per video and hour.

    Groups on a date and an hour number and writes the bucket text afterwards: fixed-width keys
    hash faster than text. Each task counts its own rows first, so a video with a third of all
    views reaches the shuffle as one row per hour and task.
    """
    return (
        views.groupBy("video_id", F.to_date("ts").alias("day"), F.hour("ts").alias("hour"))
        .agg(_view_count())
        .select(
            "video_id", join_hour(F.col("day"), F.col("hour")).alias("hour_bucket"), "count"
        )
    )


def count_by_day(views: DataFrame) -> DataFrame:
    return (
        views.groupBy("video_id", F.to_date("ts").alias("day"))
        .agg(_view_count())
        .select("video_id", F.col("day").cast("string").alias("day_bucket"), "count")
    )


def count_by_month(views: DataFrame) -> DataFrame:
    return (
        views.groupBy("video_id", F.trunc(F.to_date("ts"), "month").alias("month"))
        .agg(_view_count())
        .select("video_id", month_of(F.col("month").cast("string")).alias("month_bucket"), "count")
    )


def count_all_time(views: DataFrame) -> DataFrame:
    return views.groupBy("video_id").agg(_view_count())


def fold(relations: Iterable[DataFrame], tier: str) -> DataFrame:
    """Add counted relations of one tier: one row per key."""
    first, *others = relations
    rows = first
    for other in others:
        rows = rows.unionByName(other)
    return rows.groupBy(*TIER_KEYS[tier]).agg(F.sum("count").alias("count"))


def as_tier(hours: DataFrame, tier: str) -> DataFrame:
    """Hour rows written as rows of another tier, without aggregating."""
    bucket = {
        "hour": F.col("hour_bucket"),
        "day": day_of(F.col("hour_bucket")),
        "month": month_of(F.col("hour_bucket")),
    }
    if tier == "all_time":
        return hours.select("video_id", "count")
    return hours.select("video_id", bucket[tier].alias(BUCKET_COLUMN[tier]), "count")


def all_tiers(hours: DataFrame) -> DataFrame:
    """All four tiers: `tier, video_id, bucket, count`. `hours` has one row per key.

    The hour rows are taken as they are. The other tiers come from them in one aggregation over
    grouping sets, so the largest tier is not shuffled again; Spark reuses its shuffle.
    """
    keyed = hours.select(
        "video_id",
        day_of(F.col("hour_bucket")).alias("day_bucket"),
        month_of(F.col("hour_bucket")).alias("month_bucket"),
        "count",
    )
    video, day, month = (F.col(key) for key in ("video_id", "day_bucket", "month_bucket"))
    coarser = (
        keyed.groupingSets([[video, day], [video, month], [video]], video, day, month)
        .agg(
            F.when(F.grouping("day_bucket") == 0, "day")
            .when(F.grouping("month_bucket") == 0, "month")
            .otherwise("all_time")
            .alias("tier"),
            F.sum("count").alias("count"),
        )
        .select("tier", "video_id", F.coalesce(day, month, F.lit("")).alias("bucket"), "count")
    )
    finest = hours.select(F.lit("hour").alias("tier"), "video_id", F.col("hour_bucket").alias("bucket"), "count")
    return finest.unionByName(coarser)
