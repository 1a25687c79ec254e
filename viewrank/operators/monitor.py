"""Freshness, share, totals and shard load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewrank.functions.shards import shard_of
from viewrank.schema import NUM_SHARDS


def reconcile(served: DataFrame, views: DataFrame) -> DataFrame:
    """Served rows against the views received so far: lag and status.

    `served` is one ranked list, at most MAX_K rows. Its ids cut the views first (a broadcast
    semi join), so only the served videos are counted, again at most MAX_K; the left join then
    keeps served videos without views.
    """
    ids = served.select("video_id")
    sent = (
        views.join(F.broadcast(ids), "video_id", "left_semi")
        .groupBy("video_id")
        .agg(F.count(F.lit(1)).alias("sent"))
    )
    lag = F.col("sent") - F.col("served")
    return (
        served.select("rank", "video_id", F.col("count").alias("served"))
        .join(F.broadcast(sent), "video_id", "left")
        .withColumn("sent", F.coalesce("sent", F.lit(0).cast("bigint")))
        .select(
            "rank",
            "video_id",
            "served",
            "sent",
            lag.alias("lag"),
            F.when(lag == 0, "in sync")
            .otherwise(F.concat(F.lit("+"), lag.cast("string"), F.lit(" unflushed")))
            .alias("status"),
        )
    )


def view_totals(counts: DataFrame) -> DataFrame:
    """All views, and the views of the most-viewed video."""
    return counts.agg(
        F.coalesce(F.sum("count"), F.lit(0).cast("bigint")).alias("total_views"),
        F.coalesce(F.max("count"), F.lit(0).cast("bigint")).alias("max_views"),
    )


def view_share(counts: DataFrame) -> DataFrame:
    """Each video's percentage of all views; the total is a scalar subquery, not a join."""
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0).cast("bigint")).alias("total")).scalar()
    return counts.select("video_id", "count", total.alias("total")).select(
        "video_id",
        "count",
        F.when(F.col("total") == 0, F.lit(0.0))
        .otherwise(F.round(F.lit(100.0) * F.col("count") / F.col("total"), 1))
        .alias("pct"),
    )


def shard_videos(counts: DataFrame) -> DataFrame:
    """Which shard owns which video, one row per video: a list per shard would not stay bounded."""
    return counts.select(shard_of(F.col("video_id")).alias("shard"), "video_id", "count")


def shard_load(counts: DataFrame) -> DataFrame:
    """Videos and views of each shard; a shard without videos shows zeros."""
    loads = (
        shard_videos(counts)
        .groupBy("shard")
        .agg(F.count(F.lit(1)).alias("video_count"), F.sum("count").alias("view_count"))
    )
    shards = counts.sparkSession.range(0, NUM_SHARDS, 1, 1).select(F.col("id").cast("int").alias("shard"))
    return shards.join(loads, "shard", "left").na.fill(0, ["video_count", "view_count"])
