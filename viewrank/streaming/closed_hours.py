"""Hours that are final: emitted once, one minute after they end; later views are dropped.

Hours that are still open are counted in the state of the stream and can be read from its checkpoint.
"""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from viewrank.functions.buckets import hour_text_of, wall_clock

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# A watermark needs TIMESTAMP. Adding the distance from an epoch keeps the wall clock in any
# session time zone, where a cast would not.


def _epochs() -> tuple[Column, Column]:
    return F.timestamp_seconds(F.lit(0)), wall_clock(datetime(1970, 1, 1))


def to_instant(wall_clock: Column) -> Column:
    instant_epoch, wall_epoch = _epochs()
    return instant_epoch + (wall_clock - wall_epoch)


def to_wall_clock(instant: Column) -> Column:
    instant_epoch, wall_epoch = _epochs()
    return wall_epoch + (instant - instant_epoch)


def closed_hours(views: DataFrame, delay: str = "1 minute") -> DataFrame:
    """`video_id, hour_bucket, count` of a stream in append mode."""
    return (
        views.select("video_id", to_instant(F.col("ts")).alias("instant"))
        .withWatermark("instant", delay)
        .groupBy(F.window("instant", "1 hour").alias("hour"), "video_id")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            "video_id",
            hour_text_of(to_wall_clock(F.col("hour.start"))).alias("hour_bucket"),
            "count",
        )
    )


@contextmanager
def state_on_disk(spark: SparkSession):
    """Open hours live in RocksDB, not on the heap; a query takes the setting when it starts."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def start_closed_hours(
    views: DataFrame, path: str, checkpoint: str, trigger: dict, delay: str = "1 minute"
) -> StreamingQuery:
    """Write closed hours to Parquet under `path`, exactly once.

    The first start fixes the number of state partitions to spark.sql.shuffle.partitions.
    """
    with state_on_disk(views.sparkSession):
        return (
            closed_hours(views, delay)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )


def open_hours(spark: SparkSession, checkpoint: str) -> DataFrame:
    """`video_id, hour_bucket, count` of the hours that `start_closed_hours` has not closed yet.

    Reads the state of the last finished micro-batch: with the closed hours, every view that was on time is in
    exactly one of the two. No rows before a micro-batch has finished.
    """
    state = spark.read.format("statestore").load(checkpoint)
    hour = to_wall_clock(F.col("key.window.start"))
    return state.select(F.col("key.video_id").alias("video_id"), hour_text_of(hour).alias("hour_bucket"), "value.count")
