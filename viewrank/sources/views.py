"""View rows `(video_id, ts)` from tables and streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from viewrank.functions.buckets import wall_clock
from viewrank.functions.text import strip_whitespace


def views_from(table: DataFrame, item: str, ts: str, prefix: str = "") -> DataFrame:
    """Views from the id and time columns of any table; other columns are never read.

    A row without id or time is no view; both checks are on stored columns, so they reach the
    scan. A text id is stripped, as that of a request is, and must not be empty then. The time keeps its
    wall clock: TIMESTAMP_NTZ is taken as it is, others are cast. `refused_from` has the other rows.
    """
    own = _item_text(table, item)
    video_id = F.concat(F.lit(prefix), own) if prefix else own
    stored = table.filter(F.col(item).isNotNull() & F.col(ts).isNotNull())
    named = stored.filter(F.length(own) > 0) if _is_text(table, item) else stored
    return named.select(video_id.alias("video_id"), F.col(ts).cast("timestamp_ntz").alias("ts"))


def refused_from(table: DataFrame, item: str, ts: str) -> DataFrame:
    """Rows that `views_from` does not take: their `reason`, id and time as text."""
    reason = (
        F.when(F.col(item).isNull(), "missing_video_id")
        .when(F.length(_item_text(table, item)) == 0, "empty_video_id")
        .when(F.col(ts).isNull(), "missing_timestamp")
    )
    rows = table.select(
        reason.alias("reason"), F.col(item).cast("string").alias("video_id"), F.col(ts).cast("string").alias("ts")
    )
    return rows.filter(F.col("reason").isNotNull())


def _is_text(table: DataFrame, item: str) -> bool:
    return isinstance(table.schema[item].dataType, StringType)


def _item_text(table: DataFrame, item: str) -> Column:
    return strip_whitespace(F.col(item)) if _is_text(table, item) else F.col(item).cast("string")


def views_between(views: DataFrame, start: datetime | None, as_of: datetime) -> DataFrame:
    """Views from `start` up to `as_of`. Compares the stored time, so Parquet can skip row groups."""
    until = views.filter(F.col("ts") <= wall_clock(as_of))
    if start is None:
        return until
    return until.filter(F.col("ts") >= wall_clock(start))


def stream_table(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    """Parquet files under `path` (a glob is fine) as a stream, `max_files` new ones per batch.

    Without `max_files` a batch takes every file that has arrived.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_requests(
    spark: SparkSession, source: str, options: dict[str, str], path: str | None = None
) -> DataFrame:
    """Request bodies as a stream with one `body` column.

    `source` is a streaming format with a `value` column: `text` for files of one body per line
    (bound a batch with maxFilesPerTrigger), `kafka` where its connector is on the class path
    (bound a batch with maxOffsetsPerTrigger; key the topic by video id).
    """
    stream = spark.readStream.format(source).options(**options).load(path)
    return stream.select(F.col("value").cast("string").alias("body"))
