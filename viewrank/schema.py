"""Table shapes and constants shared by every module."""

from __future__ import annotations

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# They decide results, so they must not vary between jobs.
NUM_SHARDS = 10
MAX_K = 100
KEEP_HOURS = 24
KEEP_DAYS = 31
TIMEFRAMES = {
    "last hour": "last_hour",
    "last day": "last_day",
    "last month": "last_month",
    "all time": "all_time",
}


def _counted(*keys: str) -> StructType:
    fields = [StructField(key, StringType(), False) for key in keys]
    return StructType([*fields, StructField("count", LongType(), False)])


VIEW = StructType(
    [
        StructField("video_id", StringType(), False),
        StructField("ts", TimestampNTZType(), False),
    ]
)

# Tier name -> key columns. A tier row adds `count` views to its key.
TIER_KEYS = {
    "hour": ("video_id", "hour_bucket"),
    "day": ("video_id", "day_bucket"),
    "month": ("video_id", "month_bucket"),
    "all_time": ("video_id",),
}
TIER_SCHEMA = {tier: _counted(*keys) for tier, keys in TIER_KEYS.items()}
BUCKET_COLUMN = {"hour": "hour_bucket", "day": "day_bucket", "month": "month_bucket"}

# A published row. batch_id is the last micro-batch it reflects, NULL for a replay of a table.
SNAPSHOT = StructType(
    [
        StructField("timeframe", StringType(), False),
        StructField("rank", IntegerType(), False),
        StructField("video_id", StringType(), False),
        StructField("count", LongType(), False),
        StructField("as_of", TimestampNTZType(), False),
        StructField("batch_id", LongType(), True),
    ]
)


def check_timeframe(timeframe: str) -> str:
    if timeframe not in TIMEFRAMES:
        raise ValueError(f"Unknown timeframe {timeframe!r}; choose one of {sorted(TIMEFRAMES)}")
    return timeframe


def check_length(k: int) -> None:
    """A list holds at most MAX_K rows, so that no task ranks an unbounded one."""
    if not 1 <= k <= MAX_K:
        raise ValueError(f"a list holds 1 to {MAX_K} rows, not {k}")


def check_k(k: int) -> int:
    """The served length: 1 to MAX_K - 1."""
    if isinstance(k, bool) or not isinstance(k, int) or not 1 <= k < MAX_K:
        raise ValueError(f"k must be a whole number from 1 to {MAX_K - 1}, got {k!r}")
    return k
