"""All four top-K lists in one pass, and how they are served.

Computing the lists one by one would read the tiers once per timeframe. Here every row carries
what it adds to each timeframe, so one shuffle on video_id counts all of them, and one small
shuffle ranks them: each task sends on at most MAX_K rows per timeframe and shard.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewrank.clock import Clock, day_text, hour_text
from viewrank.functions.buckets import wall_clock
from viewrank.functions.shards import shard_of
from viewrank.operators.counting import Tiers
from viewrank.operators.ranking import best_first, top_k_of_runs
from viewrank.operators.timeframes import closed_days_of_month, hours_of_today
from viewrank.schema import MAX_K, TIMEFRAMES, check_k, check_length, check_timeframe
from viewrank.sources.store import TierStore
from viewrank.sources.views import views_between

# Column -> (timeframe, preference within the timeframe). Last hour has two candidates: the
# running hour, and the previous one for shards without a row in the running hour.
_SLOTS = {
    "running_hour": ("last hour", 0),
    "previous_hour": ("last hour", 1),
    "last_day": ("last day", 0),
    "last_month": ("last month", 0),
    "all_time": ("all time", 0),
}


def _row(amount: Column, **conditions: Column | bool) -> list[Column]:
    """`video_id` and, for every slot, `amount` where its condition holds."""
    zero = F.lit(0).cast("bigint")
    columns = []
    for slot in _SLOTS:
        condition = conditions.get(slot, False)
        if condition is True:
            value = amount
        elif condition is False:
            value = zero
        else:
            value = F.when(condition, amount).otherwise(zero)
        columns.append(value.alias(slot))
    return [F.col("video_id"), *columns]


def slots_from_views(views: DataFrame, clock: Clock) -> DataFrame:
    def since(start: datetime) -> Column:
        return F.col("ts") >= wall_clock(start)

    running = since(clock.hour_start)
    return views_between(views, None, clock.as_of).select(
        *_row(
            F.lit(1).cast("bigint"),
            running_hour=running,
            previous_hour=since(clock.previous_hour_start) & ~running,
            last_day=since(clock.last_day_start),
            last_month=since(clock.last_month_start),
            all_time=True,
        )
    )


def slots_from_recent(hours: DataFrame, days: DataFrame, clock: Clock) -> DataFrame:
    """Slots of all timeframes but all time."""
    hour, count = F.col("hour_bucket"), F.col("count")
    recent = hours.filter(hour >= hour_text(clock.last_day_start)).select(
        *_row(
            count,
            running_hour=hour == hour_text(clock.hour_start),
            previous_hour=hour == hour_text(clock.previous_hour_start),
            last_day=True,
            last_month=hour.startswith(day_text(clock.today_start) + "-"),
        )
    )
    closed = closed_days_of_month(days, clock).select(*_row(count, last_month=True))
    return recent.unionByName(closed)


def slots_from_tiers(tiers: Tiers, clock: Clock) -> DataFrame:
    totals = tiers.all_time.select(*_row(F.col("count"), all_time=True))
    return slots_from_recent(tiers.hour, tiers.day, clock).unionByName(totals)


def rank_slots(slots: DataFrame, k: int = MAX_K) -> DataFrame:
    """`timeframe, rank, video_id, count` for all timeframes."""
    check_length(k)
    counted = slots.groupBy("video_id").agg(*[F.sum(slot).alias(slot) for slot in _SLOTS])
    candidates = F.array(
        *[
            F.struct(
                F.lit(timeframe).alias("timeframe"),
                F.lit(preference).alias("preference"),
                F.col(slot).alias("count"),
            )
            for slot, (timeframe, preference) in _SLOTS.items()
        ]
    )
    rows = (
        counted.withColumn("shard", shard_of(F.col("video_id")))  # before the rows multiply
        .select("video_id", "shard", F.inline(candidates))
        .filter(F.col("count") > 0)
        .select("timeframe", "preference", "shard", "video_id", "count")
    )
    return rank_candidates(rows, k)


def rank_candidates(rows: DataFrame, k: int, *more: str) -> DataFrame:
    """Lists per timeframe, and per value of further columns, from counts above zero.

    Rows are `timeframe, preference, shard, video_id, count`; a shard gives its preferred candidates only.
    """
    # A list per timeframe and shard, preferred candidate first; each task sends k rows of each.
    shard = Window.partitionBy(*more, "timeframe", "shard")
    place = F.row_number().over(shard.orderBy("preference", *best_first()))
    lists = rows.withColumn("place_in_shard", place).filter(F.col("place_in_shard") <= k)
    preferred = F.min("preference").over(shard)
    kept = lists.withColumn("preferred", preferred).filter(F.col("preference") == F.col("preferred"))
    in_timeframe = Window.partitionBy(*more, "timeframe").orderBy(*best_first())
    return (
        kept.withColumn("rank", F.row_number().over(in_timeframe))
        .filter(F.col("rank") <= k)
        .select(*more, "timeframe", "rank", "video_id", "count")
    )


def replay_snapshot(views: DataFrame, clock: Clock) -> DataFrame:
    return rank_slots(slots_from_views(views, clock))


def refresh_snapshot(store: TierStore, clock: Clock) -> int:
    """Rank what is stored at `as_of` and publish; call it after a flush or from any timer.

    Its cost follows the recent buckets and the pending deltas: all-time counts are scanned, but only those
    of ids that can be among the first are shuffled and added up.
    """
    recent = store.recent(clock)
    lists = rank_slots(slots_from_recent(recent.hour, recent.day, clock))
    with top_k_of_runs(recent.all_time) as best:
        of_all_time = best.select(F.lit("all time").alias("timeframe"), "rank", "video_id", "count")
        return store.publish(lists.unionByName(of_all_time), clock, recent.batch_id)


def top_videos(snapshot: DataFrame, timeframe: str, k: int) -> DataFrame:
    """The first k published rows of one timeframe. Reads the snapshot only."""
    check_timeframe(timeframe)
    check_k(k)
    wanted = (F.col("timeframe") == timeframe) & (F.col("rank") <= k)
    return snapshot.filter(wanted).select(
        "timeframe", F.lit(k).alias("k"), "rank", "video_id", "count"
    )


def _videos() -> Column:
    """A list of at most MAX_K rows in rank order, without the rank."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "video_id", "count")))
    return F.transform(ranked, lambda row: F.struct(row["video_id"], row["count"]))


_NO_VIDEOS = "array<struct<video_id:string,count:bigint>>"


def top_videos_response(snapshot: DataFrame, timeframe: str, k: int) -> DataFrame:
    """One row `timeframe, k, videos`; videos is empty if nothing was published."""
    videos = top_videos(snapshot, timeframe, k).agg(_videos().alias("videos"))
    return videos.select(F.lit(timeframe).alias("timeframe"), F.lit(k).alias("k"), "videos")


def snapshot_documents(snapshot: DataFrame) -> DataFrame:
    """One JSON document per timeframe: `key, payload`. A timeframe without rows gives `[]`."""
    labels = F.array(
        *[
            F.struct(F.lit(label).alias("timeframe"), F.lit(f"topk:{name}").alias("key"))
            for label, name in TIMEFRAMES.items()
        ]
    )
    keys = snapshot.sparkSession.range(0, 1, 1, 1).select(F.inline(labels))
    lists = snapshot.groupBy("timeframe").agg(_videos().alias("videos"))
    payload = F.to_json(F.coalesce("videos", F.array().cast(_NO_VIDEOS)))
    return keys.join(lists, "timeframe", "left").select("key", payload.alias("payload"))


def read_documents(documents: DataFrame) -> DataFrame:
    """`key, videos`: the inverse of `snapshot_documents`."""
    return documents.select("key", F.from_json("payload", _NO_VIDEOS).alias("videos"))
