"""Hours of a stream with nothing lost: closed once they are final, late where a view comes after that, else open.

`closed_hours` drops views of hours that its watermark has passed. Here every view is in exactly one of three
counts. An hour is open until the watermark reaches its end and is given out as closed then; a view that arrives
when the watermark has reached the end of its hour is given out at once as late. So closed rows are final, one for
an id and hour, and what came too late for them can be added or looked at apart.

Built-in aggregation has no output for what it drops, so the state is kept by hand: ids of an hour are dealt into
`slots`, each with a list of counts that micro-batches append to, and a timer at the end of the hour that adds the list
up. A call of the state is made per hour and slot, not per id, and appending reads nothing. Arrow batches are counted
before the shuffle, so an id with a third of all views is one row per hour and batch of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from viewrank.functions.buckets import hour_text_of
from viewrank.streaming.closed_hours import state_on_disk, to_instant, to_wall_clock

CLOSED, LATE, OPEN = "closed", "late", "open"
_HOUR_SECONDS = 3600
SLOTS = 256


# What runs in tasks is made inside functions, so it travels with the job: workers need no copy of this package.


def _counter():
    def count(batches):
        import pyarrow as pa

        keys = ["slot", "hour_end", "video_id"]
        for batch in batches:
            counted = pa.Table.from_batches([batch]).group_by(keys).aggregate([([], "count_all")])
            yield from counted.rename_columns([*keys, "count"]).to_batches()

    return count


def _settler(closed: str, late: str) -> StatefulProcessor:
    class Settler(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.open = handle.getListState("open", "video_id STRING, count LONG")

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            counted = self.added_up(pd.concat([part[["video_id", "count"]] for part in rows]))
            if key[1] <= timerValues.getCurrentWatermarkInMs():
                yield self.given_out(late, key, counted)
                return
            ids = [None if pd.isna(video_id) else video_id for video_id in counted["video_id"]]
            self.open.appendList(list(zip(ids, map(int, counted["count"]))))
            # Timers go off when the watermark is past them, hours are closed when it has reached their end.
            self.handle.registerTimer(key[1] - 1)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            import pandas as pd

            held = pd.DataFrame(list(self.open.get()), columns=["video_id", "count"])
            yield self.given_out(closed, key, self.added_up(held))
            self.open.clear()

        def added_up(self, counts):
            return counts.groupby("video_id", dropna=False, as_index=False)["count"].sum()

        def given_out(self, fate, key, counted):
            whole = counted.assign(fate=fate, hour_end=key[1])
            return whole[["fate", "video_id", "hour_end", "count"]]

        def close(self):
            pass

    return Settler()


def _hour_bucket(end: str):
    """Bucket text of the hour that ends at so many milliseconds since the epoch."""
    start = F.timestamp_seconds(F.expr(f"{end} div 1000 - {_HOUR_SECONDS}"))
    return hour_text_of(to_wall_clock(start)).alias("hour_bucket")


def settled_hours(views: DataFrame, delay: str = "1 minute", slots: int = SLOTS) -> DataFrame:
    """`fate, video_id, hour_bucket, count` of a stream in append mode; fate is closed or late.

    `slots` bounds what a task holds of an hour: its ids over `slots`. It must stay the same for a checkpoint.
    Late rows are one per id, hour and micro-batch. Null ids are an id of their own; a view without a time is none.
    """
    seconds = F.unix_seconds("instant")
    timed = views.filter(F.col("ts").isNotNull()).select("video_id", to_instant(F.col("ts")).alias("instant"))
    marked = timed.withWatermark("instant", delay)
    hours = marked.select(
        F.pmod(F.xxhash64("video_id"), F.lit(slots)).alias("slot"),
        ((seconds - F.pmod(seconds, F.lit(_HOUR_SECONDS)) + _HOUR_SECONDS) * 1000).alias("hour_end"),
        "video_id",
    )
    counted = hours.mapInArrow(_counter(), "slot LONG, hour_end LONG, video_id STRING, count LONG")
    # The counted rows have no column with a watermark: Spark would drop the late ones by it before they get here.
    settled = counted.groupBy("slot", "hour_end").transformWithStateInPandas(
        _settler(CLOSED, LATE), "fate STRING, video_id STRING, hour_end LONG, count LONG", "append", "eventTime"
    )
    return settled.select("fate", "video_id", _hour_bucket("hour_end"), "count")


def start_settled_hours(
    views: DataFrame, path: str, checkpoint: str, trigger: dict, delay: str = "1 minute", slots: int = SLOTS
) -> StreamingQuery:
    """Write closed hours and late views to Parquet under `path`, a folder per fate, exactly once.

    The first start fixes the number of state partitions to spark.sql.shuffle.partitions.
    """
    with state_on_disk(views.sparkSession):
        return (
            settled_hours(views, delay, slots)
            .writeStream.format("parquet")
            .partitionBy("fate")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )


def hours_by_fate(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """`fate, video_id, hour_bucket, count`: closed, late and open hours; together every view that was read.

    Late and open counts are added up, so a fate has one row for an id and hour. Open hours come from the state of the last
    finished micro-batch.
    """
    names = ["fate", "video_id", "hour_bucket"]
    written = spark.read.schema("video_id STRING, hour_bucket STRING, count LONG, fate STRING").parquet(path)
    state = spark.read.format("statestore").option("stateVarName", "open").load(checkpoint)
    held = state.select(
        F.lit(OPEN).alias("fate"),
        F.col("list_element.video_id").alias("video_id"),
        F.col("key.hour_end").alias("hour_end"),
        F.col("list_element.count").alias("count"),
    )
    every = written.select(*names, "count").unionByName(held.select("fate", "video_id", _hour_bucket("hour_end"), "count"))
    return every.groupBy(*names).agg(F.sum("count").alias("count"))
