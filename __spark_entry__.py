"""Registered queries over the given tables, each with the SQL that must give the same rows.

Views come from `events` (video `vid_<user_id>` at `ts`) and, in bulk, from `lineitem`
(video `part_<l_partkey>` at `l_shipdate`).
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import partial
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewrank.clock import Clock, day_text, hour_text
from viewrank.functions.buckets import wall_clock
from viewrank.functions.shards import shard_of
from viewrank.operators import counting, monitor, ranking, rollup, timeframes
from viewrank.operators.summaries import TRACKED
from viewrank.plans import replay, series, snapshot
from viewrank.session import new_work_folder
from viewrank.sources import requests
from viewrank.sources.store import TierStore
from viewrank.sources.views import stream_requests, stream_table, views_between, views_from
from viewrank.streaming.closed_hours import open_hours, start_closed_hours
from viewrank.streaming.settled_hours import hours_by_fate, start_settled_hours
from viewrank.streaming.view_counts import start_request_counts, start_view_counts

NOW = Clock(datetime(2024, 1, 30, 12, 45))
HOUR_AGO = Clock(NOW.as_of - timedelta(hours=1))
HOUR_LATER = Clock(NOW.as_of + timedelta(hours=1))
FEBRUARY = Clock(datetime(2024, 2, 5, 12, 45))
BULK_NOW = Clock(datetime(1998, 6, 15, 12, 45))
DELTA_START = datetime(2024, 1, 20, 10, 30)
# The views of this day reach the stream after all others.
LATE_FROM, LATE_UNTIL = datetime(2024, 1, 8), datetime(2024, 1, 9)
FILES_PER_BATCH = 1000
# Over midnight, from the first hour that the last day reaches.
SERIES_HOURS = 24

Query = Callable[[SparkSession, str], DataFrame]


# Inputs


def event_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_views(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _as_views(events: DataFrame) -> DataFrame:
    return views_from(events, "user_id", "ts", prefix="vid_")


def part_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return views_from(lineitem, "l_partkey", "l_shipdate", prefix="part_")


def event_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a request body; six of ten kinds carry one kind of dirt each."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind, user = F.col("event_id") % 10, F.col("user_id").cast("string")
    video, time = F.concat(F.lit("vid_"), user), F.col("ts").cast("string")
    video_id = (
        F.when(kind == 0, F.lit("\t \u00a0"))
        .when(kind == 2, F.concat(F.lit("\u3000 "), video, F.lit("\n")))
        .otherwise(video)
    )
    timestamp = (
        F.when(kind == 1, F.concat(F.lit("2024-02-30"), F.substring(time, 11, 20)))
        .when(kind == 3, F.concat(F.replace(time, F.lit(" "), F.lit("T")), F.lit("-07:00")))
        .when(kind == 4, F.lit(None))
        .otherwise(time)
    )
    body = F.to_json(F.struct(video_id.alias("videoId"), timestamp.alias("timestamp")))
    number = F.concat(F.lit('{"videoId":'), user, F.lit(',"timestamp":"'), time, F.lit('"}'))
    return events.select(F.when(kind == 5, number).otherwise(body).alias("body"))


# Queries


def _views_until(clock: Clock = NOW) -> Query:
    return lambda spark, sf_dir: views_between(event_views(spark, sf_dir), None, clock.as_of)


def _on_views(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(_views_until()(spark, sf_dir))


def _on_counts(plan: Callable[[DataFrame], DataFrame]) -> Query:
    """On all-time counts per video at NOW."""
    return _on_views(lambda views: plan(counting.count_all_time(views)))


def _on_tiers(timeframe: str) -> Query:
    return lambda spark, sf_dir: timeframes.counts_for(
        timeframe, replay.replay_tiers(event_views(spark, sf_dir), NOW, timeframe), NOW
    )


def _counts_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = views_between(event_views(spark, sf_dir), NOW.today_start, NOW.as_of)
    return timeframes.counts_today(replay.hour_rows(views), NOW)


def _top(timeframe: str, clock: Clock = NOW, views: Query = event_views) -> Query:
    return lambda spark, sf_dir: replay.replay_top_k(views(spark, sf_dir), timeframe, clock)


def _snapshot(clock: Clock) -> Query:
    return lambda spark, sf_dir: snapshot.replay_snapshot(event_views(spark, sf_dir), clock)


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.top_k_series(event_views(spark, sf_dir), NOW.last_day_start, SERIES_HOURS)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.snapshot_documents(_snapshot(NOW)(spark, sf_dir))


def _serve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish all four lists, then answer from what was published."""
    store = TierStore(spark, new_work_folder(spark, "serve"))
    store.publish(_snapshot(NOW)(spark, sf_dir), NOW)
    return snapshot.top_videos(store.snapshot(), "last day", 10)


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.merge_top_k(_on_counts(ranking.top_k_per_shard)(spark, sf_dir))


def _roll_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = views_between(event_views(spark, sf_dir), NOW.previous_hour_start, NOW.hour_start)
    return rollup.roll_hour_to_day(replay.hour_rows(views), hour_text(NOW.previous_hour_start))


def _roll_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    yesterday = NOW.today_start - timedelta(days=1)
    views = views_between(event_views(spark, sf_dir), yesterday, NOW.today_start)
    return rollup.roll_day_to_month(replay.day_rows(views), day_text(yesterday))


def _retain_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.retain_hours(counting.count_by_hour(_views_until()(spark, sf_dir)), NOW)


def _retain_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.retain_days(counting.count_by_day(_views_until(FEBRUARY)(spark, sf_dir)), FEBRUARY)


def _upsert(tier: str) -> Query:
    """A base of the views before DELTA_START and a delta of the later ones, in one shuffle."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        views = _views_until()(spark, sf_dir)
        start = wall_clock(DELTA_START)
        parts = [views.filter(F.col("ts") < start), views.filter(F.col("ts") >= start)]
        rows = [counting.as_tier(replay.hour_rows(part), tier) for part in parts]
        return counting.fold(rows, tier)

    return run


def _shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = event_views(spark, sf_dir).select("video_id").distinct()
    return ids.select("video_id", shard_of(F.col("video_id")).alias("shard"))


def _reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    served = _top("all time", HOUR_AGO)(spark, sf_dir)
    return monitor.reconcile(served, _views_until()(spark, sf_dir))


def _valid_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.valid_views(requests.check_requests(event_requests(spark, sf_dir)))


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.count_rejects(requests.check_requests(event_requests(spark, sf_dir)))


# Streams: run until everything that has arrived is processed, then read what they wrote


def _event_stream(spark: SparkSession, sf_dir: str, max_files: int | None) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return _as_views(stream_table(spark, f"{sf_dir}/events*.parquet", schema, max_files))


def _streamed(spark: SparkSession, sf_dir: str, name: str, on_flush=None, tracked=None) -> TierStore:
    store = TierStore(spark, new_work_folder(spark, name))
    views = _event_stream(spark, sf_dir, FILES_PER_BATCH)
    start_view_counts(views, store, {"availableNow": True}, on_flush, tracked).awaitTermination()
    return store


def _stream_tier(tier: str) -> Query:
    return lambda spark, sf_dir: _streamed(spark, sf_dir, f"stream-{tier}").tier(tier)


def _stream_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    def refresh(store: TierStore, batch_id: int) -> None:
        snapshot.refresh_snapshot(store, NOW)

    published = _streamed(spark, sf_dir, "stream-topk", refresh).snapshot()
    return published.select("timeframe", "rank", "video_id", "count")


def _stream_summary_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists from deltas whose summaries name the candidates of all time."""
    store = _streamed(spark, sf_dir, "stream-summary", tracked=TRACKED)
    snapshot.refresh_snapshot(store, NOW)
    return store.snapshot().select("timeframe", "rank", "video_id", "count")


def _store_top(clock: Clock) -> Query:
    """Lists from a base and pending deltas, the last of them late, of the views up to NOW."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = TierStore(spark, new_work_folder(spark, "store-topk"))
        views = _views_until()(spark, sf_dir)
        ts, (start, until) = F.col("ts"), (wall_clock(LATE_FROM), wall_clock(LATE_UNTIL))
        for batch_id, arrival in enumerate((ts < start, ts >= until, (ts >= start) & (ts < until))):
            store.write_delta(batch_id, counting.count_by_hour(views.filter(arrival)))
            if batch_id == 0:
                store.compact(NOW)
        snapshot.refresh_snapshot(store, clock)
        return store.snapshot().select("timeframe", "rank", "video_id", "count")

    return run


# Arrivals in the order of the store's batches; the last one is late.
ARRIVAL_STARTS = (datetime(2024, 1, 14), datetime(2024, 1, 20, 10, 30), datetime(2024, 1, 26), datetime(2024, 1, 29, 6))


def _levelled_store(spark: SparkSession, sf_dir: str, name: str, compactions: int) -> TierStore:
    """Arrivals one by one; the first `compactions` are folded as they come, into runs of two or more levels."""
    store = TierStore(spark, new_work_folder(spark, name))
    views = _views_until()(spark, sf_dir)
    ts, (start, until) = F.col("ts"), (wall_clock(LATE_FROM), wall_clock(LATE_UNTIL))
    late = (ts >= start) & (ts < until)
    bounds = [None, *map(wall_clock, ARRIVAL_STARTS), None]
    arrivals = [
        ~late & (F.lit(True) if low is None else ts >= low) & (F.lit(True) if high is None else ts < high)
        for low, high in pairwise(bounds)
    ]
    for batch_id, arrival in enumerate([*arrivals, late]):
        store.write_delta(batch_id, counting.count_by_hour(views.filter(arrival)))
        if batch_id < compactions:
            store.compact(NOW, fan_out=2)
    return store


def _store_levelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_tiers_of(_levelled_store(spark, sf_dir, "store-levelled", len(ARRIVAL_STARTS) + 2))


def _store_runs_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From three runs of different levels and two pending deltas, one of them late."""
    store = _levelled_store(spark, sf_dir, "store-runs", len(ARRIVAL_STARTS))
    snapshot.refresh_snapshot(store, NOW)
    return store.snapshot().select("timeframe", "rank", "video_id", "count")


def _stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part of the views, a compaction, and the rest from a checkpoint that knows nothing of the first."""
    root = new_work_folder(spark, "stream-restart")
    views = event_views(spark, sf_dir)
    later = F.col("ts") >= wall_clock(DELTA_START)
    for number, part in enumerate((views.filter(~later), views.filter(later))):
        store = TierStore(spark, f"{root}/store")
        store.checkpoint = f"{root}/checkpoint-{number}"
        part.write.parquet(f"{root}/incoming-{number}")
        stream = stream_table(spark, f"{root}/incoming-{number}", views.schema, FILES_PER_BATCH)
        start_view_counts(stream, store, {"availableNow": True}).awaitTermination()
        store.compact(NOW)
    return store.tier("all_time")


def _late_store(spark: SparkSession, sf_dir: str, name: str, compact: bool) -> TierStore:
    """Three arrivals, each followed by a run from the same checkpoint; the last one is late."""
    root = new_work_folder(spark, name)
    store, incoming = TierStore(spark, f"{root}/store"), f"{root}/incoming"
    views = event_views(spark, sf_dir)
    ts = F.col("ts")
    start, until = wall_clock(LATE_FROM), wall_clock(LATE_UNTIL)
    for arrival in (ts < start, ts >= until, (ts >= start) & (ts < until)):
        views.filter(arrival).write.mode("append").parquet(incoming)
        stream = stream_table(spark, incoming, views.schema, FILES_PER_BATCH)
        start_view_counts(stream, store, {"availableNow": True}).awaitTermination()
        if compact:
            store.compact(NOW)
    return store


def _stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_store(spark, sf_dir, "stream-late", compact=False).tier("hour")


def _stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_tiers_of(_late_store(spark, sf_dir, "stream-compacted", compact=True))


def _all_tiers_of(store: TierStore) -> DataFrame:
    stored = store.tiers()
    tiers = [
        counting.fold([getattr(stored, tier)], tier).select(
            F.lit(tier).alias("tier"),
            "video_id",
            F.lit("").alias("bucket") if tier == "all_time" else F.col(f"{tier}_bucket").alias("bucket"),
            "count",
        )
        for tier in ("hour", "day", "month", "all_time")
    ]
    return tiers[0].unionByName(tiers[1]).unionByName(tiers[2]).unionByName(tiers[3])


def _request_store(spark: SparkSession, sf_dir: str, name: str) -> TierStore:
    """The whole write path: bodies as text lines, parsed, refused or counted."""
    root = new_work_folder(spark, name)
    store, incoming = TierStore(spark, f"{root}/store"), f"{root}/incoming"
    event_requests(spark, sf_dir).select(F.col("body").alias("value")).write.text(incoming)
    bodies = stream_requests(spark, "text", {"maxFilesPerTrigger": str(FILES_PER_BATCH)}, incoming)
    start_request_counts(bodies, store, {"availableNow": True}).awaitTermination()
    return store


def _stream_request_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _request_store(spark, sf_dir, "stream-requests").tier("hour")


def _stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = _request_store(spark, sf_dir, "stream-rejects").rejects()
    return refused.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))


def _stream_dated_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refused requests after they were merged into folders per day and their batches deleted."""
    store = _request_store(spark, sf_dir, "stream-dated-rejects")
    store.merge_rejects()
    store.merge_rejects()
    store.clean_up()
    merged = store.dated_rejects().filter(F.col("day").isNotNull())
    return merged.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))


def _stream_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the write path observed in flight, before and after everything was folded."""
    store = _request_store(spark, sf_dir, "stream-observed")
    before = store.observed()
    store.compact(NOW)
    store.merge_rejects()
    store.clean_up()
    told = [{"stage": "batches", **before}, {"stage": "folded", **store.observed()}]
    return spark.createDataFrame(told, "stage STRING, received LONG, valid LONG, refused LONG")


def _closed_store(spark: SparkSession, sf_dir: str, name: str, start_hours=start_closed_hours) -> str:
    """Three arrivals, each counted before the next: the views before the late day, those after it, and
    the late day itself, whose hours are closed by then, so that its views are late."""
    root = new_work_folder(spark, name)
    views = event_views(spark, sf_dir)
    ts, (start, until) = F.col("ts"), (wall_clock(LATE_FROM), wall_clock(LATE_UNTIL))
    for arrival in (ts < start, ts >= until, (ts >= start) & (ts < until)):
        views.filter(arrival).write.mode("append").parquet(f"{root}/in")
        arrived = stream_table(spark, f"{root}/in", views.schema, FILES_PER_BATCH)
        start_hours(arrived, f"{root}/hours", f"{root}/checkpoint", {"availableNow": True}).awaitTermination()
    return root


def _stream_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_closed_store(spark, sf_dir, 'stream-closed')}/hours")


def _stream_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_hours(spark, f"{_closed_store(spark, sf_dir, 'stream-open')}/checkpoint")


def _stream_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed, late and open hours, every view in one of them."""
    # Hundreds of hours of few views each, so few slots.
    root = _closed_store(spark, sf_dir, "stream-settled", partial(start_settled_hours, slots=2))
    return hours_by_fate(spark, f"{root}/hours", f"{root}/checkpoint")


# The operators of training-data pipelines; the library works without them.
_LLM = importlib.util.find_spec("viewrank.llm") and importlib.util.find_spec("corpus_pipeline")
if _LLM:
    import corpus_pipeline
    from viewrank.llm import queries as llm


def _llm_queries() -> dict[str, Query]:
    return {**llm.queries(), "pipeline": corpus_pipeline.run} if _LLM else {}


def _llm_sql() -> dict[str, str]:
    if not _LLM:
        return {}
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**llm.oracle_sql(), **pipeline}


def entry(spark: SparkSession) -> DataFrame:
    """The 100 most viewed videos of all time."""
    return queries()["topk_all_time"](spark, "/root/testdata/sf0.001")


def library_queries() -> dict[str, Query]:
    return {
        # Ingest
        "ingest_valid_views": _valid_views,
        "ingest_rejects": _rejects,
        "shard_assignment": _shards,
        # Tiers
        "hour_counts": _on_views(counting.count_by_hour),
        "day_counts": _on_views(counting.count_by_day),
        "month_counts": _on_views(counting.count_by_month),
        "alltime_counts": _on_views(counting.count_all_time),
        "tier_counts": _on_views(lambda views: counting.all_tiers(counting.count_by_hour(views))),
        "upsert_fold": _upsert("hour"),
        "upsert_fold_alltime": _upsert("all_time"),
        "rollup_hour_to_day": _roll_hour,
        "rollup_day_to_month": _roll_day,
        "retain_hours": _retain_hours,
        "retain_days": _retain_days,
        # Counts per timeframe, from tiers
        "counts_last_hour": _on_tiers("last hour"),
        "counts_last_day": _on_tiers("last day"),
        "counts_today": _counts_today,
        "counts_last_month": _on_tiers("last month"),
        "counts_all_time": _on_tiers("all time"),
        # Top-K
        "topk_last_hour": _top("last hour"),
        "topk_last_day": _top("last day"),
        "topk_last_month": _top("last month"),
        "topk_last_month_feb": _top("last month", FEBRUARY),
        "topk_all_time": _top("all time"),
        "topk_per_shard": _on_counts(ranking.top_k_per_shard),
        "topk_merged": _merged,
        "topk_snapshot": _snapshot(NOW),
        "topk_snapshot_later": _snapshot(HOUR_LATER),
        "topk_series": _series,
        "topk_json": _documents,
        "serve_top_videos": _serve,
        "bulk_topk_month": _top("last month", BULK_NOW, part_views),
        "bulk_topk_all_time": _top("all time", BULK_NOW, part_views),
        # Monitoring
        "shard_load": _on_counts(monitor.shard_load),
        "shard_videos": _on_counts(monitor.shard_videos),
        "view_totals": _on_counts(monitor.view_totals),
        "view_share": _on_counts(monitor.view_share),
        "reconcile_lag": _reconcile,
        # Streams
        "stream_hour_counts": _stream_tier("hour"),
        "stream_alltime": _stream_tier("all_time"),
        "stream_topk": _stream_top,
        "stream_summary_topk": _stream_summary_top,
        "store_topk_snapshot": _store_top(NOW),
        "store_topk_snapshot_later": _store_top(HOUR_LATER),
        "store_levelled_tiers": _store_levelled,
        "store_runs_topk": _store_runs_top,
        "stream_restart_counts": _stream_restart,
        "stream_late_views": _stream_late,
        "stream_compacted_tiers": _stream_compacted,
        "stream_closed_hours": _stream_closed,
        "stream_open_hours": _stream_open,
        "stream_settled_hours": _stream_settled,
        "stream_request_counts": _stream_request_counts,
        "stream_rejects": _stream_rejects,
        "stream_dated_rejects": _stream_dated_rejects,
        "stream_observed_totals": _stream_observed,
    }


def queries() -> dict[str, Query]:
    return {**library_queries(), **_llm_queries()}


# SQL

_SHARD = """(((('0x' || substr(md5(video_id), 1, 16))::UBIGINT % 10) * 6
    + ('0x' || substr(md5(video_id), 17, 16))::UBIGINT % 10) % 10)::INTEGER"""
_HOUR = "strftime(ts, '%Y-%m-%d-%H')"
_DAY = "strftime(ts, '%Y-%m-%d')"
_MONTH = "strftime(ts, '%Y-%m')"
_N = 'count(*)::BIGINT AS "count"'
_BEST = '"count" DESC, video_id'
_RANK = f"row_number() OVER (ORDER BY {_BEST})::INTEGER AS rank"

_CLOSED = "(date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE)"
_LATE = f"(ts >= TIMESTAMP '{LATE_FROM}' AND ts < TIMESTAMP '{LATE_UNTIL}')"


def _sql_views(clock: Clock | None = NOW) -> str:
    where = f" WHERE ts <= TIMESTAMP '{clock.as_of}'" if clock else ""
    return f"SELECT 'vid_' || user_id AS video_id, ts FROM events{where}"


def _sql_parts(clock: Clock) -> str:
    return f"""SELECT 'part_' || l_partkey AS video_id, l_shipdate AS ts FROM lineitem
        WHERE l_shipdate <= TIMESTAMP '{clock.as_of}'"""


def _sql_counts(timeframe: str, clock: Clock = NOW, views: Callable[[Clock], str] = _sql_views) -> str:
    if timeframe == "last hour":
        hours = f"'{hour_text(clock.hour_start)}', '{hour_text(clock.previous_hour_start)}'"
        return f"""SELECT video_id, {_N} FROM (
            SELECT video_id, hour, max(hour) OVER (PARTITION BY {_SHARD}) AS newest
            FROM (SELECT video_id, {_HOUR} AS hour FROM ({views(clock)}))
            WHERE hour IN ({hours})) WHERE hour = newest GROUP BY video_id"""
    where = {
        "last day": f"{_HOUR} >= '{hour_text(clock.last_day_start)}'",
        "today": f"{_DAY} = '{day_text(clock.today_start)}'",
        "last month": f"{_DAY} >= '{day_text(clock.last_month_start)}'",
        "all time": "true",
    }[timeframe]
    return f"SELECT video_id, {_N} FROM ({views(clock)}) WHERE {where} GROUP BY video_id"


def _sql_top(counts: str) -> str:
    return f'SELECT {_RANK}, video_id, "count" FROM ({counts}) ORDER BY {_BEST} LIMIT 100'


def _sql_snapshot(clock: Clock) -> str:
    return _sql_lists(clock, _sql_views)


def _sql_lists(clock: Clock, views: Callable[[Clock], str]) -> str:
    lists = [
        f"SELECT '{timeframe}' AS timeframe, rank, video_id, \"count\" "
        f"FROM ({_sql_top(_sql_counts(timeframe, clock, views))})"
        for timeframe in ("last hour", "last day", "last month", "all time")
    ]
    return " UNION ALL ".join(lists)


def _sql_tier(bucket: str, name: str, clock: Clock | None = NOW, where: str = "true") -> str:
    return f"""SELECT video_id, {bucket} AS {name}, {_N} FROM ({_sql_views(clock)})
        WHERE {where} GROUP BY ALL"""


def _sql_tiers(clock: Clock | None, hours: str = "true", days: str = "true") -> str:
    views = _sql_views(clock)
    parts = [("hour", _HOUR, hours), ("day", _DAY, days), ("month", _MONTH, "true"), ("all_time", "''", "true")]
    return " UNION ALL ".join(
        f"SELECT '{tier}' AS tier, video_id, {bucket} AS bucket, {_N} FROM ({views}) WHERE {where} GROUP BY ALL"
        for tier, bucket, where in parts
    )


_SQL_REQUESTS = r"""
WITH raw AS (
    SELECT event_id % 10 AS kind, user_id, ts::VARCHAR AS t, 'vid_' || user_id AS video FROM events),
bodies AS (
    SELECT CASE kind
        WHEN 4 THEN json_object('videoId', video)
        WHEN 5 THEN json_object('videoId', user_id, 'timestamp', t)
        ELSE json_object(
            'videoId', CASE kind WHEN 0 THEN chr(9) || ' ' || chr(160)
                WHEN 2 THEN chr(12288) || ' ' || video || chr(10) ELSE video END,
            'timestamp', CASE kind WHEN 1 THEN '2024-02-30' || substr(t, 11)
                WHEN 3 THEN replace(t, ' ', 'T') || '-07:00' ELSE t END)
        END AS body FROM raw),
fields AS (
    SELECT CASE WHEN json_type(body, '$.videoId') = 'VARCHAR'
            THEN trim(body ->> '$.videoId', ' ' || chr(9) || chr(10) || chr(160) || chr(12288)) END AS video_id,
        CASE WHEN json_type(body, '$.timestamp') = 'VARCHAR' THEN body ->> '$.timestamp' END AS time_text
    FROM bodies),
checked AS (
    SELECT video_id, ts, CASE WHEN video_id IS NULL OR time_text IS NULL THEN 'malformed_body'
        WHEN video_id = '' THEN 'empty_video_id' WHEN ts IS NULL THEN 'bad_timestamp' END AS reason
    FROM (SELECT *, TRY_CAST(regexp_extract(time_text,
        '^(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d+)?)(Z|[+-]\d{2}:\d{2})?$', 1) AS TIMESTAMP) AS ts
        FROM fields))
"""


def library_sql() -> dict[str, str]:
    all_time = _sql_counts("all time")
    per_shard = f"""SELECT * FROM (
        SELECT shard, row_number() OVER (PARTITION BY shard ORDER BY {_BEST})::INTEGER AS rank, video_id, "count"
        FROM (SELECT *, {_SHARD} AS shard FROM ({all_time}))) WHERE rank <= 100"""
    hour = f"'{hour_text(NOW.previous_hour_start)}'"
    day = f"'{day_text(NOW.today_start - timedelta(days=1))}'"
    return {
        "ingest_valid_views": f"{_SQL_REQUESTS} SELECT video_id, ts FROM checked WHERE reason IS NULL",
        "ingest_rejects": f"""{_SQL_REQUESTS} SELECT reason, count(*)::BIGINT AS row_count
            FROM checked WHERE reason IS NOT NULL GROUP BY reason""",
        "shard_assignment": f"SELECT DISTINCT video_id, {_SHARD} AS shard FROM ({_sql_views(None)})",
        "hour_counts": _sql_tier(_HOUR, "hour_bucket"),
        "day_counts": _sql_tier(_DAY, "day_bucket"),
        "month_counts": _sql_tier(_MONTH, "month_bucket"),
        "alltime_counts": all_time,
        "tier_counts": _sql_tiers(NOW),
        "upsert_fold": _sql_tier(_HOUR, "hour_bucket"),
        "upsert_fold_alltime": all_time,
        "rollup_hour_to_day": _sql_tier(_DAY, "day_bucket", where=f"{_HOUR} = {hour}"),
        "rollup_day_to_month": _sql_tier(_MONTH, "month_bucket", where=f"{_DAY} = {day}"),
        "retain_hours": _sql_tier(_HOUR, "hour_bucket", where=f"{_HOUR} >= '{NOW.keep_hours_from}'"),
        "retain_days": _sql_tier(
            _DAY, "day_bucket", FEBRUARY, where=f"{_DAY} >= '{FEBRUARY.keep_days_from}'"
        ),
        "counts_last_hour": _sql_counts("last hour"),
        "counts_last_day": _sql_counts("last day"),
        "counts_today": _sql_counts("today"),
        "counts_last_month": _sql_counts("last month"),
        "counts_all_time": all_time,
        "topk_last_hour": _sql_top(_sql_counts("last hour")),
        "topk_last_day": _sql_top(_sql_counts("last day")),
        "topk_last_month": _sql_top(_sql_counts("last month")),
        "topk_last_month_feb": _sql_top(_sql_counts("last month", FEBRUARY)),
        "topk_all_time": _sql_top(all_time),
        "topk_per_shard": per_shard,
        "topk_merged": _sql_top(f'SELECT video_id, "count" FROM ({per_shard})'),
        "topk_snapshot": _sql_snapshot(NOW),
        "topk_snapshot_later": _sql_snapshot(HOUR_LATER),
        "topk_series": " UNION ALL ".join(
            f"SELECT '{hour_text(clock.as_of)}' AS hour_bucket, * FROM ({_sql_snapshot(clock)})"
            for clock in series.moments(NOW.last_day_start, SERIES_HOURS)
        ),
        "topk_json": f"""SELECT 'topk:' || replace(timeframe, ' ', '_') AS key,
            '[' || coalesce(string_agg('{{"video_id":"' || video_id || '","count":' || "count" || '}}', ','
                ORDER BY rank), '') || ']' AS payload
            FROM (VALUES ('last hour'), ('last day'), ('last month'), ('all time')) labels(timeframe)
            LEFT JOIN ({_sql_snapshot(NOW)}) USING (timeframe) GROUP BY timeframe""",
        "serve_top_videos": f"""SELECT 'last day' AS timeframe, 10::INTEGER AS k, rank, video_id, "count"
            FROM ({_sql_top(_sql_counts("last day"))}) WHERE rank <= 10""",
        "bulk_topk_month": _sql_top(_sql_counts("last month", BULK_NOW, _sql_parts)),
        "bulk_topk_all_time": _sql_top(_sql_counts("all time", BULK_NOW, _sql_parts)),
        "shard_load": f"""SELECT shards.shard::INTEGER AS shard, count(video_id)::BIGINT AS video_count,
            coalesce(sum("count"), 0)::BIGINT AS view_count
            FROM range(10) shards(shard) LEFT JOIN (SELECT *, {_SHARD} AS owner FROM ({all_time})) counts
            ON shards.shard = counts.owner GROUP BY shards.shard""",
        "shard_videos": f'SELECT {_SHARD} AS shard, video_id, "count" FROM ({all_time})',
        "view_totals": f"""SELECT sum("count")::BIGINT AS total_views, max("count")::BIGINT AS max_views
            FROM ({all_time})""",
        "view_share": f"""SELECT video_id, "count", round(100.0::DOUBLE * "count" / sum("count") OVER (), 1) AS pct
            FROM ({all_time})""",
        "reconcile_lag": f"""SELECT rank, video_id, served, sent, sent - served AS lag,
            CASE WHEN sent = served THEN 'in sync' ELSE '+' || (sent - served) || ' unflushed' END AS status
            FROM (SELECT rank, top.video_id, top."count" AS served, coalesce(now."count", 0)::BIGINT AS sent
                FROM ({_sql_top(_sql_counts("all time", HOUR_AGO))}) top
                LEFT JOIN ({all_time}) now ON top.video_id = now.video_id)""",
        "stream_hour_counts": _sql_tier(_HOUR, "hour_bucket", None),
        "stream_alltime": f"SELECT video_id, {_N} FROM ({_sql_views(None)}) GROUP BY video_id",
        "stream_topk": _sql_lists(NOW, lambda clock: _sql_views(None)),
        "stream_summary_topk": _sql_lists(NOW, lambda clock: _sql_views(None)),
        "store_topk_snapshot": _sql_snapshot(NOW),
        "store_topk_snapshot_later": _sql_lists(HOUR_LATER, lambda clock: _sql_views(NOW)),
        "store_levelled_tiers": _sql_tiers(
            NOW, f"{_HOUR} >= '{NOW.keep_hours_from}'", f"{_DAY} >= '{NOW.keep_days_from}'"
        ),
        "store_runs_topk": _sql_snapshot(NOW),
        "stream_restart_counts": f"SELECT video_id, {_N} FROM ({_sql_views(None)}) GROUP BY video_id",
        "stream_late_views": _sql_tier(_HOUR, "hour_bucket", None),
        "stream_request_counts": f"""{_SQL_REQUESTS} SELECT video_id, {_HOUR} AS hour_bucket, {_N}
            FROM checked WHERE reason IS NULL GROUP BY ALL""",
        "stream_rejects": f"""{_SQL_REQUESTS} SELECT reason, count(*)::BIGINT AS row_count
            FROM checked WHERE reason IS NOT NULL GROUP BY reason""",
        "stream_dated_rejects": f"""{_SQL_REQUESTS} SELECT reason, count(*)::BIGINT AS row_count
            FROM checked WHERE reason IS NOT NULL GROUP BY reason""",
        "stream_observed_totals": f"""{_SQL_REQUESTS} SELECT stage, count(*)::BIGINT AS received,
            count(*) FILTER (reason IS NULL)::BIGINT AS valid, count(*) FILTER (reason IS NOT NULL)::BIGINT AS refused
            FROM checked, (VALUES ('batches'), ('folded')) stages(stage) GROUP BY stage""",
        "stream_compacted_tiers": _sql_tiers(
            None, f"{_HOUR} >= '{NOW.keep_hours_from}'", f"{_DAY} >= '{NOW.keep_days_from}'"
        ),
        "stream_closed_hours": _sql_tier(_HOUR, "hour_bucket", None, f"{_CLOSED} AND NOT {_LATE}"),
        "stream_open_hours": _sql_tier(_HOUR, "hour_bucket", None, f"NOT {_CLOSED} AND NOT {_LATE}"),
        "stream_settled_hours": f"""SELECT CASE WHEN {_LATE} THEN 'late' WHEN {_CLOSED} THEN 'closed' ELSE 'open' END
            AS fate, video_id, {_HOUR} AS hour_bucket, {_N} FROM ({_sql_views(None)}) GROUP BY ALL""",
    }


def oracle_sql() -> dict[str, str]:
    return {**library_sql(), **_llm_sql()}
