"""Every registered query against its SQL on the smallest tables, and its plan."""

from __future__ import annotations

import os
import re

import duckdb
import pytest

from __spark_entry__ import NOW, entry, library_queries, library_sql
from check_queries import compare
from conftest import rows
from viewrank.functions.text import ISO_ANY_FORM, ISO_TIMESTAMP
from viewrank.operators import timeframes
from viewrank.session import new_work_folder
from viewrank.sources.store import TierStore

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# What these return is read from what they stored or published, so no view is scanned.
PUBLISHED = ("serve_top_videos", "store_topk_snapshot", "store_topk_snapshot_later", "store_runs_topk", "store_levelled_tiers")
STREAMS = [name for name in library_queries() if name.startswith("stream_")]


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for table in ("events", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", ["topk_snapshot", "counts_last_hour", "upsert_fold", "stream_late_views", "stream_closed_hours"])
def test_the_session_zone_plays_no_part(spark, tables, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        report = compare(spark, tables, SF_DIR, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert ": ok" in report, report


def test_every_query_has_sql():
    assert set(library_queries()) == set(library_sql())


@pytest.mark.parametrize("name", list(library_queries()))
def test_query_gives_the_rows_of_its_sql(spark, tables, name):
    report = compare(spark, tables, SF_DIR, name)
    assert ": ok" in report, report


def test_entry(spark):
    assert entry(spark).columns == ["rank", "video_id", "count"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [name for name in library_queries() if name not in STREAMS])
def test_plan_has_no_python_and_no_all_pairs_join(spark, name):
    plan = plan_of(library_queries()[name](spark, SF_DIR))
    for unwanted in ("Python", "Pandas", "BroadcastNestedLoopJoin", "CartesianProduct", "ExistingRDD"):
        assert unwanted not in plan
    if name not in PUBLISHED:
        assert "PushedFilters: [IsNotNull(" in plan or name in ("shard_assignment", "ingest_valid_views", "ingest_rejects")


@pytest.mark.parametrize("name", ["topk_last_hour", "topk_last_day", "topk_last_month", "bulk_topk_month"])
def test_timeframe_reaches_the_scan(spark, name):
    plan = plan_of(library_queries()[name](spark, SF_DIR))
    assert "GreaterThanOrEqual(" in plan and "LessThanOrEqual(" in plan
    assert "TakeOrderedAndProject" in plan


def test_four_timeframes_take_one_scan_and_one_shuffle_of_counts(spark):
    plan = plan_of(library_queries()["topk_snapshot"](spark, SF_DIR))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning(video_id") == 1
    assert plan.count("WindowGroupLimit") == 4  # partial and final, per shard and per timeframe


def test_a_request_is_parsed_once(spark):
    for name in ("ingest_valid_views", "ingest_rejects"):
        plan = plan_of(library_queries()[name](spark, SF_DIR))
        assert plan.count("from_json(") == 1 and plan.count("RLIKE(") == 2
        for pattern in (ISO_TIMESTAMP, ISO_ANY_FORM):
            assert len(re.findall(r"RLIKE\(\w+#\d+, " + re.escape(pattern), plan)) == 1


def test_only_needed_columns_are_read(spark):
    plan = plan_of(library_queries()["topk_all_time"](spark, SF_DIR))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


@pytest.mark.parametrize("name", ["topk_snapshot", "stream_hour_counts", "stream_closed_hours", "stream_late_views"])
def test_a_table_of_many_files_in_any_order_gives_the_same_rows(spark, tmp_path_factory, name):
    folder = str(tmp_path_factory.mktemp("many"))
    spark.read.parquet(f"{SF_DIR}/events.parquet").repartition(7).write.parquet(f"{folder}/events.parquet")
    assert rows(library_queries()[name](spark, folder)) == rows(library_queries()[name](spark, SF_DIR))


def test_stored_tiers_are_pruned_by_tier_and_bucket(spark):
    store = TierStore(spark, new_work_folder(spark, "plan"))
    store.write_delta(0, library_queries()["hour_counts"](spark, SF_DIR))
    store.compact(NOW)
    plan = plan_of(timeframes.counts_last_day(store.tiers().hour, NOW))
    assert "(tier" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "GreaterThanOrEqual(bucket," in plan
    # Nothing pending: the union with the deltas is gone, and one shuffle is left.
    assert "Union" not in plan and plan.count("Exchange") == 1
