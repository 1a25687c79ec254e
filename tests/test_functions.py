from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from viewrank.clock import Clock
from viewrank.functions.buckets import hour_text_of
from viewrank.functions.shards import shard_of
from viewrank.functions.text import parse_timestamp, strip_whitespace

GOOD_TIMES = {
    "2024-06-01T14:32:00": "2024-06-01-14",
    "2024-06-01 14:32": "2024-06-01-14",
    "2024-06-01": "2024-06-01-00",
    "2024-06-01T23:30:00-07:00": "2024-06-01-23",
    "2024-06-01T23:30:00Z": "2024-06-01-23",
    "2024-06-01T14:32:00+05:30": "2024-06-01-14",
    "2024-06-01T14:32:00+05:30:15": "2024-06-01-14",
    "2024-06-01T14": "2024-06-01-14",
    "2024-06-01T14-07:00": "2024-06-01-14",
    "2024-06-01x14:32:00": "2024-06-01-14",
    "2024-06-01Z14:32:00": "2024-06-01-14",
    "2024-06-01-14:32:00": "2024-06-01-14",
    "2024-06-01T14:32:00.1": "2024-06-01-14",
    "2024-06-01T14:32:00.123456789": "2024-06-01-14",
    "0999-01-01T05": "0999-01-01-05",
    "20240601T143200": "2024-06-01-14",
    "20240601T143200Z": "2024-06-01-14",
    "20240601": "2024-06-01-00",
    "2024-W22-6": "2024-06-01-00",
    "2024-06-01T1432": "2024-06-01-14",
    "2024-06-01T143200": "2024-06-01-14",
    "2024-06-01T14:32:00,5": "2024-06-01-14",
    "2024-06-01T14:32:00+0530": "2024-06-01-14",
    "2024-06-01T14:32:00+05": "2024-06-01-14",
}
BAD_TIMES = [
    "2024-06", "2024", "2024-6-1", "+2024-06-01", " 2024-06-01T14:32:00 ", "2024-02-30", "14:32",
    "now", "epoch", "", "2024-06-01T24:00:00", "2024-W54-1", "2024-W53-1", "2024-W22-8", "2024-W00-1",
    "2024-06-01T14:3200", "2024-06-01T14:32:00+25:00", "0000-01-01",
    "2024-06-01T14:60", "2024-06-01T", "2024-06-01T14:32:00\n",
]


def test_times_are_parsed_and_offsets_dropped(spark):
    df = spark.createDataFrame([(t,) for t in [*GOOD_TIMES, *BAD_TIMES]], "t STRING")
    got = dict(rows(df.select("t", hour_text_of(parse_timestamp(F.col("t"))).alias("h")).na.fill("")))
    assert got == {**GOOD_TIMES, **dict.fromkeys(BAD_TIMES, "")}


def test_times_agree_with_python(spark):
    dates = ["2024-06-01", "20240601", "2024-W22", "2024W22", "2024-W22-6", "2024W226", "2020-W53-7", "2021-W53-1",
             "2024-13-01", "20240230", "2024-0601", "202406-01", "2024-W226", "2024W22-6", "0001-01-01"]
    times = ["", "T", "T14", "T1432", "T14:32", "T143200", "T14:32:00", "T14:32:00.5", "T14:32:00,1234567", "T143200.25",
             "T1432:00", "T14:3200", "T25", "T14:60", "T14:32:60", "T1", " 14:32", "x143200,5"]
    offsets = ["", "Z", "+05", "-0530", "+05:30", "+053015", "+05:30:15", "+05:30:15.5", "+05:3015", "+24:00", "+5", "+", "z"]
    # Left out, as they are refused here: a lone digit before an offset ("T143+05"), which Python reads over,
    # and a fraction of minutes ("T14:32.5"), which Python takes for one of seconds.
    texts = [d + t + o for d in dates for t in times for o in offsets]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = dict(rows(df.select("t", parse_timestamp(F.col("t")))))

    def expected(text):
        try:
            return datetime.fromisoformat(text).replace(tzinfo=None)
        except ValueError:
            return None

    assert {t: (got[t], expected(t)) for t in texts if got[t] != expected(t)} == {}


def test_fraction_is_cut_to_microseconds(spark):
    df = spark.createDataFrame([("2024-06-01T14:32:00.123456789",)], "t STRING")
    assert df.select(parse_timestamp(F.col("t"))).first()[0] == datetime(2024, 6, 1, 14, 32, 0, 123456)


def test_strip_removes_what_python_strips(spark):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    texts = [f"{s}a {s}b{s}{s}" for s in spaces] + ["".join(spaces), "\u200bx"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = df.select("t", strip_whitespace(F.col("t")).alias("s")).collect()
    assert len(spaces) == 29
    assert [row.s for row in got] == [row.t.strip() for row in got]


def test_shards_match_md5(spark):
    ids = [f"vid_{i}" for i in range(2000)] + ["", "é", "视频"]
    df = spark.createDataFrame([(i,) for i in ids], "video_id STRING")
    got = dict(df.select("video_id", shard_of(F.col("video_id"))).collect())
    assert got == {i: int(hashlib.md5(i.encode()).hexdigest(), 16) % 10 for i in ids}
    golden = {1: 1, 2: 2, 3: 9, 4: 0, 5: 4, 6: 3, 7: 3, 8: 7, 9: 4, 10: 7}
    assert {i: got[f"vid_{i}"] for i in golden} == golden


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_buckets_do_not_depend_on_the_session_zone(spark, zone):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00' AS ts")  # a gap in Los Angeles
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert df.select(hour_text_of(F.col("ts"))).first()[0] == "2024-03-10-02"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_clock_boundaries():
    clock = Clock(datetime(2024, 3, 1, 0, 5))
    assert clock.previous_hour_start == datetime(2024, 2, 29, 23)
    assert clock.last_day_start == datetime(2024, 2, 29, 0)
    assert clock.last_month_start == datetime(2024, 1, 31)
    assert (clock.keep_hours_from, clock.keep_days_from) == ("2024-02-29-00", "2024-01-30")
    with pytest.raises(ValueError):
        Clock(datetime.fromisoformat("2024-03-01T00:05:00+00:00"))
