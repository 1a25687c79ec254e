"""Time buckets as text: ``2024-01-30-12``, ``2024-01-30``, ``2024-01``.

Text order is time order and a coarser bucket is a prefix of a finer one. Everything here works
on the wall clock of a TIMESTAMP_NTZ column, so the session time zone plays no part (date_format
would go through it and shift times that fall into a daylight-saving gap).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(moment: datetime) -> Column:
    """A naive datetime as TIMESTAMP_NTZ. `lit(datetime)` would pass through two time zones."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def hour_text_of(ts: Column) -> Column:
    return join_hour(F.to_date(ts), F.hour(ts))


def day_text_of(ts: Column) -> Column:
    return F.to_date(ts).cast("string")


def join_hour(day: Column, hour: Column) -> Column:
    return F.concat(day.cast("string"), F.lit("-"), F.lpad(hour.cast("string"), 2, "0"))


def day_of(bucket: Column) -> Column:
    return F.substring(bucket, 1, 10)


def month_of(bucket: Column) -> Column:
    return F.substring(bucket, 1, 7)
