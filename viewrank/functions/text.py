"""Cleaning of the two request fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_OFFSET = r"(?:Z|[+-](?:[01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d(?:[.,]\d+)?)?|[0-5]\d(?:[0-5]\d(?:[.,]\d+)?)?)?)?"

# The usual form: date, then any one separator, time down to the hour at least, optional offset.
ISO_TIMESTAMP = (
    r"(?s)\A(?!0000)\d{4}-\d{2}-\d{2}(?:.\d{2}(?::\d{2}(?::\d{2}(?:\.\d+)?)?)?" + _OFFSET + r")?\z"
)
# All forms: dates without hyphens and week dates (group 1), times without colons, comma fractions.
# A digit after a week date's hyphen is the day only if no further digit follows.
ISO_ANY_FORM = (
    r"(?s)\A(?!0000)(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(?:-\d(?!\d))?|\d{4}W\d{2}(?:\d(?!\d))?)"
    r"(?:.(\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?|\d{2}(?:\d{2}(?:[.,]\d+)?)?)?)" + _OFFSET + r")?\z"
)


def strip_whitespace(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def parse_timestamp(text: Column) -> Column:
    """ISO 8601 text as TIMESTAMP_NTZ, or NULL. The wall clock is kept, a UTC offset is dropped.

    A cast alone would take `2024`, `2024-6-1` or padded text, so the shape is checked first; the
    cast then refuses impossible dates and times. Forms other than the usual one are brought into it.
    """
    clock = F.substring(text, 12, 2**31 - 1)
    for mark in ("Z", "+", "-"):
        clock = F.substring_index(clock, mark, 1)
    day = F.substring(text, 1, 10)
    whole = F.when(F.length(text) == 10, day).otherwise(F.concat(day, F.lit("T"), clock))
    return (
        F.when(text.rlike(ISO_TIMESTAMP), whole.try_cast("timestamp_ntz"))
        .when(text.rlike(ISO_ANY_FORM), _from_other_form(text).try_cast("timestamp_ntz"))
    )


def _from_other_form(text: Column) -> Column:
    """The usual form of a text that matches `ISO_ANY_FORM`; NULL for a week that its year lacks."""
    date = F.translate(F.regexp_extract(text, ISO_ANY_FORM, 1), "-", "")
    clock = F.replace(F.replace(F.regexp_extract(text, ISO_ANY_FORM, 2), F.lit(":"), F.lit("")), F.lit(","), F.lit("."))
    calendar = F.concat_ws("-", F.substring(date, 1, 4), F.substring(date, 5, 2), F.substring(date, 7, 2))
    week = F.substring(date, 6, 2).try_cast("int")
    weekday = F.coalesce(F.substring(date, 8, 1).try_cast("int"), F.lit(1))
    first_monday = F.trunc(F.concat(F.substring(date, 1, 4), F.lit("-01-04")).try_cast("date"), "week")
    monday = F.date_add(first_monday, (week - 1) * 7)
    of_week = F.when(
        (F.weekofyear(monday) == week) & weekday.between(1, 7),
        F.date_add(monday, weekday - 1).cast("string"),
    )
    day = F.when(F.substring(date, 5, 1) == "W", of_week).otherwise(calendar)
    parts = [F.rpad(F.substring(clock, at, 2), 2, "0") for at in (1, 3, 5)]
    return F.concat(day, F.lit("T"), F.concat_ws(":", *parts), F.substring(clock, 7, 2**31 - 1))
