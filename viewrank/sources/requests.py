"""View requests: JSON bodies to view rows, with the refused bodies kept apart.

Only column expressions, so the same functions serve a table and a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewrank.functions.text import parse_timestamp, strip_whitespace

# Both fields must be JSON strings. A STRING schema would turn 5 or {"a": 1} into text, so the
# fields are read as VARIANT, which keeps the JSON type. The body is read as the one element of an
# array, because the parser stops after the first value and would not see text that follows it.
_BODY_SCHEMA = "ARRAY<STRUCT<videoId VARIANT, timestamp VARIANT>>"
_JSON_OPTIONS = {"allowSingleQuotes": "false"}
_JSON_SPACE = " \t\r\n"


def _json_string(value: Column) -> Column:
    return F.when(F.schema_of_variant(value) == "STRING", F.variant_get(value, "$", "string"))


def check_requests(requests: DataFrame, body: str = "body") -> DataFrame:
    """`video_id, ts, reason, body`; reason is NULL for a good request.

    Checked in this order: fields missing or not text, id empty once stripped, bad timestamp.
    """
    listed = F.concat(F.lit("["), F.col(body), F.lit("]"))
    parsed = requests.select(
        F.col(body).alias("body"), F.from_json(listed, _BODY_SCHEMA, _JSON_OPTIONS).alias("parsed")
    )
    one_object = (F.size("parsed") == 1) & F.rtrim("body", F.lit(_JSON_SPACE)).endswith("}")
    request = parsed.select("body", F.when(one_object, F.get("parsed", F.lit(0))).alias("request"))
    fields = request.select(
        "body",
        strip_whitespace(_json_string(F.col("request.videoId"))).alias("video_id"),
        _json_string(F.col("request.timestamp")).alias("timestamp"),
    )
    read = fields.select("body", "video_id", "timestamp", parse_timestamp(F.col("timestamp")).alias("ts"))
    reason = (
        F.when(F.col("video_id").isNull() | F.col("timestamp").isNull(), "malformed_body")
        .when(F.length("video_id") == 0, "empty_video_id")
        .when(F.col("ts").isNull(), "bad_timestamp")
    )
    return read.select("video_id", "ts", reason.alias("reason"), "body")


def _rows_where(checked: DataFrame, condition: Column, *columns: str) -> DataFrame:
    """`filter(condition).select(columns)`, as a generator of one row or none.

    The optimizer would push a filter below the parsing and write the parsing out again for each
    use of its result: 18 parses of every body instead of one. It leaves a generator in place.
    """
    return checked.select(F.inline(F.when(condition, F.array(F.struct(*columns)))))


def valid_views(checked: DataFrame) -> DataFrame:
    return _rows_where(checked, F.col("reason").isNull(), "video_id", "ts")


def rejects(checked: DataFrame) -> DataFrame:
    return _rows_where(checked, F.col("reason").isNotNull(), "reason", "body")


def count_rejects(checked: DataFrame) -> DataFrame:
    return rejects(checked).groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))


def parse_requests(requests: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(valid views, rejects)."""
    checked = check_requests(requests, body)
    return valid_views(checked), rejects(checked)
