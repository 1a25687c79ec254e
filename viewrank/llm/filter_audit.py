"""What five filters remove in every order of applying them.

Each document is reduced to the set of filters that it fails, and documents of one part with the same
set are one weighted cell: at most 32 cells a part, however many documents there are. A cell is then
folded along each of the 120 orders with `transform` and `aggregate`; the orders are a literal of the plan.
The 600 weighted structs of a cell are merged with those of the other cells by elementwise sums.

A null text is an empty one. A null language and an empty one are the same part. Filter E asks for an
equal text under a smaller id anywhere in the table: rows that repeat an id and its text do not fail by
each other, and a row without an id neither fails E nor makes others fail. Texts are equal if their
SHA-256 is. A document has a label if any row of the labels gives it; labels of null ids count for
nothing. An empty table has no parts, so no rows. Only the named columns are read.

A text with a third of all copies costs no hot task: rows are dealt by id first, and counted per text
and task before they are dealt by text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewrank.llm.common import batch, in_batches

FILTERS = "ABCDE"
BIT = {letter: 1 << place for place, letter in enumerate(FILTERS)}
ORDERS = ["".join(order) for order in permutations(FILTERS)]
# What a cell adds to a step of an order.
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_LONG = "bigint"

SYMBOLS = (b"#", b"$", b"%", b"&", b"*", b"|")
BLANK = re.compile(rb"[\x20\x09-\x0D]")
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
# Bytes that go on with a code point in UTF-8.
CONTINUATION = bytes(range(0x80, 0xC0))
# Words are cut out of so many bytes at a time.
BYTES_AT_ONCE = 4_000_000
JUDGED = pa.schema(
    [("doc_id", pa.int64()), ("part", pa.string()), ("same_text", pa.binary()), ("mask", pa.int32())]
)


def _zero() -> Column:
    return F.lit(0).cast(_LONG)


def _counted_words(text: bytes) -> tuple[int, int]:
    """Words and different words; `bytes.split` parts at the same six blanks as the contract's pattern."""
    n, distinct, at = 0, set(), 0
    while at < len(text):
        blank = BLANK.search(text, at + BYTES_AT_ONCE)
        end = blank.start() if blank else len(text)
        words = text[at:end].split()
        n += len(words)
        distinct.update(words)
        at = end
    return n, len(distinct)


def text_failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words, distinct = _counted_words(text)
    code_points = len(text.translate(None, CONTINUATION))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    fails = {
        "A": words < 100,
        "B": 100 * distinct < 80 * words,
        "C": 100 * capitals > 10 * code_points,
        "D": any(symbol in text for symbol in SYMBOLS),
    }
    return sum(BIT[letter] for letter, failed in fails.items() if failed)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        texts = [text or b"" for text in rows.column("text").to_pylist()]
        yield batch(
            JUDGED,
            doc_id=rows.column("doc_id"),
            part=rows.column("part"),
            same_text=[hashlib.sha256(text).digest() for text in texts],
            mask=[text_failures(text) for text in texts],
        )


def failing_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Weighted cells: `part, mask, n, good, toxic`, one row per part and set of failed filters."""
    texts = docs.select(
        F.col("doc_id").cast(_LONG).alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("part"),
        F.col("text").cast("binary").alias("text"),
    )
    judged = in_batches(texts, _judge, f"doc_id {_LONG}, part string, same_text binary, mask int")
    named = (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(
            F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("is_good"),
            F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("is_toxic"),
        )
    )
    labelled = judged.join(named, "doc_id", "left").na.fill(False, ["is_good", "is_toxic"])
    alike = ["same_text", "part", "mask", "is_good", "is_toxic"]
    one_id = labelled.groupBy("doc_id", *alike).agg(F.count(F.lit(1)).alias("times"))
    has_id = F.col("doc_id").isNotNull()
    one_text = one_id.groupBy(*alike).agg(
        F.sum("times").alias("n"),
        F.min(F.when(has_id, F.struct("doc_id", "times"))).alias("first"),
        F.sum(F.when(has_id, 0).otherwise(F.col("times"))).alias("nameless"),
    )
    # One text has at most four rows a part by now.
    placed = one_text.withColumn("first_id", F.min("first.doc_id").over(Window.partitionBy("same_text")))
    original = F.col("nameless") + F.when(F.col("first.doc_id") == F.col("first_id"), F.col("first.times")).otherwise(0)
    split = F.inline(
        F.array(
            F.struct(F.col("mask"), original.alias("n")),
            F.struct((F.col("mask") + BIT["E"]).alias("mask"), (F.col("n") - original).alias("n")),
        )
    )
    rows = placed.select("part", "is_good", "is_toxic", split).filter(F.col("n") > 0)
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("is_good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def _cell_steps(mask: Column, n: Column, good: Column, toxic: Column) -> Column:
    """The 600 structs of one cell: each order folded from its first filter to its last."""
    bit_of = F.create_map(*[F.lit(x) for letter in FILTERS for x in (letter, BIT[letter])])
    letters = F.array(*[F.lit(place) for place in range(1, len(FILTERS) + 1)])

    def fold(order: Column) -> Column:
        def step(state: Column, place: Column) -> Column:
            bit = bit_of[F.substr(order, place, F.lit(1))]
            fails, gone = mask.bitwiseAND(bit) > 0, state["gone"]
            removed = fails & ~gone
            amounts = {
                "kept": F.when(~gone & ~fails, n),
                "removed": F.when(removed, n),
                "redundant": F.when(fails & gone, n),
                "unique_fails": F.when(mask == bit, n),
                "good_lost": F.when(removed, good),
                "toxic_lost": F.when(removed, toxic),
            }
            row = F.struct(*[amounts[name].otherwise(_zero()).alias(name) for name in COUNTS])
            return F.struct((gone | fails).alias("gone"), F.concat(state["rows"], F.array(row)).alias("rows"))

        none = F.array().cast(f"array<struct<{','.join(f'{name}:{_LONG}' for name in COUNTS)}>>")
        start = F.struct(F.lit(False).alias("gone"), none.alias("rows"))
        return F.aggregate(letters, start, step, lambda state: state["rows"])

    return F.flatten(F.transform(F.lit(ORDERS), fold))


def _added(left: Column, right: Column) -> Column:
    return F.struct(*[(left[name] + right[name]).alias(name) for name in COUNTS])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`part, filter_order, step` and the counts, `shapley` among them: 600 rows per part."""
    cells = failing_sets(docs, labels).select(
        "part", _cell_steps(F.col("mask"), F.col("n"), F.col("good"), F.col("toxic")).alias("steps")
    )
    # At most 32 cells a part, so the list is bounded by its construction.
    listed = cells.groupBy("part").agg(F.collect_list("steps").alias("cells"))
    nothing = F.struct(*[_zero().alias(name) for name in COUNTS])
    merged = F.aggregate(
        "cells",
        F.array_repeat(nothing, len(ORDERS) * len(FILTERS)),
        lambda total, cell: F.zip_with(total, cell, _added),
    )
    keys = F.lit([f"{order}{step}" for order in ORDERS for step in range(1, len(FILTERS) + 1)])
    rows = listed.select("part", F.inline(F.arrays_zip(keys.alias("key"), merged.alias("count")))).select(
        "part",
        F.substring("key", 1, len(FILTERS)).alias("filter_order"),
        F.substring("key", len(FILTERS) + 1, 1).cast("int").alias("step"),
        "count.*",
    )
    letter = F.substr("filter_order", "step", F.lit(1))
    over_orders = Window.partitionBy("part", letter)  # 120 rows
    return rows.select("part", "filter_order", "step", *COUNTS, F.sum("removed").over(over_orders).alias("shapley"))
