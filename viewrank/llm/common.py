"""What several operators share: text as bytes, tables in the shared folder, sorted groups, hashes.

A document is identified by `doc_id` and the hash of its text, so rows with a null or a repeated
id keep apart; identical repeated rows are one identity and get the same result. Only the columns
an operator needs are selected first; where all columns are kept, they travel as one struct (`packed`),
so further columns of any name cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewrank.session import new_work_folder

# A batch for Python holds at most this many rows, so long texts stay bounded in memory.
ROWS_PER_BATCH = 1000
# Words whose hash a task remembers; the memory is emptied when full.
REMEMBERED_WORDS = 400_000
# Words that are hashed or counted at once.
WORDS_AT_ONCE = 500_000


def _bound_batches(rows: DataFrame) -> None:
    key, session = "spark.sql.execution.arrow.maxRecordsPerBatch", rows.sparkSession
    if not 0 < int(session.conf.get(key)) <= ROWS_PER_BATCH:
        session.conf.set(key, str(ROWS_PER_BATCH))


def in_batches(rows: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterable], schema: str) -> DataFrame:
    """`mapInArrow` with small batches."""
    _bound_batches(rows)
    return rows.mapInArrow(function, schema)


def as_bytes(docs: DataFrame, *more: Column | str) -> DataFrame:
    """`doc_id, text_hash, text` (as bytes) and more columns."""
    return docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"), *more
    )


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """Writes to the shared folder and reads back: computed once, and lost executors cost nothing."""
    folder = new_work_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def same(left: DataFrame, right: DataFrame, *columns: str) -> Column:
    """Join condition on columns of the same names, nulls equal."""
    return reduce(Column.__and__, [left[c].eqNullSafe(right[c]) for c in columns])


def packed(docs: DataFrame) -> DataFrame:
    """`doc_id, text_hash, row`: documents with all their columns in one, whatever these are called."""
    every = F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns))
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), every.alias("row"))


def batch(schema: str | pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch from arrays or lists."""
    return pa.RecordBatch.from_pydict(columns, schema=schema)


def replaced_text(
    docs: DataFrame, found: DataFrame, column: str, cut: Callable[[bytes, list], bytes]
) -> DataFrame:
    """Documents with all their columns, the text cut by what `found` (`doc_id, text_hash`, `column`) has for it.

    `n_chars` follows where there is such a column. Rows that `found` does not name stay as they are.
    """
    marked = packed(docs)
    named = found.select(
        F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"), F.col(column).alias("cut")
    )
    own = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash"))

    @F.arrow_udf("string")
    def cut_text(texts: pa.Array, cuts: pa.Array) -> pa.Array:
        out = [
            None if text is None else (cut(text, by) if by else text).decode()
            for text, by in zip(texts.to_pylist(), cuts.to_pylist(), strict=True)
        ]
        return pa.array(out, pa.string())

    _bound_batches(docs)
    text = F.col("row").getField("text").cast("binary")
    joined = marked.join(named, own, "left").withColumn("kept", cut_text(text, F.col("cut")))
    changed = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        length = F.length("kept").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("cut").isNull(), F.col("row").getField("n_chars")).otherwise(length)
    return joined.select(*(changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], at_least: int
) -> Iterator[pa.Table]:
    """Tables of whole groups, cut from rows that are sorted by `keys`; each holds `at_least` rows or is the last.

    Rows of one group never fall into two tables. Memory: `at_least` rows and the largest group.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for part in batches:
        if not part.num_rows:
            continue
        held.append(part)
        rows += part.num_rows
        if rows < at_least:
            continue
        table = pa.Table.from_batches(held)
        starts = group_starts(table, keys)
        if len(starts) == 1:
            held = table.to_batches()
            continue
        last = int(starts[-1])
        yield table.slice(0, last)
        held = table.slice(last).to_batches()
        rows = table.num_rows - last
    if rows:
        yield pa.Table.from_batches(held)


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a new group of sorted, non-null number columns starts."""
    changed = np.zeros(table.num_rows, dtype=bool)
    changed[:1] = True
    for key in keys:
        values = table.column(key).to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changed)


class WordHashes(dict):
    """Word -> 64-bit hash, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 7)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class RangeHashes:
    """Hashes of any ranges of a sequence of 64-bit values, in constant time each.

    hash(l, r) = sum of x[j] * a^(l-j) for l <= j < r, modulo 2^64: equal sequences get equal
    hashes wherever they stand.
    """

    def __init__(self, values: np.ndarray):
        n = len(values)
        down = np.full(n + 1, _INVERSE, dtype=np.uint64)
        up = np.full(n + 1, _FACTOR, dtype=np.uint64)
        down[0] = up[0] = 1
        self.up = np.cumprod(up)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * np.cumprod(down)[:n], out=self.sums[1:])

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (self.sums[right] - self.sums[left]) * self.up[left]
