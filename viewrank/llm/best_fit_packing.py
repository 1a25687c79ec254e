"""Conflict-constrained best-fit packing of documents into bins of a fixed number of words.

No bin holds two documents of one source or of one duplicate cluster (by default: equal texts). A
document longer than a bin is cut into pieces; full pieces fill a bin each, the rest is packed.

Documents are dealt into shards of about `shard_size` rows by a hash, so a hot source or cluster is
spread evenly and no task holds more than a shard. Within a shard, pieces are taken from long to
short; open bins are ordered by their free space and carry bitmaps of their sources and clusters. The
search starts at the tightest bin with room and goes on to its successors until one has no conflict.

A null or empty text has no words and takes no space, but a place. A null source or text conflicts
with nothing. Repeated rows are packed like others, each into a bin of its own.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewrank.llm.common import as_bytes, in_batches, kept_table

CAPACITY = 2048
SHARD_SIZE = 8192
# Room for bin numbers of one shard.
BINS_PER_SHARD = 2**32

_PACKED = "doc_id long, piece int, first_word long, n_words long, bin_id long, place int, source string, cluster long"


class Bins:
    """Open bins of one shard, ordered by free space."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []  # (free space, bin)
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.members: list[int] = []

    def put(self, words: int, source: int, cluster: int) -> tuple[int, int]:
        """The tightest compatible bin, or a new one, and the place in it. Source and cluster are one-bit maps."""
        for i in range(bisect_left(self.order, (words, -1)), len(self.order)):
            free, number = self.order[i]
            if not (self.sources[number] & source or self.clusters[number] & cluster):
                del self.order[i]
                break
        else:
            free, number = self.capacity, len(self.members)
            self.sources.append(0), self.clusters.append(0), self.members.append(0)
        self.sources[number] |= source
        self.clusters[number] |= cluster
        self.members[number] += 1
        insort(self.order, (free - words, number))
        return number, self.members[number] - 1


def _pack_shard(capacity: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        rows = rows.sort_values(["n_words", "doc_id", "cluster", "piece"], ascending=[False, True, True, True])
        bins, bits = Bins(capacity), {"source": {}, "cluster": {}}

        def bit(kind: str, value) -> int:
            if pd.isna(value):
                return 0
            known = bits[kind]
            return 1 << known.setdefault(value, len(known))

        found = [
            bins.put(words, bit("source", source), bit("cluster", cluster))
            for words, source, cluster in zip(
                rows["n_words"].tolist(), rows["source"].tolist(), rows["cluster"].tolist(), strict=True
            )
        ]
        rows["bin_id"] = [shard * BINS_PER_SHARD + number for number, _ in found]
        rows["place"] = [place for _, place in found]
        return rows.drop(columns="shard")

    return pack


def sizes(docs: DataFrame) -> DataFrame:
    """`doc_id, source, cluster, n_words`; the cluster is the hash of the text."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("source", pa.string()), ("cluster", pa.int64()), ("n_words", pa.int64())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for part in batches:
            words = [len((text or b"").split()) for text in part.column("text").to_pylist()]
            columns = [part.column("doc_id"), part.column("source"), part.column("cluster"), pa.array(words, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    cluster = F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("cluster")
    texts = as_bytes(docs, "source", cluster)
    return in_batches(texts, count, "doc_id long, source string, cluster long, n_words long")


def pack(sized: DataFrame, capacity: int = CAPACITY, shard_size: int = SHARD_SIZE) -> DataFrame:
    """One row per piece of `sized` (`doc_id, source, cluster, n_words`): its bin, its place there and its words.

    `bin_id` is unique over all shards; `first_word` counts from zero.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    sized = kept_table(sized, "sizes")
    pieces = sized.select(
        "*", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n_words") / capacity).cast("int") - 1, F.lit(0)))).alias("piece")
    ).select(
        "doc_id",
        "piece",
        (F.col("piece").cast("long") * capacity).alias("first_word"),
        F.least(F.lit(capacity).cast("long"), F.col("n_words") - F.col("piece").cast("long") * capacity).alias("n_words"),
        "source",
        "cluster",
    )
    shards = max(1, -(-pieces.count() // shard_size))
    # The row's place in the written table is in the hash, so that repeated rows spread too.
    spread = F.xxhash64("doc_id", "cluster", "piece", F.monotonically_increasing_id())
    return (
        pieces.withColumn("shard", F.pmod(spread, F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInPandas(_pack_shard(capacity), _PACKED)
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, shard_size: int = SHARD_SIZE) -> DataFrame:
    return pack(sizes(docs), capacity, shard_size)
