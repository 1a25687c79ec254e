"""Approximate nearest neighbours by a hash-prefix forest.

Vectors are dealt into blocks of about `block_size`. For each block, every tree hashes its vectors to long
bit strings (signs of random projections of the centred vectors) and keeps them sorted, so that all
strings with a common prefix lie together. A query descends each tree to the longest prefix it shares
with any string, then all trees ascend together, one bit shorter at a time, and what the wider
prefixes take in becomes a candidate, until there are enough. Candidates are ranked by exact distance
in double precision, and the best of all blocks are merged.

Every vector is indexed and every query is put to every block, block by block. Equal vectors are
indexed once, under their smallest ids: with k neighbours asked for, k + 1 of them can matter.
Vectors of one block and `queries_at_once` queries are in memory at a time.

In high dimensions without structure no hash finds true neighbours among few candidates, so the
number of candidates is a share of the block (`share`); what it gives is measured in the tests.

Vectors that are null or zero, hold nulls or numbers that are not finite, or differ in length from
the most frequent length (ties to the shorter), take no part; nor do null ids. Repeated ids count
once if their vectors agree, else each of their vectors is a candidate and a query.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewrank.llm.common import in_batches, kept_table

TREES = 16
BITS = 64
BLOCK_SIZE = 8192
SHARE = 0.6
NEIGHBOURS = 10
QUERIES_AT_ONCE = 2000
SEED = 7


def usable(vectors: DataFrame) -> DataFrame:
    """`vec_id, vector` (doubles) for the vectors that take part."""
    own = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).filter(
        "vec_id is not null and vector is not null and size(vector) > 0 and "
        "forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and "
        "exists(vector, x -> x != 0)"
    )
    lengths = own.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").limit(1)
    row = lengths.first()
    return own.filter(F.size("vector") == (row["length"] if row else 0)).distinct()


class Forest:
    """Sorted hash strings of some vectors, one array per tree."""

    def __init__(self, vectors: np.ndarray, planes: np.ndarray, centre: np.ndarray):
        self.planes, self.centre = planes, centre
        hashes = self._hash(vectors)
        self.order = np.argsort(hashes, axis=1, kind="stable")
        self.hashes = np.take_along_axis(hashes, self.order, axis=1)

    def _hash(self, vectors: np.ndarray) -> np.ndarray:
        """Strings of `BITS` bits as numbers, by tree and vector: order of numbers is order of strings."""
        bits = np.einsum("nd,tdb->tnb", vectors - self.centre, self.planes, optimize=True) > 0
        return np.packbits(bits, axis=2).view(">u8")[:, :, 0].astype(np.uint64)

    def candidates(self, queries: np.ndarray, enough: int) -> Iterator[np.ndarray]:
        """Places of the candidates of each query."""
        asked = self._hash(queries)
        count = self.hashes.shape[1]
        for q in range(len(queries)):
            ranges = []
            for length in range(BITS, -1, -1):  # ascend: the same prefix length in all trees
                drop = np.uint64(BITS - length)
                found = []
                for tree in range(len(self.hashes)):
                    if length == 0:
                        found.append((0, count))
                        continue
                    low = (asked[tree, q] >> drop) << drop
                    high = low | ((np.uint64(1) << drop) - np.uint64(1))
                    at = np.searchsorted(self.hashes[tree], low, "left"), np.searchsorted(self.hashes[tree], high, "right")
                    found.append(at)
                ranges = found
                if sum(b - a for a, b in found) >= enough:
                    seen = np.zeros(count, dtype=bool)
                    for tree, (a, b) in enumerate(ranges):
                        seen[self.order[tree, a:b]] = True
                    if length == 0 or seen.sum() >= enough:
                        yield np.flatnonzero(seen)
                        break
        return


def _search_block(asked, neighbours: int, trees: int, share: float):
    """The best neighbours of each query within one block."""

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        ids, queries = asked.value
        vectors = np.stack(rows["vector"].to_numpy())
        rng = np.random.default_rng(SEED)
        planes = rng.normal(size=(trees, vectors.shape[1], BITS))
        forest = Forest(vectors, planes, vectors.mean(axis=0))
        copies = rows["ids"].to_numpy()
        enough = min(len(rows), max(20 * neighbours, int(share * len(rows))))
        out = []
        for q, some in enumerate(forest.candidates(queries, enough)):
            distance = np.sqrt(((vectors[some] - queries[q]) ** 2).sum(axis=1))
            # Enough different vectors for k neighbours though one of them may be the query alone; ties included.
            if len(some) > neighbours + 1:
                limit = np.partition(distance, neighbours)[neighbours]
                near = np.flatnonzero(distance <= limit)
            else:
                near = np.arange(len(some))
            found = [(d, int(i)) for d, c in zip(distance[near], copies[some[near]], strict=True) for i in c if i != ids[q]]
            out += [(int(ids[q]), i, d) for d, i in sorted(found)[:neighbours]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    return search


def neighbours_of(
    vectors: DataFrame,
    every: int,
    neighbours: int = NEIGHBOURS,
    trees: int = TREES,
    share: float = SHARE,
    block_size: int = BLOCK_SIZE,
    queries_at_once: int = QUERIES_AT_ONCE,
) -> DataFrame:
    """`query_id, rank, vec_id, score` for the vectors whose id is divisible by `every`, against all others.

    Nearest first, ties to the smaller id. Fewer than `neighbours` rows only if there are fewer vectors.
    """
    spark = vectors.sparkSession
    own = kept_table(usable(vectors), "vectors")
    ranked = own.withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id")))
    different = (
        ranked.filter(F.col("place") <= neighbours + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # k + 1 at most
    )
    different = kept_table(different, "different-vectors")
    blocks = max(1, -(-different.count() // block_size))
    blocked = different.withColumn("block", F.pmod(F.xxhash64("vector"), F.lit(blocks)).cast("int"))
    queries = own.filter(F.col("vec_id") % every == 0)
    groups = max(1, -(-queries.count() // queries_at_once))
    numbered = queries.withColumn("part", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(groups)).cast("int"))
    numbered = kept_table(numbered, "queries")
    best = None
    for group in range(groups):
        table = numbered.filter(F.col("part") == group).toPandas()  # about queries_at_once rows
        if not len(table):
            continue
        asked = spark.sparkContext.broadcast((table["vec_id"].to_numpy(), np.stack(table["vector"].to_numpy())))
        found = blocked.groupBy("block").applyInPandas(
            _search_block(asked, neighbours, trees, share), "query_id long, vec_id long, score double"
        )
        best = found if best is None else best.unionByName(found)
    if best is None:
        best = spark.createDataFrame([], "query_id long, vec_id long, score double")
    once = best.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        once.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= neighbours)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
