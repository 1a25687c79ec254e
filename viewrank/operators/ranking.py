"""Exact top-K in one total order: count descending, then video id ascending."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewrank.functions.shards import shard_of
from viewrank.operators.summaries import merged
from viewrank.schema import MAX_K, check_length


def best_first() -> list[Column]:
    return [F.col("count").desc(), F.col("video_id").asc()]


def top_k(counts: DataFrame, k: int = MAX_K) -> DataFrame:
    """First k rows with their rank. The limit comes first, so the rank sees k rows at most."""
    check_length(k)
    best = counts.orderBy(*best_first()).limit(k)
    return best.select(
        F.row_number().over(Window.orderBy(*best_first())).alias("rank"), "video_id", "count"
    )


def top_k_per_shard(counts: DataFrame, k: int = MAX_K) -> DataFrame:
    """First k rows of every shard. Each task cuts its rows to k per shard before the shuffle.

    Spark does so for any k that a list may have.
    """
    check_length(k)
    by_shard = Window.partitionBy("shard").orderBy(*best_first())
    return (
        counts.withColumn("shard", shard_of(F.col("video_id")))
        .withColumn("rank", F.row_number().over(by_shard))
        .filter(F.col("rank") <= k)
        .select("shard", "rank", "video_id", "count")
    )


def merge_top_k(per_shard: DataFrame, k: int = MAX_K) -> DataFrame:
    """Global first k from the lists of the shards. A video lives in one shard: no merging of rows."""
    return top_k(per_shard.select("video_id", "count"), k)


# Candidate ids are broadcast up to this size; beyond it Spark joins them as it sees fit.
BROADCAST_BYTES = 32_000_000


@dataclass(frozen=True)
class CountedRuns:
    """Counts above zero that are to be added up, `video_id, count`.

    `runs` have one row per id each; `known` holds rows of them, each once: the first MAX_K of every run at least.
    `pending` may have several rows per id; `summaries` are those of its batches (see `summaries`).
    """

    runs: list[DataFrame]
    known: DataFrame
    pending: DataFrame | None = None
    summaries: DataFrame | None = None


def _added_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy("video_id").agg(F.sum("count").alias("count"))


def _only(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the ids; their size decides whether they are broadcast."""
    size = ids.agg(F.coalesce(F.sum(F.octet_length("video_id") + 16), F.lit(0))).first()[0]
    return rows.join(F.broadcast(ids) if size <= BROADCAST_BYTES else ids, "video_id", "left_semi")


@contextmanager
def top_k_of_runs(counted: CountedRuns, k: int = MAX_K) -> Iterator[DataFrame]:
    """First k rows of the sums, adding up only ids that can be among them, ties included.

    Sums of known rows are lower bounds, so the k-th of them bounds the answer's last count from below; an id that
    reaches it has an n-th part of it in one of the n relations at least. Such ids are the candidates: in a run, a
    filter on the stored count finds them without a shuffle; in pending rows, their summaries list them if what they
    leave open is less than that part, otherwise the pending rows are added up. The exact sums of candidates
    take a semi-join before the shuffle. The answer is to be used inside the `with`, where candidates are kept.
    """
    check_length(k)
    with ExitStack() as kept:
        runs, known, pending, listed = counted.runs, counted.known, counted.pending, None
        if pending is not None and counted.summaries is not None:
            listed = kept.enter_context(merged(counted.summaries))
            first = listed.ids.orderBy(F.desc("estimate"), "video_id").limit(2 * k).select("video_id")
            known = known.unionByName(_added_up(pending.join(F.broadcast(first), "video_id", "left_semi")))
        elif pending is not None:
            runs, pending = [*runs, _added_up(pending)], None
            known = known.unionByName(runs[-1])
        relations = len(runs) + (pending is not None)
        best = _added_up(known).orderBy(*best_first()).limit(k).agg(F.count(F.lit(1)), F.min("count")).first()
        # Fewer than k known ids prove nothing: then every id is a candidate.
        least = -(-best[1] // relations) if best[0] == k else 1
        if listed is not None and listed.unlisted >= least:
            runs, pending = [*runs, _added_up(pending)], None
        able = [run.filter(F.col("count") >= least).select("video_id") for run in runs]
        if pending is not None:
            able.append(listed.ids.filter(F.col("estimate") >= least).select("video_id"))
        if not able:
            yield top_k(known, k)
        elif len(runs) == 1 and pending is None:
            yield top_k(runs[0].filter(F.col("count") >= least), k)
        else:
            ids = reduce(DataFrame.unionByName, able).distinct().persist()
            kept.callback(ids.unpersist)
            rows = reduce(DataFrame.unionByName, [*runs, *([] if pending is None else [pending])])
            yield top_k(_added_up(_only(rows, ids)), k)
