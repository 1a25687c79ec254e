"""Mergeable summaries of the most viewed ids of a batch, with what they leave open.

A summary is Spark's frequent-items state over the views of one batch; summaries of several batches merge
without reading a view. An estimate is never below the true count. An id that a merged summary does not list
has at most `unlisted` views: twice the sketch's largest error, which is 3.5 over the size of its map per view, or the
smallest listed estimate if the list was cut at its length.
"""

from __future__ import annotations

from contextlib import contextmanager
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Ids that a summary tracks: with 10,000, an unlisted id has at most 0.043 % of the views.
TRACKED = 10_000
# Fixed values of the sketch: its map is a power of two, filled to three quarters, and errs by so much of the
# stream over the size of the map.
_FILLED, _ERROR = 0.75, 3.5


@dataclass(frozen=True)
class Listed:
    """`video_id, estimate` of the listed ids, at most as many as are tracked, and a bound for all others."""

    ids: DataFrame
    unlisted: float


def summarize(views: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """One row: `state, views`."""
    state = F.expr(f"approx_top_k_accumulate(video_id, {int(tracked)})")
    return views.agg(state.alias("state"), F.count(F.lit(1)).alias("views"))


def _map_size(tracked: int) -> int:
    return 1 << max(0, int(tracked / _FILLED + 1 - 1e-9) - 1).bit_length()


@contextmanager
def merged(summaries: DataFrame) -> Iterator[Listed]:
    """What the summaries of several batches say together; the list is kept inside the `with`."""
    tracked = summaries.agg(F.min("state.maxItemsTracked")).first()[0]
    together = summaries.agg(F.expr("approx_top_k_combine(state)").alias("state"), F.sum("views").alias("views"))
    items = F.expr(f"approx_top_k_estimate(state, {int(tracked)})")
    listed = together.select("views", items.alias("items")).persist()
    try:
        bounds = listed.select("views", F.size("items").alias("n"), F.array_min("items.count").alias("least")).first()
        unlisted = 2 * _ERROR / _map_size(tracked) * bounds["views"]
        if bounds["n"] >= tracked:
            unlisted = max(unlisted, bounds["least"])
        ids = listed.select(F.inline("items")).toDF("video_id", "estimate")
        yield Listed(ids, unlisted)
    finally:
        listed.unpersist()
