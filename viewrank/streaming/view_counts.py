"""Continuous counting: each micro-batch becomes one delta of the store."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from viewrank.operators.counting import count_by_hour
from viewrank.operators.summaries import summarize
from viewrank.sources.requests import check_requests, rejects, valid_views
from viewrank.sources.store import TierStore

logger = logging.getLogger(__name__)

OnFlush = Callable[[TierStore, int], object]
DEFAULT_TRIGGER = {"processingTime": "60 seconds"}


def start_view_counts(
    views: DataFrame,
    store: TierStore,
    trigger: dict | None = None,
    on_flush: OnFlush | None = None,
    tracked: int | None = None,
) -> StreamingQuery:
    """Count a stream of views into `store`.

    No state store: the running totals are the base and the deltas, so late views count in every
    tier however old they are. A failed delta write fails the query, and the restart from the
    checkpoint runs that batch again. `on_flush(store, batch_id)` runs after a batch that counted
    something; if it fails, the error is logged and counting goes on. With `tracked`, each delta gets a
    summary of that many ids: answers then need not add up all pending rows.
    """

    first = store.first_batch()

    def flush(batch: DataFrame, batch_id: int) -> None:
        batch_id += first
        _write_counted(store, batch_id, batch, tracked)
        _after_flush(store, batch_id, on_flush)

    return _start(views, store, trigger, flush)


def start_request_counts(
    requests: DataFrame,
    store: TierStore,
    trigger: dict | None = None,
    on_flush: OnFlush | None = None,
    tracked: int | None = None,
) -> StreamingQuery:
    """Count a stream of request bodies (column `body`); refused ones are kept with their reason."""

    first = store.first_batch()

    def flush(batch: DataFrame, batch_id: int) -> None:
        batch_id += first
        seen = Observation()
        observed = check_requests(batch).observe(seen, F.count(F.lit(1)).alias("received"))
        checked = observed.persist()  # one micro-batch, parsed once for both writes
        try:
            store.write_rejects(batch_id, rejects(checked), lambda: seen.get["received"])
            _write_counted(store, batch_id, valid_views(checked), tracked)
        finally:
            checked.unpersist()
        _after_flush(store, batch_id, on_flush)

    return _start(requests, store, trigger, flush)


def _write_counted(store: TierStore, batch_id: int, views: DataFrame, tracked: int | None) -> None:
    if tracked is not None:
        store.write_summary(batch_id, summarize(views, tracked))
    store.write_delta(batch_id, count_by_hour(views))


def _start(stream: DataFrame, store: TierStore, trigger: dict | None, flush) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(flush)
        .option("checkpointLocation", store.checkpoint)
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .start()
    )


def _after_flush(store: TierStore, batch_id: int, on_flush: OnFlush | None) -> None:
    if on_flush is None or store.delta_is_empty(batch_id):
        return
    try:
        on_flush(store, batch_id)
    except Exception:
        logger.exception("on_flush failed after batch %d", batch_id)
