"""Jobs for spark-submit or `python -m viewrank`: count, refresh, maintain, top.

    python -m viewrank count --store S --source text --path requests/ --every 60
    python -m viewrank maintain --store S            # hourly, from any scheduler
    python -m viewrank refresh --store S             # as often as answers must age
    python -m viewrank top --store S --timeframe "last hour" --k 5
"""

from __future__ import annotations

import argparse
import logging
from datetime import datetime

from pyspark.sql import functions as F

from viewrank.clock import Clock
from viewrank.operators.summaries import TRACKED
from viewrank.plans.maintenance import maintain
from viewrank.plans.snapshot import refresh_snapshot, top_videos_response
from viewrank.session import build_session
from viewrank.sources.store import TierStore
from viewrank.sources.views import stream_requests
from viewrank.streaming.view_counts import start_request_counts

logger = logging.getLogger(__name__)

# What one micro-batch takes at most unless --option says otherwise; the rest waits for the next one.
BATCH_BOUNDS = {"text": {"maxFilesPerTrigger": "1000"}, "kafka": {"maxOffsetsPerTrigger": "10000000"}}


def clock_at(as_of: str | None) -> Clock:
    return Clock(datetime.fromisoformat(as_of)) if as_of else Clock.now()


def count(store: TierStore, args: argparse.Namespace) -> None:
    """Runs until stopped; `--once` stops when everything that has arrived is counted.

    Answers are renewed beside the counting, which never waits for them: every `--refresh-every` seconds, since
    time alone changes them, and once more at the end.
    """
    options = {**BATCH_BOUNDS.get(args.source, {}), **dict(o.split("=", 1) for o in args.option)}
    requests = stream_requests(store.spark, args.source, options, args.path)
    trigger = {"availableNow": True} if args.once else {"processingTime": f"{args.every} seconds"}
    query = start_request_counts(requests, store, trigger, tracked=args.tracked)
    while not query.awaitTermination(args.refresh_every):
        try:
            refresh_snapshot(store, clock_at(args.as_of))
        except Exception:
            logger.exception("refresh failed, counting goes on")
    refresh_snapshot(store, clock_at(args.as_of))


def top(store: TierStore, args: argparse.Namespace) -> None:
    response = top_videos_response(store.snapshot(), args.timeframe, args.k)
    print(response.select(F.to_json(F.struct("timeframe", "k", "videos"))).first()[0])


def parse(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="viewrank", description="Most viewed videos")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("count", "refresh", "maintain", "top"):
        job = jobs.add_parser(name)
        job.add_argument("--store", required=True, help="root folder, reachable by every executor")
        job.add_argument("--as-of", help="UTC moment, default: now")
        if name == "count":
            job.add_argument("--source", default="text", help="streaming format with a value column")
            job.add_argument("--path", help="folder to watch, for file sources")
            job.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
            job.add_argument("--every", type=float, default=60, help="seconds between flushes")
            job.add_argument("--refresh-every", type=float, default=30, help="seconds between answers")
            job.add_argument("--tracked", type=int, default=TRACKED, help="ids in the summary of a batch")
            job.add_argument("--once", action="store_true")
        if name == "top":
            job.add_argument("--timeframe", required=True)
            job.add_argument("--k", type=int, required=True)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    store = TierStore(build_session(), args.store)
    if args.job == "count":
        count(store, args)
    elif args.job == "top":
        top(store, args)
    elif args.job == "refresh":
        refresh_snapshot(store, clock_at(args.as_of))
    else:
        maintain(store, clock_at(args.as_of))


if __name__ == "__main__":
    main()
