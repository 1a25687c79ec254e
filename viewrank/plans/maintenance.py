"""The job for a timer: roll up, trim, refresh. Any scheduler can call it, hourly for example."""

from __future__ import annotations

from datetime import timedelta

from viewrank.clock import Clock
from viewrank.plans.snapshot import refresh_snapshot
from viewrank.sources.store import TierStore


def maintain(store: TierStore, clock: Clock, grace: timedelta = timedelta(hours=1)) -> int:
    """Fold what arrived into all tiers, apply retention, publish new answers; the base version.

    A missed run is caught up by the next one, and an extra run changes nothing. What was
    replaced at least `grace` ago is deleted; readers have that long to finish.
    """
    store.clean_up(grace=grace)
    version = store.compact(clock)
    store.merge_rejects()
    refresh_snapshot(store, clock)
    return version
