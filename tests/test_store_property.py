"""Any split into batches, any compactions and replays: the store answers like one count."""

from __future__ import annotations

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import model
from conftest import rows
from viewrank.clock import Clock
from viewrank.operators.counting import count_by_hour
from viewrank.plans.snapshot import rank_slots, slots_from_tiers
from viewrank.schema import TIMEFRAMES, VIEW
from viewrank.session import new_work_folder
from viewrank.sources.store import TierStore

NOW = datetime(2024, 3, 2, 1, 15)
moments = st.one_of(st.integers(0, 200), st.integers(0, 1800), st.integers(0, 60000)).map(
    lambda minutes: NOW - timedelta(minutes=minutes)
)
views = st.lists(st.tuples(st.integers(1, 9).map(lambda i: f"vid_{i}"), moments), max_size=25)
steps = st.lists(st.tuples(views, st.sampled_from(["", "", "compact", "replay", "clean"])), min_size=1, max_size=4)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(steps)
def test_store_equals_one_count(spark, steps):
    store, clock = TierStore(spark, new_work_folder(spark, "property")), Clock(NOW)
    for batch_id, (batch, action) in enumerate(steps):
        delta = count_by_hour(spark.createDataFrame(batch, VIEW))
        store.write_delta(batch_id, delta)
        if action in ("compact", "clean"):
            store.compact(clock)
        if action == "clean":
            store.clean_up()
        if action in ("replay", "clean"):
            store.write_delta(batch_id, delta)
    everything = [view for batch, _ in steps for view in batch]
    expected = []
    for timeframe in TIMEFRAMES:
        best = model.top(model.counts(everything, timeframe, NOW), 4)
        expected += [(timeframe, *row) for row in best]
    assert rows(rank_slots(slots_from_tiers(store.tiers(), clock), 4)) == sorted(expected)
    assert store.tier("month").count() == len({(v, f"{t:%Y-%m}") for v, t in everything})
