"""The answers in plain Python over a list of (video, time) pairs, for comparison."""

from __future__ import annotations

import hashlib
from collections import Counter
from datetime import timedelta


def shard(video):
    return int.from_bytes(hashlib.md5(video.encode()).digest(), "big") % 10


def counts(views, timeframe, as_of):
    hour = as_of.replace(minute=0, second=0, microsecond=0)
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    past = [(v, t) for v, t in views if t <= as_of]
    if timeframe == "last hour":
        running = Counter(v for v, t in past if t >= hour)
        earlier = Counter(v for v, t in past if hour - timedelta(hours=1) <= t < hour)
        busy = {shard(v) for v in running}
        return running + Counter({v: n for v, n in earlier.items() if shard(v) not in busy})
    start = {
        "last day": hour - timedelta(hours=24),
        "last month": midnight - timedelta(days=30),
        "all time": None,
    }[timeframe]
    return Counter(v for v, t in past if start is None or t >= start)


def top(counted, k):
    best = sorted(counted.items(), key=lambda item: (-item[1], item[0]))[:k]
    return [(rank, v, n) for rank, (v, n) in enumerate(best, 1)]
