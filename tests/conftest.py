from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from viewrank.clock import Clock  # noqa: E402
from viewrank.schema import VIEW  # noqa: E402
from viewrank.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "viewrank-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__default__parallelism="4",
        spark__ui__enabled="false",
        spark__sql__maxMetadataStringLength="1000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def views_of(spark):
    """[("vid_1", "2024-01-30 12:00", 3), ...] as view rows; the number is optional."""

    def build(rows):
        flat = []
        for video, time, *times in rows:
            flat += [(video, datetime.fromisoformat(time))] * (times[0] if times else 1)
        return spark.createDataFrame(flat, VIEW)

    return build


@pytest.fixture
def now():
    return Clock(datetime(2024, 1, 30, 12, 45))


def rows(df):
    """Rows as sorted plain tuples."""
    return sorted(tuple(row) for row in df.collect())
