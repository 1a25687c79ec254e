"""Every boundary that depends on the moment a question is asked for."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from viewrank.schema import KEEP_DAYS, KEEP_HOURS

_HOUR = timedelta(hours=1)
_DAY = timedelta(days=1)


def hour_text(moment: datetime) -> str:
    """``2024-01-30-12``; isoformat pads early years, strftime does not."""
    return moment.isoformat()[:13].replace("T", "-")


def day_text(moment: datetime) -> str:
    return moment.isoformat()[:10]


@dataclass(frozen=True)
class Clock:
    """``as_of`` as naive UTC. Starts are datetimes, buckets are the text stored in tiers."""

    as_of: datetime

    def __post_init__(self) -> None:
        if self.as_of.tzinfo is not None:
            raise ValueError("as_of must be naive (UTC wall clock)")

    @classmethod
    def now(cls) -> Clock:
        """For live use; everything else is told the moment."""
        return cls(datetime.now(timezone.utc).replace(tzinfo=None))

    @property
    def hour_start(self) -> datetime:
        return self.as_of.replace(minute=0, second=0, microsecond=0)

    @property
    def previous_hour_start(self) -> datetime:
        return self.hour_start - _HOUR

    @property
    def today_start(self) -> datetime:
        return self.hour_start.replace(hour=0)

    @property
    def last_day_start(self) -> datetime:
        """24 full hours and the running one."""
        return self.hour_start - 24 * _HOUR

    @property
    def last_month_start(self) -> datetime:
        """30 closed days and today."""
        return self.today_start - 30 * _DAY

    @property
    def keep_hours_from(self) -> str:
        return hour_text(self.hour_start - KEEP_HOURS * _HOUR)

    @property
    def keep_days_from(self) -> str:
        return day_text(self.today_start - KEEP_DAYS * _DAY)

    def start_of(self, timeframe: str) -> datetime | None:
        """Earliest view a timeframe can count; None where there is no bound."""
        return {
            "last hour": self.previous_hour_start,
            "last day": self.last_day_start,
            "last month": self.last_month_start,
            "all time": None,
        }[timeframe]
