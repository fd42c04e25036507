"""Day windows and local days."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_day(instant: Column, zone: str = "UTC") -> Column:
    """Calendar day of an instant in `zone` (the session zone is pinned to UTC)."""
    if zone == "UTC":
        return F.to_date(instant)
    return F.to_date(F.from_utc_timestamp(instant, zone))


def last_day_of_previous_month(as_of: date) -> date:
    return as_of.replace(day=1) - timedelta(days=1)


@dataclass(frozen=True)
class DayWindow:
    """Days `start`..`end`, both included, counted in `zone`."""

    start: date
    end: date
    zone: str = "UTC"

    @classmethod
    def until_last_month(cls, start: date, as_of: date, zone: str = "UTC") -> DayWindow:
        """From `start` to the end of the month before `as_of`."""
        return cls(start, last_day_of_previous_month(as_of), zone)

    def contains(self, instant: Column) -> Column:
        """Predicate on the raw instant.

        The plain range comes first: it compares the stored column with literals, so it
        reaches the file scan. Zones other than UTC widen it by a day on each side and
        keep the exact day test as well.
        """
        slack = timedelta(days=0 if self.zone == "UTC" else 1)
        coarse = (instant >= _midnight(self.start - slack)) & (
            instant < _midnight(self.end + timedelta(days=1) + slack)
        )
        if self.zone == "UTC":
            return coarse
        return coarse & local_day(instant, self.zone).between(F.lit(self.start), F.lit(self.end))


def _midnight(day: date) -> Column:
    return F.lit(f"{day.isoformat()}T00:00:00Z").cast("timestamp")
