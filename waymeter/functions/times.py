"""Days and hours in a report's own time zone. The session zone is UTC."""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

UTC = "UTC"


def local_time(instant: Column, tz: str = UTC) -> Column:
    """Wall-clock time in `tz`. Convert before truncating: half-hour offsets move hour borders."""
    return instant if tz == UTC else F.from_utc_timestamp(instant, tz)


def fixed_offset(tz: str = UTC, first_year: int = 2010, last_year: int = 2037) -> int:
    """Minutes that `tz` is ahead of UTC. Event-time windows are cut at even distances, so a zone whose clock is
    moved within those years has no such windows."""
    months = [datetime(year, month, 1, tzinfo=ZoneInfo(tz)) for year in range(first_year, last_year + 1) for month in range(1, 13)]
    offsets = {int(moment.utcoffset().total_seconds() // 60) for moment in months}
    if len(offsets) > 1:
        raise ValueError(f"the clock of {tz} is moved between {first_year} and {last_year}")
    return offsets.pop()


def day_bounds(day: str, tz: str = UTC) -> tuple[Column, Column]:
    """First instant of a local day and of the next one; constants that Spark folds and pushes down."""
    start = F.lit(day).cast("date")
    bounds = (start.cast("timestamp"), F.date_add(start, 1).cast("timestamp"))
    if tz == UTC:
        return bounds
    return tuple(F.to_utc_timestamp(bound, tz) for bound in bounds)
