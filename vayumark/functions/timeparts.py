"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Asia/Kolkata"


def hour_start(ts: str) -> Column:
    """Start of the hour of a zone-free timestamp.

    ``date_trunc`` goes through the session zone, where hours may not exist.
    """
    return F.expr(
        f"make_timestamp_ntz(year({ts}), month({ts}), day({ts}), hour({ts}), 0, 0)"
    )


def day_of(ts: Column | str) -> Column:
    """Calendar day of a zone-free timestamp."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return column.cast("date")


def instant(now: datetime | None) -> Column:
    """``now`` as an instant; a naive datetime is taken as UTC, ``None`` as the clock."""
    if now is None:
        return F.current_timestamp()
    aware = now if now.tzinfo else now.replace(tzinfo=timezone.utc)
    return F.lit(aware.astimezone(timezone.utc).isoformat()).cast("timestamp")


def local_today(now: datetime | None = None) -> Column:
    """Today's date on the cities' wall clock. Foldable, so it prunes partitions."""
    return F.convert_timezone(None, F.lit(LOCAL_ZONE), instant(now)).cast("date")


def whole_second_now(now: datetime | None = None) -> Column:
    """An instant cut to whole seconds, as stored in the lake."""
    return F.date_trunc("second", instant(now))
