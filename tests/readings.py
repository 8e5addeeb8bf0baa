"""Hand-written readings for tests."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from vayumark.plans.landing import stamp_lineage
from vayumark.schemas import RAW

VALUES = {"pm2_5": 33.5, "pm10": 61.0, "no2": 22.0, "so2": 14.5, "o3": 57.0, "co": 730.0}
UNSTAMPED = RAW.names[:8]


def day_rows(day: date, hours=range(24), city: str = "chennai", **values) -> list[tuple]:
    reading = tuple({**VALUES, **values}.values())
    start = datetime(day.year, day.month, day.day)
    return [(city, start + timedelta(hours=h), *reading) for h in hours]


def patterned(city: str, level: float, first: date, last: date, shift: float = 0.0) -> list[tuple]:
    """A level per city with a pattern by day and hour; `shift` changes the values."""
    rows = []
    for n in range((last - first).days + 1):
        day = first + timedelta(days=n)
        for h in range(24):
            pm = level + (day.toordinal() * 7) % 13 + (h % 5) / 2 + shift
            rows += day_rows(
                day, [h], city, pm2_5=pm, pm10=pm * 1.7, no2=pm / 3, o3=30.0 + h, co=400.0 + pm
            )
    return rows


def raw(spark: SparkSession, rows: list[tuple], run_id: str = "t", at=None) -> DataFrame:
    bare = spark.createDataFrame(rows, schema=_bare_schema())
    return stamp_lineage(bare, "test", run_id, at or datetime(2025, 1, 10))


def _bare_schema():
    from pyspark.sql import types as T

    return T.StructType(RAW.fields[:8])
