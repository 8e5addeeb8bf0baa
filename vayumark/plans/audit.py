"""The declared checks of every layer: 29 in all."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from ..functions import CATEGORIES
from ..operators import quality as q
from ..operators.quality import RowCheck, grouped_results
from ..schemas import POLLUTANTS

DIRECTIONS = ("up", "down")


def _required(*columns: str) -> list[RowCheck]:
    return [RowCheck(f"{c} not null", q.is_missing(c)) for c in columns]


def source_rows() -> list[RowCheck]:
    return _required("city_id", "observed_at")


def staging_checks(hourly: DataFrame, cities: DataFrame) -> DataFrame:
    rows = [
        *_required("city_id", "observed_at"),
        RowCheck("pm2_5 in range", q.out_of_range("pm2_5", 0, 2000)),
        RowCheck("pm10 in range", q.out_of_range("pm10", 0, 3000)),
    ]
    return grouped_results("hourly", hourly, rows, [("city_id", "observed_at")], ("city_id", cities))


def daily_checks(daily: DataFrame) -> DataFrame:
    return grouped_results("pollutant_daily", daily, [], [("city_id", "observed_date")])


def dim_checks(dim: DataFrame) -> DataFrame:
    return grouped_results("dim_city", dim, _required("city_id"), [("city_id",)])


def fact_checks(fact: DataFrame, dim: DataFrame, today: date | None = None) -> DataFrame:
    rows = [
        *_required("daily_aqi_id", "city_id"),
        RowCheck("aqi in range", q.out_of_range("aqi", 0, 500)),
        RowCheck("aqi_category accepted", q.not_accepted("aqi_category", CATEGORIES)),
        RowCheck("dominant_pollutant accepted", q.not_accepted("dominant_pollutant", POLLUTANTS)),
        RowCheck("hours_reported in range", q.out_of_range("hours_reported", 1, 24)),
        RowCheck("aqi_category matches aqi", q.wrong_category()),
        RowCheck("observed_date not in future", q.in_future(today=today)),
    ]
    keys = [("daily_aqi_id",), ("city_id", "observed_date")]
    return grouped_results("daily_aqi", fact, rows, keys, ("city_id", dim))


def summary_checks(summary: DataFrame) -> DataFrame:
    return grouped_results("city_summary", summary, _required("city_id"), [("city_id",)])


def shift_checks(shifts: DataFrame, dim: DataFrame) -> DataFrame:
    rows = [
        *_required("level_shift_id", "city_id"),
        RowCheck("direction accepted", q.not_accepted("direction", DIRECTIONS)),
    ]
    return grouped_results("level_shifts", shifts, rows, [("level_shift_id",)], ("city_id", dim))
