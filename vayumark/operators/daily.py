"""From hourly readings to one row of pollutant values per city and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import stable_mean
from .rolling import rolling_mean

DAY_KEY = ("city_id", "observed_date")
MEAN_POLLUTANTS = ("pm2_5", "pm10", "no2", "so2")
WINDOW_HOURS = 8
WINDOW_COLUMNS = {"o3": "o3", "co": "co_mg_m3"}
# Of the 8 hours of a window at least this many must be measured.
MIN_WINDOW_HOURS = 6


def _mean_columns() -> list[Column]:
    columns = [F.count("*").alias("hours_reported")]
    for p in MEAN_POLLUTANTS:
        columns.append(stable_mean(p).alias(f"{p}_24h"))
        columns.append(F.count(p).alias(f"{p}_hours"))
    return columns


def _rolling_max_columns(min_hours: int) -> list[Column]:
    return [
        F.expr(f"round(max(CASE WHEN {p}_8h_hours >= {min_hours} THEN {p}_8h_avg END), 9)").alias(
            f"{p}_8h_max"
        )
        for p in WINDOW_COLUMNS
    ]


def daily_averages(hourly: DataFrame) -> DataFrame:
    """24-hour means of the particulate and gas readings, with their coverage."""
    return hourly.groupBy(*DAY_KEY).agg(*_mean_columns())


def rolling_8h(hourly: DataFrame) -> DataFrame:
    """8-hour means of O3 and CO ending at each hour, crossing midnight."""
    # the window's own day column takes the place of observed_date, which it equals
    return rolling_mean(
        hourly.drop("observed_date"),
        ["city_id"],
        "observed_at",
        WINDOW_HOURS,
        WINDOW_COLUMNS,
        day="observed_date",
    )


def daily_rolling_max(rolling: DataFrame, min_hours: int = MIN_WINDOW_HOURS) -> DataFrame:
    """Highest sufficiently covered 8-hour mean ending on each day."""
    return rolling.groupBy(*DAY_KEY).agg(*_rolling_max_columns(min_hours))


def pollutant_daily(hourly: DataFrame, min_hours: int = MIN_WINDOW_HOURS) -> DataFrame:
    """Daily means and rolling maxima in one pass.

    Means and maxima have the same grain, so they share one aggregation over the
    windowed rows, combined before its exchange; no join is needed.
    """
    return (
        rolling_8h(hourly)
        .groupBy(*DAY_KEY)
        .agg(*_mean_columns(), *_rolling_max_columns(min_hours))
    )
