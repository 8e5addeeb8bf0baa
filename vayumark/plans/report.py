"""Data sets behind the report. Nothing is collected; the caller decides."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import category_ordinal, half_even, pollutant_label
from ..operators import quality

RECENT_DAYS = 90
POOR_ABOVE = 200
# shifts at most this many days apart belong together
SHIFT_GAP_DAYS = 3
# from this many shifts on, the data source is the likely cause
COMMON_CAUSE_SHIFTS = 3
# Texts shown with a group, and the source name of made-up rows.
COMMON_CAUSE = "Several cities at once: probably a data-source change"
SINGLE_CAUSE = "Single city: could be real (season, local event) or data"
SYNTHETIC_SOURCE = "synthetic_sample"


def recent_daily(fact: DataFrame, dim: DataFrame, days: int = RECENT_DAYS) -> DataFrame:
    """Daily series of the days up to the newest of all facts, with city names."""
    last = fact.select(F.max("observed_date")).scalar()
    return (
        fact.filter(F.col("observed_date") > F.date_sub(last, days))
        .join(dim.select("city_id", "city_name"), "city_id")
        .select(
            "city_id",
            "city_name",
            F.col("observed_date").cast("string").alias("d"),
            "aqi",
            "aqi_category",
            "dominant_pollutant",
            "aqi_7d_avg",
        )
        .orderBy("d", "city_name", "city_id")
    )


def history_stats(hourly: DataFrame) -> DataFrame:
    """Size and extent of the history, and whether it has synthetic rows.

    Reduced to one row per city and day first, so the two distinct counts
    expand days instead of hours.
    """
    synthetic = (F.col("source") == SYNTHETIC_SOURCE).cast("int")
    per_day = hourly.groupBy("city_id", "observed_date").agg(
        F.count("*").alias("hours"), F.max(F.coalesce(synthetic, F.lit(0))).alias("synthetic")
    )
    return per_day.agg(
        F.sum("hours").alias("hourly_rows"),
        F.count_distinct("city_id").alias("cities"),
        F.min("observed_date").alias("first_day"),
        F.max("observed_date").alias("last_day"),
        F.count_distinct("observed_date").alias("days"),
        F.max("synthetic").alias("has_synthetic"),
    )


def history_labels(stats: DataFrame) -> DataFrame:
    """History statistics with dates as shown on the report."""
    return stats.withColumns(
        {day: F.date_format(day, "dd MMM yyyy") for day in ("first_day", "last_day")}
    )


def named_shifts(shifts: DataFrame, dim: DataFrame) -> DataFrame:
    """Level shifts with city names, by date."""
    return (
        shifts.join(dim.select("city_id", "city_name"), "city_id")
        .select(
            F.col("shift_date").cast("string").alias("shift_date"),
            "city_name",
            "before_avg_aqi",
            "after_avg_aqi",
            "shift_aqi",
        )
        .orderBy("shift_date", "city_name")
    )


def _days_with_group(shifts: DataFrame, by: Sequence[str], gap_days: int) -> DataFrame:
    """Days that have shifts, each with the first day of its group.

    Where a group begins depends only on which days occur, so shifts are reduced
    to days before anything is ordered: the windows see at most one row per day.
    """
    days = shifts.withColumn("day", F.col("shift_date").cast("date")).groupBy(*by, "day").agg(
        F.count("*").alias("shifts"),
        F.sum("before_avg_aqi").alias("before_sum"),
        F.sum("after_avg_aqi").alias("after_sum"),
    )
    in_order = W.partitionBy(*by).orderBy("day")
    begins = F.coalesce(F.datediff("day", F.lag("day").over(in_order)) > gap_days, F.lit(True))
    start = F.when(F.col("begins"), F.col("day"))
    return days.withColumn("begins", begins).withColumn(
        "group_date", F.max(start).over(in_order.rowsBetween(W.unboundedPreceding, 0))
    )


def shift_groups(
    shifts: DataFrame, by: Sequence[str] = (), gap_days: int = SHIFT_GAP_DAYS
) -> DataFrame:
    """Shifts close in time as one row: number, mean levels and likely cause."""
    grouped = (
        _days_with_group(shifts, by, gap_days)
        .groupBy(*by, "group_date")
        .agg(
            F.sum("shifts").alias("shifts"),
            F.sum("before_sum").alias("before_sum"),
            F.sum("after_sum").alias("after_sum"),
        )
    )
    return grouped.select(
        *by,
        F.col("group_date").cast("string").alias("group_date"),
        "shifts",
        half_even("before_sum / shifts").alias("before"),
        half_even("after_sum / shifts").alias("after"),
        F.when(F.col("shifts") >= COMMON_CAUSE_SHIFTS, COMMON_CAUSE)
        .otherwise(SINGLE_CAUSE)
        .alias("likely_cause"),
    )


def shift_group_members(
    shifts: DataFrame, by: Sequence[str] = (), gap_days: int = SHIFT_GAP_DAYS
) -> DataFrame:
    """Every shift with the first day of its group: the group's list of cities."""
    days = _days_with_group(shifts, by, gap_days).select(
        *by, "day", F.col("group_date").cast("string").alias("group_date")
    )
    return shifts.withColumn("day", F.col("shift_date").cast("date")).join(
        days, [*by, "day"]
    ).drop("day")


def summary_table(summary: DataFrame) -> DataFrame:
    """The 30-day summary in order of rank, with display labels."""
    return summary.withColumn(
        "usual_dominant_label", pollutant_label("usual_dominant_pollutant")
    ).orderBy("pollution_rank_30d", "city_id")


def kpi_worst(summary: DataFrame) -> DataFrame:
    """The most polluted city of the last 30 days."""
    return (
        summary.orderBy("pollution_rank_30d", "city_id")
        .limit(1)
        .select("city_name", "avg_aqi_30d", "poor_or_worse_days")
    )


def kpi_cleanest(summary: DataFrame) -> DataFrame:
    """The city with the lowest latest index; zero counts as not measured."""
    return (
        summary.filter(F.col("latest_aqi") != 0)
        .orderBy("latest_aqi", "pollution_rank_30d", "city_id")
        .limit(1)
        .select("city_name", "latest_aqi", "latest_category", "latest_date")
    )


def kpi_poor_cities(summary: DataFrame, stats: DataFrame) -> DataFrame:
    """Cities whose latest index is above 200, of the cities in the history."""
    return summary.agg(
        F.count_if(F.col("latest_aqi") > POOR_ABOVE).alias("poor_cities")
    ).withColumn("cities", stats.select("cities").scalar())


def latest_dominant(daily: DataFrame) -> DataFrame:
    """Dominant pollutant of each city's last day with an index, among recent days."""
    return (
        daily.filter(F.col("aqi").isNotNull())
        .groupBy("city_id", "city_name")
        .agg(F.max_by("dominant_pollutant", "d").alias("dominant_pollutant"))
    )


def latest_bars(summary: DataFrame, daily: DataFrame) -> DataFrame:
    """Latest index per city, lowest first, with the pollutant that set it."""
    dominant = latest_dominant(daily).select("city_id", "dominant_pollutant")
    return (
        summary.filter(F.col("latest_aqi").isNotNull())
        .join(dominant, "city_id", "left")
        .orderBy("latest_aqi", "pollution_rank_30d", "city_id")
        .select(
            "city_name",
            "latest_aqi",
            "latest_category",
            pollutant_label("dominant_pollutant").alias("dominant_label"),
        )
    )


def heatmap(daily: DataFrame) -> DataFrame:
    """City-by-day cells in long form: 0 (Good) to 5 (Severe), null if invalid."""
    return daily.select(
        "city_name",
        "d",
        "aqi",
        category_ordinal("aqi_category").alias("category_ordinal"),
        pollutant_label("dominant_pollutant").alias("dominant_label"),
    )


def _shown_time(moment: Column) -> Column:
    return F.concat(F.date_format(F.convert_timezone(None, F.lit("UTC"), moment), "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))


def health_panel(
    results: DataFrame,
    raw: DataFrame | None = None,
    builds: DataFrame | None = None,
    now: datetime | None = None,
    sources: Sequence[str] = ("raw",),
) -> DataFrame:
    """Check roll-up next to the last build and the freshness of the raw data.

    ``builds`` has began_at and elapsed_s of the builds that passed. What is not
    given is unknown: freshness says so, times are null.
    """
    panel = quality.health(results, sources)
    fresh, loaded = F.lit("unknown"), F.lit(None).cast("string")
    if raw is not None:
        found = quality.freshness(raw, now)
        fresh = found.select("status").scalar()
        loaded = found.select(_shown_time(F.col("max_loaded_at"))).scalar()
    built, elapsed = F.lit(None).cast("string"), F.lit(None).cast("double")
    if builds is not None:
        last = builds.agg(F.max_by(F.struct("began_at", "elapsed_s"), "began_at").alias("last"))
        ended = F.timestamp_add("SECOND", F.floor("last.elapsed_s").cast("int"), "last.began_at")
        built = last.select(_shown_time(ended)).scalar()
        elapsed = last.select(F.round("last.elapsed_s", 1)).scalar()
    return panel.withColumns(
        {"freshness": fresh, "max_loaded_at": loaded, "built_at": built, "elapsed_s": elapsed}
    )
