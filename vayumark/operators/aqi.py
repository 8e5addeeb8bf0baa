"""Sub-indices, the daily index and its trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import aqi_category, half_up
from ..functions.aqi_scale import TOP_CATEGORY, top_pollutant
from ..schemas import FACT, POLLUTANTS
from .daily import DAY_KEY, MEAN_POLLUTANTS

# A 24-hour mean counts from this many hours on.
MIN_HOURS = 16
# An index needs this many pollutants, one of them a particulate.
MIN_POLLUTANTS = 3
PARTICULATES = ("pm2_5", "pm10")

# daily column holding each pollutant's value
VALUE_COLUMN = {p: f"{p}_24h" if p in MEAN_POLLUTANTS else f"{p}_8h_max" for p in POLLUTANTS}

# display column of the fact -> (daily column, decimals)
DISPLAY = {
    "pm2_5_24h_ug_m3": ("pm2_5_24h", 1),
    "pm10_24h_ug_m3": ("pm10_24h", 1),
    "no2_24h_ug_m3": ("no2_24h", 1),
    "so2_24h_ug_m3": ("so2_24h", 1),
    "o3_8h_max_ug_m3": ("o3_8h_max", 1),
    "co_8h_max_mg_m3": ("co_8h_max", 2),
}
# slots per pollutant in the band join
BAND_SLOTS = 32


def _unpivot(min_hours: int) -> Column:
    def entry(p: str) -> str:
        value = VALUE_COLUMN[p]
        covered = f"{p}_hours >= {min_hours}" if p in MEAN_POLLUTANTS else f"{value} IS NOT NULL"
        return f"struct('{p}' AS pollutant, {value} AS value, {covered} AS is_valid)"

    return F.expr(f"inline(array({', '.join(entry(p) for p in POLLUTANTS)}))")


def unpivot_pollutants(daily: DataFrame, min_hours: int = MIN_HOURS) -> DataFrame:
    """One row per city, day and pollutant, with a flag for sufficient coverage.

    Generated from the row itself: one pass, and the partitioning of ``daily``
    survives, unlike with a union of six projections.
    """
    return daily.select(*DAY_KEY, _unpivot(min_hours))


def _place_in_band(values: DataFrame, breakpoints: DataFrame, how: str) -> DataFrame:
    """Band join and interpolation.

    The band table is fixed and small; the planner broadcasts it by its known size.
    If it may not, six pollutants would be six keys, so days are dealt to slots and
    each slot has the bands.
    """
    bands = breakpoints.selectExpr(
        f"explode(sequence(0, {BAND_SLOTS - 1})) AS slot",
        "pollutant AS band_of",
        "conc_low AS starts",
        "conc_high AS ends",
        "conc_high - conc_low AS width",
        "index_low AS base",
        "index_high - index_low AS rise",
        f"category = '{TOP_CATEGORY}' AS is_top",
    )
    in_band = F.expr(
        f"is_valid AND pollutant = band_of AND slot = pmod(hash({', '.join(DAY_KEY)}), {BAND_SLOTS})"
        " AND value >= starts AND (is_top OR value < ends)"
    )
    within = "(least(value, ends) - starts)"
    placed = values.join(bands, in_band, how)
    return placed.select(
        *values.columns, F.expr(f"CAST(round(base + {within} * rise / width) AS int) AS sub_index")
    )


def sub_indices(values: DataFrame, breakpoints: DataFrame) -> DataFrame:
    """Index of each usable pollutant value: linear inside its band, capped on top.

    Bands are closed below and open above, the top one unbounded. A value below
    every band has no sub-index.
    """
    placed = _place_in_band(values, breakpoints, "inner")
    return placed.select(*DAY_KEY, "pollutant", "sub_index")


def _roll_up() -> list[Column]:
    """Daily roll-up of sub-indices; rows without one do not count."""
    return [
        F.max("sub_index").alias("max_sub_index"),
        top_pollutant("sub_index", "pollutant").alias("top_pollutant"),
        F.count("sub_index").alias("pollutants_used"),
        F.expr(
            f"max(CASE WHEN sub_index IS NOT NULL THEN CAST(pollutant IN {PARTICULATES} AS int) END)"
        ).alias("has_particulates"),
        *(
            F.expr(f"max(CASE WHEN pollutant = '{p}' THEN sub_index END)").alias(f"{p}_sub_index")
            for p in POLLUTANTS
        ),
    ]


def per_day(sub: DataFrame) -> DataFrame:
    """Highest sub-index, dominant pollutant and coverage per city and day."""
    return sub.groupBy(*DAY_KEY).agg(*_roll_up())


def is_valid_aqi(min_pollutants: int = MIN_POLLUTANTS) -> Column:
    """Are there enough pollutants, a particulate among them?"""
    return F.expr(f"coalesce(pollutants_used, 0) >= {min_pollutants} AND has_particulates = 1")


def day_id() -> Column:
    """Surrogate key ``city|yyyy-mm-dd``; null if either part is."""
    return F.expr("concat(city_id, '|', CAST(observed_date AS string))")


def score_days(
    daily: DataFrame,
    breakpoints: DataFrame,
    *,
    min_hours: int = MIN_HOURS,
    min_pollutants: int = MIN_POLLUTANTS,
) -> DataFrame:
    """The daily index without trends.

    The day's own columns travel through the unpivot and the band join and come
    back out of the roll-up, so ``daily`` is computed once and no join back is
    needed; every day is kept because unusable values keep their row.
    """
    carried = [c for c in daily.columns if c not in DAY_KEY]
    placed = _place_in_band(daily.select("*", _unpivot(min_hours)), breakpoints, "left")
    scored = (
        placed.groupBy(*DAY_KEY)
        .agg(*_roll_up(), *(F.first(c).alias(c) for c in carried))
        .withColumn("is_aqi_valid", is_valid_aqi(min_pollutants))
        .withColumn("aqi", F.expr("CASE WHEN is_aqi_valid THEN max_sub_index END"))
    )
    return scored.select(
        day_id().alias("daily_aqi_id"),
        *DAY_KEY,
        "hours_reported",
        "pollutants_used",
        "is_aqi_valid",
        "aqi",
        aqi_category("aqi").alias("aqi_category"),
        F.expr("CASE WHEN is_aqi_valid THEN top_pollutant END").alias("dominant_pollutant"),
        *(f"{p}_sub_index" for p in POLLUTANTS),
        *(half_up(c, places).alias(name) for name, (c, places) in DISPLAY.items()),
    )


def with_trends(scored: DataFrame) -> DataFrame:
    """Change against the previous row and trailing 7-row mean, per city.

    Rows are unique per city and day, so a city's partition is bounded by the
    calendar (366 rows a year) however many readings it has.
    """
    by_day = W.partitionBy("city_id").orderBy("observed_date")
    framed = scored.withColumns(
        {
            "aqi_change_vs_prev_day": F.col("aqi") - F.lag("aqi").over(by_day),
            "aqi_7d_avg": F.avg("aqi").over(by_day.rowsBetween(-6, 0)),
        }
    )
    return framed.withColumns(
        {"aqi_7d_avg": half_up("aqi_7d_avg", 1), "updated_at": F.current_timestamp()}
    )


def daily_aqi(daily: DataFrame, breakpoints: DataFrame, **limits: int) -> DataFrame:
    """The AQI fact: one row per city and day, invalid days included with nulls."""
    return with_trends(score_days(daily, breakpoints, **limits)).select(*FACT.names)
