"""Tables built on the AQI fact: cities, 30-day summary, level shifts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage
from .ordered import ranked_values
from .aqi import day_id

SUMMARY_DAYS = 30
SHIFT_THRESHOLD = 50
SHIFT_NOISE_FACTOR = 2.0
# rows before / from the day on that are compared, and how many must exist
SHIFT_SPAN = 14
SHIFT_MIN_ROWS = 10
# a shift must be the largest among this many rows on either side
SHIFT_PEAK_ROWS = 7


def dim_city(cities: DataFrame) -> DataFrame:
    """Descriptive attributes, one row per city."""
    return cities.select("city_id", "city_name", "state", "region", "latitude", "longitude")


def valid_days(fact: DataFrame) -> DataFrame:
    return fact.filter("is_aqi_valid")


def latest_per_city(fact: DataFrame) -> DataFrame:
    """Each city's most recent valid day, from the whole history."""
    newest = F.max_by(F.struct("aqi", "aqi_category", "observed_date"), "observed_date")
    return (
        valid_days(fact)
        .groupBy("city_id")
        .agg(newest.alias("newest"))
        .select(
            "city_id",
            F.col("newest.aqi").alias("latest_aqi"),
            F.col("newest.aqi_category").alias("latest_category"),
            F.col("newest.observed_date").alias("latest_date"),
        )
    )


def _last_day(fact: DataFrame) -> Column:
    """Newest date of a table as a scalar subquery."""
    return fact.select(F.max("observed_date")).scalar()


def global_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """Rank by ``value`` descending, nulls last, ties sharing a rank.

    Distinct values are counted and ranked in range partitions, whatever their number.
    """
    ranked = ranked_values(df, value, name).select(F.col(value).alias("_value"), F.col(name).cast("int").alias(name))
    same = F.col(value).eqNullSafe(F.col("_value"))
    return df.join(ranked, same, "left").drop("_value")


def city_summary(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Latest day, 30-day statistics and pollution rank of every city.

    The 30 days end at the newest valid date of all cities. Latest day and
    statistics come from one aggregation; cities without data are kept.
    """
    facts = valid_days(fact)
    recent = F.col("observed_date") > F.date_sub(_last_day(facts), SUMMARY_DAYS)
    aqi = F.when(F.col("recent"), F.col("aqi"))
    newest = F.max_by(F.struct("aqi", "aqi_category", "observed_date"), "observed_date")
    stats = (
        facts.withColumn("recent", recent)
        .groupBy("city_id")
        .agg(
            newest.alias("newest"),
            F.nullif(F.count_if("recent"), F.lit(0)).alias("days_measured"),
            F.round(F.avg(aqi)).cast("int").alias("avg_aqi_30d"),
            F.max(aqi).alias("worst_aqi_30d"),
            F.min(aqi).alias("best_aqi_30d"),
            F.sum((aqi <= 100).cast("bigint")).alias("good_or_satisfactory_days"),
            F.sum((aqi > 200).cast("bigint")).alias("poor_or_worse_days"),
            F.mode(F.when(F.col("recent"), F.col("dominant_pollutant")), True).alias(
                "usual_dominant_pollutant"
            ),
        )
    )
    joined = dim.join(stats, "city_id", "left").select(
        *("city_id", "city_name", "state", "region"),
        F.col("newest.observed_date").alias("latest_date"),
        F.col("newest.aqi").alias("latest_aqi"),
        F.col("newest.aqi_category").alias("latest_category"),
        *("days_measured", "avg_aqi_30d", "worst_aqi_30d", "best_aqi_30d"),
        *("good_or_satisfactory_days", "poor_or_worse_days", "usual_dominant_pollutant"),
    )
    # ranking looks twice at its input: one row a city, not the fact again
    return global_rank(stage(joined, "summary"), "avg_aqi_30d", "pollution_rank_30d")


def level_shifts(
    fact: DataFrame, threshold: float = SHIFT_THRESHOLD, k: float = SHIFT_NOISE_FACTOR
) -> DataFrame:
    """Days on which a city's index moved to another level and stayed there.

    Compares the 14 valid days before a day with the 14 from that day on. A day
    is flagged if the means differ by ``threshold``, by ``k`` times the pooled
    standard deviation, and more than on any of the 7 rows on either side.
    Frames count valid days; a city's partition is bounded by the calendar.
    """
    by_day = W.partitionBy("city_id").orderBy("observed_date")
    before = by_day.rowsBetween(-SHIFT_SPAN, -1)
    after = by_day.rowsBetween(0, SHIFT_SPAN - 1)
    around = by_day.rowsBetween(-SHIFT_PEAK_ROWS, SHIFT_PEAK_ROWS)

    compared = (
        valid_days(fact)
        .select("city_id", "observed_date", "aqi")
        .withColumns(
            {
                f"{side}_{name}": measure("aqi").over(frame)
                for side, frame in (("before", before), ("after", after))
                for name, measure in (("avg", F.avg), ("days", F.count), ("sd", F.stddev_samp))
            }
        )
        .filter((F.col("before_days") >= SHIFT_MIN_ROWS) & (F.col("after_days") >= SHIFT_MIN_ROWS))
        .withColumn("shift", F.col("after_avg") - F.col("before_avg"))
        .withColumn("size", F.abs("shift"))
    )
    pooled = F.sqrt(
        (F.col("before_sd") * F.col("before_sd") + F.col("after_sd") * F.col("after_sd")) / 2
    )
    flagged = compared.withColumn("peak", F.max("size").over(around)).filter(
        (F.col("size") >= threshold) & (F.col("size") >= k * pooled) & (F.col("size") == F.col("peak"))
    )
    return flagged.select(
        day_id().alias("level_shift_id"),
        "city_id",
        F.col("observed_date").alias("shift_date"),
        F.round("before_avg").cast("int").alias("before_avg_aqi"),
        F.round("after_avg").cast("int").alias("after_avg_aqi"),
        F.round("shift").cast("int").alias("shift_aqi"),
        F.when(F.col("shift") > 0, "up").otherwise("down").alias("direction"),
    )
