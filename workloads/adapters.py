"""Shape the driver tables like the inputs of the library.

Each adapter has its counterpart in SQL in `workloads.oracles`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vayumark.functions import day_of, hour_start
from vayumark.schemas import API_FIELDS, EXPECTED_UNIT, POLLUTANTS, RAW

# Which event type stands for which pollutant.
EVENT_POLLUTANT = {
    "view": "pm2_5",
    "click": "pm10",
    "purchase": "no2",
    "signup": "so2",
    "error": "o3",
}
CO_PER_O3 = 40

STATION = "concat('st', user_id % 3)"
PER_USER = "concat('u', user_id)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_hourly(spark: SparkSession, sf_dir: str, city: str = STATION) -> DataFrame:
    """Raw hourly rows: mean event value per city, hour and type, two decimals.

    The mean is taken over whole hundredths, so it does not depend on the order
    of summation. Partial aggregation keeps a busy city from becoming a hot spot.
    """
    readings = [
        F.expr(
            f"floor(avg(CASE WHEN event_type = '{kind}' THEN CAST(round(value * 100) AS bigint) END)"
            f" + 0.5D) / 100 AS {name}"
        )
        for kind, name in EVENT_POLLUTANT.items()
    ]
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.expr(city).alias("city_id"), hour_start("ts").alias("observed_at"))
        .agg(*readings, F.expr("CAST(max(ts) AS timestamp) AS ingested_at"))
        .selectExpr(
            *RAW.names[:7], f"o3 * {CO_PER_O3} AS co", "'events' AS source", "ingested_at", "'r1' AS run_id"
        )
    )


def raw_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a raw row of its own: many copies per city and hour, with
    city keys that still need normalising."""
    value = {name: F.when(F.col("event_type") == kind, F.col("value")) for kind, name in EVENT_POLLUTANT.items()}
    return (
        table(spark, sf_dir, "events")
        .select(
            F.concat(F.lit(" ST"), F.col("user_id") % 3, F.lit(" ")).alias("city_id"),
            hour_start("ts").alias("observed_at"),
            *(column.alias(name) for name, column in value.items()),
            (value["o3"] * CO_PER_O3).alias("co"),
            F.col("event_type").alias("source"),
            F.col("ts").cast("timestamp").alias("ingested_at"),
            F.lpad(F.col("event_id").cast("string"), 12, "0").alias("run_id"),
        )
        .select(*RAW.names)
    )


def upsert_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All events split by type into a table and a batch, keyed by user and day."""
    keyed = table(spark, sf_dir, "events").select(
        "user_id", day_of("ts").alias("day"), "event_id", "ts", "event_type", "value"
    )
    in_table = F.col("event_type").isin("view", "click", "purchase")
    return keyed.filter(in_table), keyed.filter(~in_table)


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per user and day, some of them broken by the day of the month.

    Documents of day 21 do not say which city they are about.
    """
    hour = F.struct("observed_at", *POLLUTANTS)
    docs = (
        raw_hourly(spark, sf_dir, PER_USER)
        .groupBy("city_id", day_of("observed_at").alias("day"))
        .agg(F.array_sort(F.collect_list(hour)).alias("hours"))
    )
    month_day = F.dayofmonth("day")

    def series(name: str):
        return F.transform("hours", lambda h: h[name])

    def last_negative(values):
        return F.concat(F.slice(values, 1, F.size(values) - 1), F.array(F.lit(-0.75)))

    # API name -> (day of the month, damage)
    damaged = {
        "sulphur_dioxide": F.when(month_day == 3, F.slice(series("so2"), 2, F.size("hours"))),
        "nitrogen_dioxide": F.when(month_day.isin(6, 15), last_negative(series("no2"))),
        "carbon_monoxide": F.when(month_day == 12, F.lit(None)),
    }
    arrays = [
        (
            damaged[api].otherwise(series(name)) if api in damaged else series(name)
        ).alias(api)
        for api, name in API_FIELDS.items()
    ]
    unit = {
        api: F.lit(EXPECTED_UNIT) for api in API_FIELDS
    }
    # day 18 writes the micro sign, which is as good as the Greek letter
    unit["ozone"] = F.when(month_day == 18, "µg/m³").otherwise(EXPECTED_UNIT)
    unit["pm10"] = F.when(month_day.isin(9, 15), "ppb").otherwise(EXPECTED_UNIT)
    units = F.create_map(*(part for api, text in unit.items() for part in (F.lit(api), text)))
    return docs.select(
        F.when(month_day != 21, F.col("city_id")).alias("city_id"),
        F.lit(28.6).cast("double").alias("latitude"),
        F.lit(77.2).cast("double").alias("longitude"),
        F.lit("Asia/Kolkata").alias("timezone"),
        units.alias("hourly_units"),
        F.struct(series("observed_at").alias("time"), *arrays).alias("hourly"),
        F.lit(None).cast("double").alias("generationtime_ms"),
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as cities; all but the first three have no readings."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.concat(F.lit("st"), "n_nationkey").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.concat(F.lit("state "), "n_nationkey").alias("state"),
        F.col("r_name").alias("region"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        F.col("n_regionkey").cast("double").alias("longitude"),
    )


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long daily index series per order priority: mean order price in thousands."""
    hundredths = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("city_id"), day_of("o_orderdate").alias("observed_date"))
        .agg(
            F.floor(F.avg(hundredths) / 100000 + 0.5).cast("int").alias("aqi"),
            F.count("*").alias("orders"),
        )
        .withColumn("is_aqi_valid", F.lit(True))
    )


def order_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priorities as cities."""
    return (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderpriority").alias("city_id"))
        .distinct()
        .withColumn("city_name", F.substring_index("city_id", "-", -1))
    )
