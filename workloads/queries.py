"""The registered queries: every operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vayumark import sources
from vayumark.functions import aqi_category, category_ordinal, day_of
from vayumark.operators import aqi, daily, marts, quality, rolling, staging, upsert
from vayumark.operators import payloads as contract
from vayumark.operators.quality import RowCheck, TableCheck
from vayumark.plans import audit, build, landing, report, tables
from vayumark.schemas import RAW
from vayumark.session import local_scratch, scratch_path, stage
from vayumark.streaming import ingest_arrivals
from . import adapters

Query = Callable[[SparkSession, str], DataFrame]

# A moment that is already 21 January on the cities' clock.
NOW = datetime(2024, 1, 20, 20, 0)
# 36 hours after the last events: late, but not too late.
CHECKED_AT = datetime(2024, 2, 1, 12, 0)
SHIFT_LIMITS = {"threshold": 50, "k": 1.0}

REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query; a local session without a scratch folder gets one first."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        local_scratch(spark)
        return function(spark, sf_dir)

    REGISTRY[function.__name__] = run
    return run


def hourly(spark: SparkSession, sf_dir: str, city: str = adapters.STATION) -> DataFrame:
    return staging.stage_hourly(adapters.raw_hourly(spark, sf_dir, city))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aqi.daily_aqi(daily.pollutant_daily(hourly(spark, sf_dir)), sources.read_breakpoints(spark))


def fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as a table, which is what marts and reports read."""
    return stage(fact(spark, sf_dir), "fact")


def compared(table: DataFrame) -> DataFrame:
    """Without the column that holds the time of the run."""
    return table.drop("updated_at")


# Staging, deduplication, upsert


@query
def stage_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staging.stage_hourly(adapters.raw_copies(spark, sf_dir))
    return staged.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


@query
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapters.table(spark, sf_dir, "events").select(
        "user_id", "event_type", "ts", "event_id", "value"
    )
    return staging.dedupe_latest(events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])


@query
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, batch = adapters.upsert_sides(spark, sf_dir)
    target = staging.newest_reading(stored, ["user_id", "day"], "ts")
    return upsert.upsert_latest(target, batch, ["user_id", "day"], "ts")


@query
def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, batch = adapters.upsert_sides(spark, sf_dir)
    target = staging.newest_reading(stored, ["user_id", "day"], "ts")
    return upsert.upsert_counts(target, batch, ["user_id", "day"], "ts")


@query
def conform_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapters.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("CITY_ID"),
        F.col("ts").alias("Observed_At"),
        F.col("value").cast("string").alias("PM2_5"),
        F.col("event_id").alias("extra"),
    )
    matched = upsert.conform(events, RAW)
    return matched.select("city_id", "observed_at", "pm2_5", "pm10", "run_id")


# Payloads


def received(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload documents at rest, as ingestion finds them."""
    return stage(adapters.payloads(spark, sf_dir), "payloads")


@query
def payload_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = contract.split_valid(received(spark, sf_dir))
    return contract.flatten_payload(good)


@query
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.contract_violations(received(spark, sf_dir))


@query
def payload_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents written as JSON and read with the payload schema."""
    path = scratch_path(spark, "json")
    adapters.payloads(spark, sf_dir).write.option(
        "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm"
    ).json(path)
    good, _ = contract.split_valid(sources.read_payloads(spark, path, multi_line=False))
    return contract.flatten_payload(good)


@query
def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage as a run without an id of its own makes it."""
    events = adapters.table(spark, sf_dir, "events").select("event_id")
    stamped = landing.stamp_lineage(events, "events", now=NOW)
    return stamped.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


@query
def cities_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "cities")
    adapters.cities(spark, sf_dir).write.option("header", True).csv(path)
    return sources.read_cities(spark, path)


# Daily pollutant values


@query
def daily_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.daily_averages(hourly(spark, sf_dir, adapters.PER_USER))


@query
def rolling_8h(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = daily.rolling_8h(hourly(spark, sf_dir, adapters.PER_USER))
    return windows.select(
        "city_id",
        "observed_date",
        "observed_at",
        F.round("o3_8h_avg", 9).alias("o3_8h_avg"),
        "o3_8h_hours",
        F.round("co_8h_avg", 9).alias("co_8h_avg"),
        "co_8h_hours",
    )


@query
def rolling_any_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same window over events at arbitrary times, not on the hour."""
    events = adapters.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    windows = rolling.rolling_mean(events, ["user_id"], "ts", 8, {"value": "value"})
    return windows.select(
        "user_id",
        "event_id",
        F.round("value_8h_avg", 9).alias("value_8h_avg"),
        "value_8h_hours",
    )


@query
def rolling_outlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few huge values among the events must not reach windows that do not hold them."""
    spike = F.when(F.col("event_id") % 997 == 0, F.lit(2.0**100)).otherwise(F.col("value"))
    events = adapters.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", spike.alias("value"))
    windows = rolling.rolling_mean(events, ["user_id"], "ts", 8, {"value": "value"})
    mean = F.col("value_8h_avg")
    return windows.select(
        "user_id",
        "event_id",
        "value_8h_hours",
        (mean > 1e20).alias("spiked"),
        F.when(mean < 1e20, F.round(mean, 9)).alias("value_8h_avg"),
    )


@query
def daily_rolling_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.daily_rolling_max(daily.rolling_8h(hourly(spark, sf_dir)))


@query
def pollutant_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.pollutant_daily(hourly(spark, sf_dir))


# Index


@query
def unpivot_pollutants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aqi.unpivot_pollutants(daily.pollutant_daily(hourly(spark, sf_dir)))


@query
def sub_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = aqi.unpivot_pollutants(daily.pollutant_daily(hourly(spark, sf_dir)))
    return aqi.sub_indices(values, sources.read_breakpoints(spark))


@query
def per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aqi.per_day(sub_indices(spark, sf_dir))


@query
def daily_aqi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(fact(spark, sf_dir))


@query
def aqi_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = F.when(F.col("orders") > 1, F.col("aqi"))
    series = adapters.order_series(spark, sf_dir).withColumn("aqi", measured)
    return compared(aqi.with_trends(series.select("city_id", "observed_date", "aqi")))


@query
def category_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = adapters.order_series(spark, sf_dir).select(
        "city_id", "observed_date", "aqi", aqi_category("aqi").alias("aqi_category")
    )
    return labelled.withColumn("category_ordinal", category_ordinal("aqi_category"))


@query
def incremental_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact built early, on readings corrected later, then brought up to date."""
    lake, path = scratch_path(spark, "lake"), scratch_path(spark, "fact")
    readings = adapters.raw_hourly(spark, sf_dir)
    day = day_of("observed_at")
    wrong = F.when(day >= date(2024, 1, 19), F.col("pm2_5") / 2).otherwise(F.col("pm2_5"))
    early = readings.filter(day <= date(2024, 1, 20)).withColumn("pm2_5", wrong)
    landing.land(early, lake)
    build.build_fact(spark, lake, path, sources.read_breakpoints(spark))
    landing.land(readings.filter(day >= date(2024, 1, 19)), lake)
    build.build_fact(spark, lake, path, sources.read_breakpoints(spark))
    return compared(build.read_fact(spark, path))


@query
def backfill_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half of the history first, then the first half and a full refresh."""
    lake, path = scratch_path(spark, "lake"), scratch_path(spark, "fact")
    readings = adapters.raw_hourly(spark, sf_dir)
    second_half = day_of("observed_at") >= date(2024, 1, 16)
    landing.land(readings.filter(second_half), lake)
    build.build_fact(spark, lake, path, sources.read_breakpoints(spark))
    landing.land(readings.filter(~second_half), lake)
    build.build_fact(spark, lake, path, sources.read_breakpoints(spark), full_refresh=True)
    return compared(build.read_fact(spark, path))


# Marts


@query
def dim_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_city(adapters.cities(spark, sf_dir))


@query
def latest_per_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.latest_per_city(fact_table(spark, sf_dir))


@query
def city_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.city_summary(fact_table(spark, sf_dir), dim_city(spark, sf_dir))


@query
def level_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.level_shifts(adapters.order_series(spark, sf_dir), **SHIFT_LIMITS)


@query
def valid_level_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the default limits, on a series that has invalid days and a step in the middle."""
    step = F.when(F.col("observed_date") >= date(1995, 6, 17), 900).otherwise(0)
    series = adapters.order_series(spark, sf_dir).withColumns(
        {"is_aqi_valid": F.col("orders") > 1, "aqi": F.col("aqi") + step}
    )
    return marts.level_shifts(series)


@query
def named_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.named_shifts(level_shifts(spark, sf_dir), adapters.order_cities(spark, sf_dir))


@query
def shift_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.shift_groups(level_shifts(spark, sf_dir))


@query
def shift_groups_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.shift_groups(level_shifts(spark, sf_dir), by=["city_id"], gap_days=30)


@query
def shift_group_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.shift_group_members(level_shifts(spark, sf_dir))


# Report data sets


@query
def history_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.history_stats(hourly(spark, sf_dir, adapters.PER_USER))


@query
def history_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as shown, of a history with some made-up readings."""
    made_up = F.when(F.hour("observed_at") == 3, report.SYNTHETIC_SOURCE).otherwise(F.col("source"))
    rows = hourly(spark, sf_dir, adapters.PER_USER).withColumn("source", made_up)
    return report.history_labels(report.history_stats(rows))


@query
def recent_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.recent_daily(fact_table(spark, sf_dir), dim_city(spark, sf_dir))


@query
def recent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 90-day cut on a series that is longer than that."""
    scored = aqi.with_trends(adapters.order_series(spark, sf_dir))
    series = scored.withColumns(
        {"aqi_category": aqi_category("aqi"), "dominant_pollutant": F.lit("pm10")}
    )
    return report.recent_daily(series, adapters.order_cities(spark, sf_dir))


@query
def heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.heatmap(recent_daily(spark, sf_dir))


@query
def latest_dominant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.latest_dominant(recent_daily(spark, sf_dir))


@query
def summary_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.summary_table(city_summary(spark, sf_dir))


@query
def kpi_worst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.kpi_worst(city_summary(spark, sf_dir))


@query
def kpi_cleanest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.kpi_cleanest(city_summary(spark, sf_dir))


@query
def kpi_poor_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = report.history_stats(hourly(spark, sf_dir))
    return report.kpi_poor_cities(city_summary(spark, sf_dir), stats)


@query
def latest_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, dim = fact_table(spark, sf_dir), dim_city(spark, sf_dir)
    return report.latest_bars(marts.city_summary(facts, dim), report.recent_daily(facts, dim))


# Data quality


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.check_not_null(adapters.raw_copies(spark, sf_dir), "pm2_5")
    return found.select("run_id", "source")


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_unique(adapters.table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def dq_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = adapters.table(spark, sf_dir, "lineitem")
    return quality.check_unique_combination(lines, ["l_orderkey", "l_linenumber"])


@query
def dq_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapters.table(spark, sf_dir, "events")
    return quality.check_range(events, "value", 5, 100).select("event_id", "value")


@query
def dq_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapters.table(spark, sf_dir, "events")
    known = ["view", "click", "purchase", "signup"]
    return quality.check_accepted(events, "event_type", known).select("event_id", "event_type")


@query
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = adapters.table(spark, sf_dir, "lineitem")
    solvent = adapters.table(spark, sf_dir, "supplier").filter("s_acctbal > 0")
    return quality.check_relationships(lines, solvent, "l_suppkey", "s_suppkey")


def mislabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order series whose labels were made for a value ten points higher."""
    return adapters.order_series(spark, sf_dir).select(
        aqi.day_id().alias("daily_aqi_id"),
        "city_id",
        "observed_date",
        "aqi",
        aqi_category("(aqi + 10)").alias("aqi_category"),
    )


@query
def dq_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_category(mislabelled(spark, sf_dir))


@query
def dq_no_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_no_future(mislabelled(spark, sf_dir), date(1999, 6, 30))


@query
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = quality.freshness(adapters.raw_copies(spark, sf_dir), CHECKED_AT)
    return newest.withColumn("max_loaded_at", F.col("max_loaded_at").cast("timestamp_ntz"))


@query
def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several checks of two models in one pass each."""
    lines = adapters.table(spark, sf_dir, "lineitem")
    series = mislabelled(spark, sf_dir)
    return quality.check_results(
        {
            "lineitem": (
                lines,
                [
                    RowCheck("l_suppkey not null", quality.is_missing("l_suppkey")),
                    RowCheck("l_quantity in range", quality.out_of_range("l_quantity", 1, 40)),
                    RowCheck("l_returnflag accepted", quality.not_accepted("l_returnflag", ["A", "N"])),
                ],
            ),
            "order_series": (
                series,
                [
                    RowCheck("aqi_category matches aqi", quality.wrong_category()),
                    RowCheck("aqi in range", quality.out_of_range("aqi", 0, 500)),
                ],
            ),
        },
        {
            "lineitem": [
                TableCheck(
                    "l_orderkey + l_linenumber unique",
                    quality.check_unique_combination(lines, ["l_orderkey", "l_linenumber"]),
                )
            ],
            "order_series": [
                TableCheck("daily_aqi_id unique", quality.check_unique(series, "daily_aqi_id"))
            ],
        },
    )


@query
def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    took = F.lit(95.27).alias("elapsed_s")
    builds = adapters.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("began_at"), took)
    first = builds.orderBy("began_at").limit(1)
    panel = report.health_panel(
        dq_results(spark, sf_dir), adapters.raw_copies(spark, sf_dir), first, CHECKED_AT, sources=["lineitem"]
    )
    return panel.withColumn("failed", F.concat_ws(", ", "failed"))


# Lake and tables: written to the shared scratch folder and read back


@query
def land_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything landed, then one city's last days again in a second run."""
    lake = scratch_path(spark, "lake")
    readings = adapters.raw_hourly(spark, sf_dir)
    landing.land(readings, lake)
    late = (F.col("city_id") == "st1") & (day_of("observed_at") >= date(2024, 1, 25))
    again = readings.filter(late).withColumns({"pm10": F.col("pm10") + 1, "run_id": F.lit("r2")})
    landing.land(again, lake)
    return sources.read_raw(spark, lake).select("city_id", "observed_at", "pm2_5", "pm10", "run_id")


@query
def merge_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single readings merged into the lake; the older ones among them are ignored."""
    lake = scratch_path(spark, "lake")
    readings = adapters.raw_hourly(spark, sf_dir)
    landing.merge_into_lake(readings, lake)
    older = F.hour("observed_at") < 12
    shifted = F.when(older, F.col("ingested_at") - F.expr("interval 1 day")).otherwise(
        F.col("ingested_at")
    )
    batch = readings.withColumns({"ingested_at": shifted, "run_id": F.lit("r2")})
    landing.merge_into_lake(batch, lake)
    return sources.read_raw(spark, lake).select("city_id", "observed_at", "pm2_5", "run_id")


@query
def land_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads ingested: the valid ones landed, violations kept aside."""
    lake = scratch_path(spark, "lake")
    landing.ingest_payloads(adapters.payloads(spark, sf_dir), lake, "payloads", "r1", strict=False)
    return sources.read_raw(spark, lake).drop("ingested_at")


@query
def ingest_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingestion that fails, with what it says is wrong and how much it landed before."""
    lake = scratch_path(spark, "lake")
    try:
        landing.ingest_payloads(adapters.payloads(spark, sf_dir), lake, "payloads", "r1")
    except contract.ContractError as error:
        landed = sources.read_raw(spark, lake).select(F.count("*")).scalar()
        found = error.errors.groupBy("field", "problem").agg(F.count("*").alias("documents"))
        return found.withColumn("rows_landed", landed)
    raise AssertionError("broken payloads passed")


@query
def arriving_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload files that arrive in two drops, ingested by one run after each and one that finds nothing new."""
    path, lake, state = (scratch_path(spark, name) for name in ("inbox", "lake", "arrivals"))
    documents = received(spark, sf_dir)
    first = F.coalesce(F.dayofmonth(F.array_min("hourly.time")) <= 15, F.lit(True))
    for drop in (documents.filter(first), documents.filter(~first), documents.limit(0)):
        drop.write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm").json(path)
        ingest_arrivals(spark, path, lake, "payloads", state, strict=False, multi_line=False)
    return sources.read_raw(spark, lake).drop("ingested_at", "run_id")


@query
def read_lake_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_path(spark, "lake")
    landing.land(adapters.raw_hourly(spark, sf_dir), lake)
    wanted = [date(2024, 1, 5), date(2024, 1, 17), date(2025, 7, 1)]
    return sources.read_days(spark, lake, wanted).select("city_id", "observed_at", "pm2_5")


@query
def read_lake_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_path(spark, "lake")
    landing.land(adapters.raw_hourly(spark, sf_dir), lake)
    return sources.read_raw(spark, lake, date(2024, 1, 11)).select("city_id", "observed_at", "pm2_5")


@query
def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_path(spark, "lake")
    landing.land(adapters.raw_hourly(spark, sf_dir), lake)
    return sources.raw_file_count(spark, lake)


@query
def lake_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a landed lake, and those named after the codec."""
    lake = scratch_path(spark, "lake")
    landing.land(adapters.raw_hourly(spark, sf_dir), lake)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(lake).select("path")
    return files.agg(
        F.count("*").alias("files"), F.count_if(F.col("path").endswith(".zstd.parquet")).alias("zstd_files")
    )


@query
def audit_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact published after its checks passed."""
    path = scratch_path(spark, "fact")
    dim = dim_city(spark, sf_dir)
    build.audit_then_publish(
        fact(spark, sf_dir),
        lambda rows: audit.fact_checks(rows, dim),
        lambda rows: build.write_fact(rows, path),
    )
    return compared(build.read_fact(spark, path))


@query
def schema_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact whose later rows bring a new column."""
    path = scratch_path(spark, "fact")
    rows = fact(spark, sf_dir)
    build.write_fact(rows.filter(F.col("observed_date") < date(2024, 1, 16)), path)
    weekend = rows.withColumn("is_weekend", F.weekday("observed_date") >= 5)
    build.write_fact(weekend.filter(F.col("observed_date") >= date(2024, 1, 12)), path)
    grown = build.read_fact(spark, path)
    return grown.select("daily_aqi_id", "observed_date", "aqi", "is_weekend")


@query
def build_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake, fact, marts and all declared checks; the summary read back."""
    lake, root = scratch_path(spark, "lake"), scratch_path(spark, "tables")
    landing.land(adapters.raw_hourly(spark, sf_dir), lake)
    build.build(
        spark, lake, root, adapters.cities(spark, sf_dir), sources.read_breakpoints(spark), now=CHECKED_AT
    )
    return tables.read(spark, root, "city_summary")


@query
def declared_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of all declared checks after a full build."""
    lake, root = scratch_path(spark, "lake"), scratch_path(spark, "tables")
    landing.land(adapters.raw_hourly(spark, sf_dir), lake)
    return build.build(
        spark, lake, root, adapters.cities(spark, sf_dir), sources.read_breakpoints(spark), now=CHECKED_AT
    )


@query
def late_bad_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad readings landed on an old day after a build: the checks that the next build fails."""
    lake, root = scratch_path(spark, "lake"), scratch_path(spark, "tables")
    readings = adapters.raw_hourly(spark, sf_dir)
    landing.land(readings, lake)
    args = (spark, lake, root, adapters.cities(spark, sf_dir), sources.read_breakpoints(spark))
    build.build(*args, now=CHECKED_AT)
    old = readings.filter((day_of("observed_at") == date(2024, 1, 5)) & (F.col("city_id") == "st1"))
    landing.land(old.withColumn("pm10", F.lit(99999.0)), lake)
    try:
        build.build(*args, now=CHECKED_AT)
    except build.AuditFailed as error:
        return error.results.filter("status = 'fail'")
    raise AssertionError("a bad old day passed")


@query
def failed_build_keeps_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build that fails at the fact (half-hourly readings) leaves the tables of the one before."""
    lake, root = scratch_path(spark, "lake"), scratch_path(spark, "tables")
    readings = adapters.raw_hourly(spark, sf_dir)
    landing.land(readings, lake)
    args = (spark, lake, root, adapters.cities(spark, sf_dir), sources.read_breakpoints(spark))
    build.build(*args, now=CHECKED_AT)
    half_past = readings.withColumn("observed_at", F.col("observed_at") + F.expr("interval 30 minutes"))
    landing.land(readings.union(half_past).filter(day_of("observed_at") >= date(2024, 1, 28)), lake)
    try:
        build.build(*args, now=CHECKED_AT)
    except build.AuditFailed:
        return compared(build.read_fact(spark, root))
    raise AssertionError("too many hours a day passed")


@query
def bucketed_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``land_reload``, in a lake with hash buckets of cities; a merge of unchanged readings adds nothing."""
    lake = scratch_path(spark, "lake")
    readings = adapters.raw_hourly(spark, sf_dir)
    landing.land(readings, lake, buckets=8)
    late = (F.col("city_id") == "st1") & (day_of("observed_at") >= date(2024, 1, 25))
    again = readings.filter(late).withColumns({"pm10": F.col("pm10") + 1, "run_id": F.lit("r2")})
    landing.land(again, lake)
    landing.merge_into_lake(again, lake)
    return sources.read_raw(spark, lake).select("city_id", "observed_at", "pm2_5", "pm10", "run_id")


@query
def lake_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger of a lake says of two loads: rows by day and run of those that ended."""
    lake = scratch_path(spark, "lake")
    readings = adapters.raw_hourly(spark, sf_dir)
    landing.land(readings, lake)
    landing.land(readings.filter(day_of("observed_at") >= date(2024, 1, 25)).withColumn("run_id", F.lit("r2")), lake)
    ended = sources.ledger(spark, lake).filter("state = 'done'")
    return ended.groupBy("date", "run_id").agg(F.sum("rows").alias("rows"))


def built_then_changed(spark: SparkSession, sf_dir: str):
    """Tables built on readings of which one old day is wrong, and the right ones landed afterwards."""
    lake, root = scratch_path(spark, "lake"), scratch_path(spark, "tables")
    readings = adapters.raw_hourly(spark, sf_dir)
    old = day_of("observed_at") == date(2024, 1, 5)
    landing.land(readings.withColumn("pm10", F.when(old, F.col("pm10") / 2).otherwise(F.col("pm10"))), lake)
    args = (spark, lake, root, adapters.cities(spark, sf_dir), sources.read_breakpoints(spark))
    build.build(*args, now=CHECKED_AT)
    landing.land(readings.filter(old), lake)
    return args


@query
def late_days_reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days that a build finds changed behind its look-back."""
    args = built_then_changed(spark, sf_dir)
    build.build(*args, now=CHECKED_AT)
    return build.late_days_reported(spark, args[2])


@query
def late_days_recomputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after a build that computed them again: that of a full refresh."""
    args = built_then_changed(spark, sf_dir)
    build.build(*args, now=CHECKED_AT, recompute_late=True)
    return compared(build.read_fact(spark, args[2]))


@query
def dead_run_keeps_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that dies after some of its tables are written: readers see the set before."""
    root = scratch_path(spark, "tables")
    rows, dim = fact(spark, sf_dir), dim_city(spark, sf_dir)
    build.write_fact(rows, root)
    build.materialize(dim, root, "dim_city")
    try:
        with tables.Publication(spark, root) as publication:
            publication.put("dim_city", dim.limit(0))
            build.put_fact(publication, rows.withColumn("aqi", F.lit(-1)), replace_all=True)
            raise InterruptedError("between two writes")
    except InterruptedError:
        known = tables.read(spark, root, "dim_city").select("city_id")
        return compared(build.read_fact(spark, root)).join(known, "city_id", "left_semi")


@query
def tampered_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows copied into the files of an old published day: the checks that the next incremental build fails."""
    lake, root = scratch_path(spark, "lake"), scratch_path(spark, "tables")
    landing.land(adapters.raw_hourly(spark, sf_dir), lake)
    args = (spark, lake, root, adapters.cities(spark, sf_dir), sources.read_breakpoints(spark))
    build.build(*args, now=CHECKED_AT)
    version = tables.current(spark, root).tables["daily_aqi"].days["2024-01-05"]
    copies = stage(build.read_fact(spark, root).filter(F.col("observed_date") == date(2024, 1, 5)).drop("observed_date"), "copies")
    copies.write.mode("append").parquet(f"{root}/daily_aqi/version={version}/observed_date=2024-01-05")
    try:
        build.build(*args, now=CHECKED_AT)
    except build.AuditFailed as error:
        return error.results.filter("status = 'fail'")
    raise AssertionError("copied rows passed")


@query
def run_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When rows of the fact were written: never null, and within the run."""
    root = scratch_path(spark, "tables")
    before = spark.range(1).select(F.current_timestamp().alias("at")).first()["at"]
    build.write_fact(fact(spark, sf_dir), root)
    stamped = F.col("updated_at").isNotNull() & (F.col("updated_at") >= F.lit(before)) & (F.col("updated_at") <= F.current_timestamp())
    return build.read_fact(spark, root).select("daily_aqi_id", F.coalesce(stamped, F.lit(False)).alias("stamped"))


# Day windows


@query
def finished_days_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = adapters.table(spark, sf_dir, "events").withColumn("date", day_of("ts"))
    return sources.finished_days_only(days, now=NOW).select("event_id", "date")


@query
def last_finished_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = adapters.table(spark, sf_dir, "events").withColumn("date", day_of("ts"))
    return sources.last_finished_days(days, 3, now=NOW).select("event_id", "date")
