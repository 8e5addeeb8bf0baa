"""Building the tables: the AQI fact, incrementally or in full, and the marts.

All tables of a run are published together (see ``tables``): they are written, checked
as written, and put in force by one snapshot.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import marts, quality
from ..operators.aqi import daily_aqi, day_id, score_days, with_trends
from ..operators.daily import pollutant_daily
from ..operators.staging import stage_hourly
from ..operators.upsert import align_schema
from ..schemas import FACT
from ..session import CheckFailure, scratch_run, stage
from ..sources.lake import late_days, open_table, read_raw
from . import audit, tables

LOOKBACK_DAYS = 3
CONTEXT_DAYS = 7
TAIL = T.StructType(
    [
        T.StructField("city_id", T.StringType()),
        T.StructField("observed_date", T.DateType()),
        T.StructField("aqi", T.IntegerType()),
        T.StructField("before", T.DateType()),
    ]
)
BUILDS = T.StructType(
    [
        T.StructField("began_at", T.TimestampType()),
        T.StructField("elapsed_s", T.DoubleType()),
        T.StructField("freshness", T.StringType()),
        # days older than the run computed that the lake changed, and whether they were computed again
        T.StructField("late_days", T.ArrayType(T.DateType())),
        T.StructField("late_recomputed", T.BooleanType()),
    ]
)
FACT_TABLE, TAIL_TABLE, CHECKED_TABLE = "daily_aqi", "daily_aqi_tail", "daily_aqi_checked"
# rows before a day that its 7-row mean looks at
TREND_ROWS = 6
TRENDS = ("aqi_change_vs_prev_day", "aqi_7d_avg")


class AuditFailed(CheckFailure):
    """A check failed, so nothing was published; ``results`` has every check."""

    def __init__(self, message: str, results: DataFrame):
        super().__init__(message)
        self.results = results


class StaleInput(RuntimeError):
    """The tables were built, but nothing new has reached the lake for too long."""


@dataclass(frozen=True)
class Bounds:
    """First day to compute, first day to write, and the newest day there was."""

    read_from: date
    write_from: date
    newest: date | None = field(default=None, compare=False)


def read_fact(spark: SparkSession, root: str, since: date | None = None) -> DataFrame:
    """The fact in force, optionally from a day on; columns that older days lack are null."""
    fact = tables.read(spark, root, FACT_TABLE, since)
    return spark.createDataFrame([], FACT) if fact is None else fact


def incremental_bounds(
    target: DataFrame, lookback: int = LOOKBACK_DAYS, context: int = CONTEXT_DAYS
) -> Bounds | None:
    """Bounds counted back from the newest day of the target, None if it is empty.

    The write bound includes its day: ``lookback + 1`` existing days are rewritten.
    """
    return bounds_before(target.agg(F.max("observed_date")).first()[0], lookback, context)


def bounds_before(last: date | None, lookback: int = LOOKBACK_DAYS, context: int = CONTEXT_DAYS) -> Bounds | None:
    if last is None:
        return None
    return Bounds(last - timedelta(days=lookback + context), last - timedelta(days=lookback), last)


def raw_from(spark: SparkSession, lake: str, first_day: date | None) -> DataFrame:
    """Raw rows for days from ``first_day`` on, plus one day of context for the
    8-hour windows that cross its midnight. Prunes lake folders."""
    return read_raw(spark, lake, first_day and first_day - timedelta(days=1))


def _last_rows(fact: DataFrame, before: date) -> DataFrame:
    """The rows of every city that the trends of its next days look at."""
    newest_first = W.partitionBy("city_id").orderBy(F.desc("observed_date"))
    return (
        fact.filter(F.col("observed_date") < F.lit(before))
        .select("city_id", "observed_date", "aqi")
        .withColumn("_back", F.row_number().over(newest_first))
        .filter(F.col("_back") <= TREND_ROWS)
        .drop("_back")
    )


def newest_day(publication: tables.Publication) -> date | None:
    """Last day of the fact, from the snapshot alone."""
    fact = publication.tables.get(FACT_TABLE)
    return fact and fact.newest_day()


def read_tail(publication: tables.Publication, bounds: Bounds) -> DataFrame | None:
    """Last rows before the read bound as the run before kept them; None if it kept none for this bound."""
    tail = publication.read(TAIL_TABLE)
    if tail is None:
        return None
    kept = tail.agg(F.min("before"), F.max("before")).first()
    return tail.drop("before") if tuple(kept) == (bounds.read_from, bounds.read_from) else None


def tail_after(
    fact: DataFrame,
    newest: date | None,
    bounds: Bounds | None,
    tail: DataFrame | None,
    lookback: int = LOOKBACK_DAYS,
    context: int = CONTEXT_DAYS,
) -> DataFrame | None:
    """Last rows of every city before the next run's read bound, of the fact as it is now.

    They come from those of this run and the days since; the history is scanned only
    if there is no tail to go on from. ``newest`` is the fact's last day.
    """
    if newest is None:
        return None
    before = newest - timedelta(days=lookback + context)
    after = fact.select("city_id", "observed_date", "aqi")
    if tail is not None:
        after = tail.unionByName(after.filter(F.col("observed_date") >= F.lit(bounds.read_from)))
    return _last_rows(after, before).withColumn("before", F.lit(before))


def incremental_rows(
    daily: DataFrame,
    fact: DataFrame,
    breakpoints: DataFrame,
    bounds: Bounds,
    tail: DataFrame | None = None,
    **limits: int,
) -> DataFrame:
    """Fact rows from the write bound on, equal to those of a full build.

    ``daily`` holds the days from the read bound on. Trends of cities with gaps reach
    further back: to the rows of ``tail``, or of the fact if there is no tail.
    """
    scored = score_days(daily, breakpoints, **limits)
    earlier = tail if tail is not None else _last_rows(fact, bounds.read_from)
    scored = scored.unionByName(earlier, allowMissingColumns=True)
    return (
        with_trends(scored)
        .filter(F.col("observed_date") >= F.lit(bounds.write_from))
        .select(*FACT.names)
    )


def daily_from(hourly: DataFrame, first_day: date | None) -> DataFrame:
    """Daily values of the days from ``first_day`` on; all if there is none."""
    daily = pollutant_daily(hourly)
    return daily if first_day is None else daily.filter(F.col("observed_date") >= F.lit(first_day))


def put_fact(
    publication: tables.Publication, rows: DataFrame, *, replace_all: bool = False, days: list[date] | None = None
) -> DataFrame:
    """Write rows into the fact by key and return the fact as it will be.

    Keys of the touched days that ``rows`` lack are kept, columns new to the table are
    appended to it. Nothing is overwritten: touched days get folders of the new version.
    ``days`` are the days of ``rows`` if the caller knows them.
    """
    stored = None if replace_all else publication.read(FACT_TABLE)
    if stored is None:
        return publication.put_days(FACT_TABLE, rows, "observed_date", ["city_id"], replace_all=True)
    rows = stage(rows, "fact-new")
    if days is None:
        # the calendar bounds what is collected
        days = [r[0] for r in rows.select("observed_date").distinct().collect()]
    merged = align_schema(rows, stored.schema)
    others = stored.filter(F.col("observed_date").isin(days)).join(rows.select("daily_aqi_id"), "daily_aqi_id", "left_anti")
    merged = merged.unionByName(others.select(*stored.columns), allowMissingColumns=True)
    return publication.put_days(FACT_TABLE, merged, "observed_date", ["city_id"])


def write_fact(rows: DataFrame, root: str) -> None:
    """Publish rows into the fact, by key."""
    spark = rows.sparkSession
    with scratch_run(spark, "write-fact"), tables.Publication(spark, root) as publication:
        put_fact(publication, rows)
        publication.commit(**publication.before.notes)


def put_rows(
    publication: tables.Publication,
    daily: DataFrame,
    breakpoints: DataFrame,
    bounds: Bounds | None,
    tail: DataFrame | None = None,
    **limits: int,
) -> DataFrame:
    """Compute and write the rows of a run: all, or those in bounds. Returns the fact as it will be."""
    fact = publication.read(FACT_TABLE)
    if fact is None or bounds is None:
        return put_fact(publication, daily_aqi(daily, breakpoints, **limits), replace_all=True)
    return put_fact(publication, incremental_rows(daily, fact, breakpoints, bounds, tail, **limits))


def put_late_days(
    publication: tables.Publication, hourly: DataFrame, breakpoints: DataFrame, late: list[date], **limits: int
) -> DataFrame:
    """Compute late days again, in place of the rows they have in the fact.

    ``hourly`` holds each late day with the day before and after: hours of a late day
    are in 8-hour windows of the next morning, and its own mornings look at the evening
    before. Trends change on those days and on the six rows of each city that follow;
    to find these, only keys and index of the fact are scanned.
    """
    changed = sorted({d + timedelta(days=n) for d in late for n in (0, 1)})
    fact = publication.read(FACT_TABLE)
    daily = pollutant_daily(hourly).filter(F.col("observed_date").isin(changed))
    scored = stage(score_days(daily, breakpoints, **limits), "late-days")
    others = fact.join(scored.select("daily_aqi_id"), "daily_aqi_id", "left_anti")
    narrow = scored.select("city_id", "observed_date", "aqi", F.lit(True).alias("_new")).unionByName(
        others.select("city_id", "observed_date", "aqi", F.lit(False).alias("_new"))
    )
    cities = narrow.join(scored.select("city_id").distinct(), "city_id", "left_semi")
    near = W.partitionBy("city_id").orderBy("observed_date").rowsBetween(-TREND_ROWS, 0)
    trends = with_trends(cities.withColumn("_moved", F.max("_new").over(near))).filter("_moved")
    trends = stage(trends.select("city_id", "observed_date", *TRENDS), "late-trends")
    columns = [c for c in FACT.names if c not in (*TRENDS, "updated_at")]
    moved = scored.select(*columns).unionByName(
        others.select(*columns).join(trends.select("city_id", "observed_date"), ["city_id", "observed_date"], "left_semi")
    )
    rows = moved.join(trends, ["city_id", "observed_date"]).withColumn("updated_at", F.current_timestamp())
    return put_fact(publication, rows.select(*FACT.names))


def build_fact(
    spark: SparkSession,
    lake: str,
    root: str,
    breakpoints: DataFrame,
    *,
    lookback: int = LOOKBACK_DAYS,
    context: int = CONTEXT_DAYS,
    full_refresh: bool = False,
    **limits: int,
) -> None:
    """Bring the fact up to date with the lake.

    Without a fact, or with ``full_refresh``, everything is computed. Otherwise
    only the look-back and newer days are; days before it change only through a
    full refresh, which a back-fill therefore needs.
    """
    with scratch_run(spark, "fact"), tables.Publication(spark, root) as publication:
        bounds = None if full_refresh else bounds_before(newest_day(publication), lookback, context)
        first_day = bounds and bounds.read_from
        hourly = stage_hourly(raw_from(spark, lake, first_day))
        tail = bounds and read_tail(publication, bounds)
        fact = put_rows(publication, daily_from(hourly, first_day), breakpoints, bounds, tail, **limits)
        after = tail_after(fact, newest_day(publication), bounds, tail, lookback, context)
        if after is not None:
            publication.put(TAIL_TABLE, after)
        publication.commit(**publication.before.notes)


def materialize(df: DataFrame, root: str, name: str) -> DataFrame:
    """Publish a mart as a table and return the table; readers see the old one until then."""
    with tables.Publication(df.sparkSession, root) as publication:
        written = publication.put(name, df)
        publication.commit(**publication.before.notes)
    return written


def require_pass(results: DataFrame) -> DataFrame:
    """Check results as a local table; raises if any check failed.

    There are as many rows as checks, so they are brought to the driver once.
    """
    rows = results.collect()
    results = results.sparkSession.createDataFrame(rows, results.schema)
    failed = sorted(row.check for row in rows if row.status != "pass")
    if failed:
        raise AuditFailed(f"{len(failed)} check(s) failed: {', '.join(failed)}", results)
    return results


def audit_then_publish(
    df: DataFrame,
    checks: Callable[[DataFrame], DataFrame],
    publish: Callable[[DataFrame], None],
) -> DataFrame:
    """Publish ``df`` only if every check on it passes; returns the results.

    ``checks`` maps the staged rows to check results. Rows are staged once, so
    what was checked is exactly what gets published.
    """
    with scratch_run(df.sparkSession, "audit"):
        staged = stage(df, "audit")
        results = require_pass(checks(staged))
        publish(staged)
    return results


def checked_fact(
    publication: tables.Publication, fact: DataFrame, cities_before: DataFrame | None, dim: DataFrame, today: date | None
) -> DataFrame:
    """Results of the fact's checks, with every day seen but only days read whose files changed.

    A published day passed its checks. What the publication before knew of it is a
    digest of its files, so a day is read again if a file was added, taken away or
    tampered with, or if it lies after ``today``; all days are if the list of cities lost
    one. Uniqueness needs no other day: a key holds its day, and an id is checked to be
    made of its key. If one is not, ids are compared over the whole fact.
    """
    now = publication.day_files(FACT_TABLE)
    known = publication.read(CHECKED_TABLE)
    lost = cities_before is None or not cities_before.join(dim, "city_id", "left_anti").isEmpty()
    rows = fact
    if known is not None and not lost:
        same = now.join(known, ["observed_date", "files"])
        last = F.lit(today) if today else F.current_date()
        # the calendar bounds what is collected
        days = {r.observed_date for r in same.filter(F.col("observed_date") <= last).select("observed_date").collect()}
        held = {date.fromisoformat(d) for d in publication.tables[FACT_TABLE].days if d < tables.NO_DAY}
        rows = fact.filter(F.col("observed_date").isin(sorted(held - days)) | F.col("observed_date").isNull())
        if not rows.filter(~F.col("daily_aqi_id").eqNullSafe(day_id())).isEmpty():
            rows = fact
    results = require_pass(audit.fact_checks(rows, dim, today))
    publication.put(CHECKED_TABLE, now)
    return results


def last_pass(snapshot: tables.Snapshot | None) -> datetime | None:
    """When the build began that wrote the snapshot in force; all its checks passed."""
    began = snapshot and snapshot.notes.get("began_at")
    return began and datetime.fromisoformat(began)


def read_builds(spark: SparkSession, root: str) -> DataFrame:
    """One row for each build that passed: when, how long, freshness, late days."""
    builds = open_table(spark, f"{root}/builds", BUILDS)
    return spark.createDataFrame([], BUILDS) if builds is None else builds


def late_days_reported(spark: SparkSession, root: str) -> DataFrame:
    """Days that the last build found changed in the lake, and whether it computed them again."""
    last = read_builds(spark, root).agg(F.max_by(F.struct("late_days", "late_recomputed"), "began_at").alias("last"))
    return last.select(F.explode("last.late_days").alias("observed_date"), F.col("last.late_recomputed").alias("recomputed"))


def build(
    spark: SparkSession,
    lake: str,
    root: str,
    cities: DataFrame,
    breakpoints: DataFrame,
    *,
    full_refresh: bool = False,
    recompute_late: bool = False,
    today: date | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """Build and audit every layer in dependency order; returns the check results.

    Tables are written to folders of a new version and checked there; one snapshot
    puts all of them in force at the end. A failed check, or a run that dies, leaves
    readers with the tables they had. Hourly and daily rows have several consumers here,
    so each is computed once.

    An incremental run computes the look-back with its context. Its audit sees that
    and the days that were landed since the last build that passed, however old they
    are; no other folder of the lake is opened. Such late days are recorded with the
    build, and with ``recompute_late`` computed again, with the trends of the rows
    after them. The fact is audited whole (see ``checked_fact``). If the tables are built but the newest
    readings are too old, ``StaleInput`` is raised; whether they pass, or should be
    looked at, is recorded with the build.
    """
    began = spark.range(1).select(F.current_timestamp().alias("began_at")).first()["began_at"]
    with scratch_run(spark, "build"), tables.Publication(spark, root) as publication:
        bounds = None if full_refresh else bounds_before(newest_day(publication))
        first_day = bounds and bounds.read_from
        first_read = first_day and first_day - timedelta(days=1)
        since = last_pass(publication.before)
        late = late_days(spark, lake, first_read, since) if first_read and since else []
        around = [d + timedelta(days=n) for d in late for n in (-1, 0, 1)] if recompute_late else late
        # a fact without a build that passed was never audited with its lake: see all of it
        raw = read_raw(spark, lake, first_read if since else None, around)
        raw, source_results = quality.observed_results("raw", raw, audit.source_rows())
        hourly = stage(stage_hourly(raw), "hourly")
        results = [require_pass(source_results())]
        results.append(require_pass(audit.staging_checks(hourly, cities)))
        daily = stage(daily_from(hourly, first_day), "daily")
        results.append(require_pass(audit.daily_checks(daily)))
        cities_before = publication.read("dim_city")
        dim = publication.put("dim_city", marts.dim_city(cities))
        results.append(require_pass(audit.dim_checks(dim)))
        tail = bounds and read_tail(publication, bounds)
        if late and recompute_late:
            put_late_days(publication, hourly, breakpoints, late)
            tail = None
        fact = put_rows(publication, daily, breakpoints, bounds, tail)
        results.append(checked_fact(publication, fact, cities_before, dim, today))
        summary = publication.put("city_summary", marts.city_summary(fact, dim))
        results.append(require_pass(audit.summary_checks(summary)))
        shifts = publication.put("level_shifts", marts.level_shifts(fact))
        results.append(require_pass(audit.shift_checks(shifts, dim)))
        after = tail_after(fact, newest_day(publication), bounds, tail)
        if after is not None:
            publication.put(TAIL_TABLE, after)
        fresh = quality.freshness(read_raw(spark, lake, first_read), now).first()
        publication.commit(began_at=began.isoformat())

    elapsed = (F.current_timestamp().cast("double") - F.lit(began).cast("double")).alias("elapsed_s")
    run = spark.createDataFrame(
        [(began, None, fresh["status"], late, bool(late) and recompute_late)], BUILDS
    )
    run.withColumn("elapsed_s", elapsed).select(*BUILDS.names).write.mode("append").parquet(f"{root}/builds")
    if fresh["status"] == "error":
        raise StaleInput(f"the newest readings were loaded at {fresh['max_loaded_at']}")
    return reduce(DataFrame.unionByName, results)
