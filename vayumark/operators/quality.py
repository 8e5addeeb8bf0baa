"""Data checks. Each returns the offending rows; no rows means the check passes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import aqi_category
from ..functions.timeparts import instant

FRESH_WARN_HOURS = 30
FRESH_ERROR_HOURS = 54


# Conditions that hold for an offending row. Null values pass all but `is_missing`.


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def out_of_range(column: str, low: float, high: float) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def not_accepted(column: str, values: Sequence[str]) -> Column:
    return ~F.col(column).isin(*values)


def wrong_category(aqi: str = "aqi", category: str = "aqi_category") -> Column:
    return F.col(aqi).isNotNull() & (F.col(category) != aqi_category(aqi))


def in_future(day: str = "observed_date", today: date | None = None) -> Column:
    return F.col(day) > (F.current_date() if today is None else F.lit(today))


# The checks themselves.


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_missing(column))


def check_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.filter(out_of_range(column, low, high))


def check_accepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(not_accepted(column, values))


def check_category(fact: DataFrame) -> DataFrame:
    """The category label must agree with the number."""
    return fact.filter(wrong_category()).select("daily_aqi_id", "aqi", "aqi_category")


def check_no_future(fact: DataFrame, today: date | None = None) -> DataFrame:
    """Only days that have happened are stored."""
    return fact.filter(in_future(today=today)).select("daily_aqi_id", "observed_date")


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once, with their number ``n``."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls are ignored."""
    return check_unique_combination(df.filter(F.col(column).isNotNull()), [column])


def check_relationships(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None
) -> DataFrame:
    """Child keys absent from the parent, with their number of rows ``n``.

    Keys are counted before the join, so a key held by many child rows reaches
    it once.
    """
    keys = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key or key).alias(key))
    return keys.join(known, key, "left_anti")


def freshness(
    raw: DataFrame,
    now: datetime | None = None,
    *,
    warn_hours: int = FRESH_WARN_HOURS,
    error_hours: int = FRESH_ERROR_HOURS,
) -> DataFrame:
    """Newest ingestion time and whether it is too old: pass, warn or error."""
    age = (instant(now).cast("double") - F.col("max_loaded_at").cast("double")) / 3600
    status = (
        F.when(F.col("max_loaded_at").isNull() | (age > error_hours), "error")
        .when(age > warn_hours, "warn")
        .otherwise("pass")
    )
    return raw.agg(F.max("ingested_at").alias("max_loaded_at")).withColumn("status", status)


@dataclass(frozen=True)
class RowCheck:
    """A check decided on each row alone."""

    name: str
    offending: Column


@dataclass(frozen=True)
class TableCheck:
    """A check that needs several rows or tables, as its offending rows."""

    name: str
    offending: DataFrame


def run_row_checks(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """Failures of many row checks from a single scan."""
    counts = df.agg(*(F.count_if(c.offending).alias(f"c{i}") for i, c in enumerate(checks)))
    return counts.select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(c.name).alias("check"), F.col(f"c{i}").alias("failures"))
                    for i, c in enumerate(checks)
                )
            )
        )
    )


def run_table_checks(checks: Sequence[TableCheck]) -> DataFrame:
    """Failures of checks given as offending rows."""
    results = [
        c.offending.agg(F.count("*").alias("failures")).select(
            F.lit(c.name).alias("check"), "failures"
        )
        for c in checks
    ]
    combined = results[0]
    for result in results[1:]:
        combined = combined.unionByName(result)
    return combined


def check_results(
    rows: Mapping[str, tuple[DataFrame, Sequence[RowCheck]]],
    tables: Mapping[str, Sequence[TableCheck]],
) -> DataFrame:
    """Results of all checks: model, check, failures, status.

    Each table is scanned once for all its row checks; the whole is one
    DataFrame, so Spark runs it as one job.
    """
    parts = [
        run_row_checks(df, checks).select(F.lit(model).alias("model"), "check", "failures")
        for model, (df, checks) in rows.items()
    ] + [
        run_table_checks(checks).select(F.lit(model).alias("model"), "check", "failures")
        for model, checks in tables.items()
        if checks
    ]
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return _with_status(combined)


def grouped_results(
    model: str,
    df: DataFrame,
    rows: Sequence[RowCheck],
    unique: Sequence[tuple[str, ...]] = (),
    known: tuple[str, DataFrame] | None = None,
) -> DataFrame:
    """Results of row checks, uniqueness and known keys of one table from one scan of it.

    The rows are grouped by every key at once (grouping sets), after partial
    aggregation. Nulls are ignored where the key is a single column. ``known`` is a
    column and the table that must hold its values.
    """
    sets = [*unique, *([(known[0],)] if known else [])] or [(df.columns[0],)]
    columns = list(dict.fromkeys(c for s in sets for c in s))
    counted = df.select(*columns, *(c.offending.cast("int").alias(f"_c{i}") for i, c in enumerate(rows)))
    grouped = counted.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.count("*").alias("_n"),
        F.grouping_id().alias("_set"),
        *(F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(rows))),
    )
    number = [sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s) for s in sets]
    failures = [(c.name, F.sum(F.when(F.col("_set") == number[0], F.col(f"_c{i}")))) for i, c in enumerate(rows)]
    for n, s in zip(number, unique, strict=False):
        twice = (F.col("_set") == n) & (F.col("_n") > 1)
        if len(s) == 1:
            twice = twice & F.col(s[0]).isNotNull()
        failures.append((f"{' + '.join(s)} unique", F.count_if(twice)))
    if known:
        key, parent = known
        there = parent.select(F.col(key).alias("_known")).distinct()
        grouped = grouped.join(there, (F.col("_set") == number[-1]) & (F.col(key) == F.col("_known")), "left")
        orphan = (F.col("_set") == number[-1]) & F.col(key).isNotNull() & F.col("_known").isNull()
        failures.append((f"{key} known", F.count_if(orphan)))
    counts = grouped.agg(*(F.coalesce(n, F.lit(0)).cast("long").alias(f"_f{i}") for i, (_, n) in enumerate(failures)))
    listed = F.array(
        *(F.struct(F.lit(name).alias("check"), F.col(f"_f{i}").alias("failures")) for i, (name, _) in enumerate(failures))
    )
    return _with_status(counts.select(F.lit(model).alias("model"), F.inline(listed)))


def observed_results(model: str, df: DataFrame, rows: Sequence[RowCheck]) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``df`` with row checks counted on its way to whoever uses it, and the results once it was used."""
    seen = Observation()
    passing = df.observe(seen, *(F.count_if(c.offending).alias(f"c{i}") for i, c in enumerate(rows)))

    def results() -> DataFrame:
        found = seen.get
        counts = [(model, c.name, found[f"c{i}"]) for i, c in enumerate(rows)]
        return _with_status(df.sparkSession.createDataFrame(counts, "model string, check string, failures bigint"))

    return passing, results


def _with_status(results: DataFrame) -> DataFrame:
    return results.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def health(results: DataFrame, sources: Sequence[str] = ("raw",)) -> DataFrame:
    """Roll-up of check results; the failed names are as many as there are checks.

    ``sources`` are inputs that are checked but not built, so they are no models.
    """
    failed = F.when(F.col("status") != "pass", F.col("check"))
    built = F.when(~F.col("model").isin(*sources), F.col("model"))
    return results.agg(
        F.count("*").alias("tests_total"),
        F.count_if(F.col("status") == "pass").alias("tests_passed"),
        F.count_distinct(built).alias("models"),
        F.array_sort(F.collect_list(failed)).alias("failed"),
    )
