"""Contract check and flattening of payload documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import API_FIELDS, EXPECTED_UNIT
from ..session import CheckFailure
from ..sources.payloads import CORRUPT

MICRO_SIGN, GREEK_MU = "µ", "μ"


class ContractError(CheckFailure):
    """Some payloads broke the contract; ``errors`` holds every violation."""

    def __init__(self, message: str, errors: DataFrame):
        super().__init__(message)
        self.errors = errors


def _finding(condition: Column, field: str, problem: str) -> Column:
    return F.when(
        F.coalesce(condition, F.lit(False)),
        F.struct(F.lit(field).alias("field"), F.lit(problem).alias("problem")),
    )


def _findings(df: DataFrame) -> list[Column]:
    """Every rule of the contract as a nullable (field, problem) struct."""
    rules = []
    if CORRUPT in df.columns:
        rules.append(_finding(F.col(CORRUPT).isNotNull(), "document", "malformed"))
    for field in ("city_id", "latitude", "longitude", "timezone", "hourly_units", "hourly"):
        rules.append(_finding(F.col(field).isNull(), field, "missing"))

    times = F.col("hourly.time")
    rules.append(_finding(F.col("hourly").isNotNull() & times.isNull(), "time", "missing"))
    rules.append(_finding(F.size(F.array_compact(times)) != F.size(times), "time", "null"))
    for name in API_FIELDS:
        values = F.col(f"hourly.{name}")
        unit = F.try_element_at(F.col("hourly_units"), F.lit(name))
        same_sign = F.replace(unit, F.lit(MICRO_SIGN), F.lit(GREEK_MU))
        rules += [
            _finding(F.col("hourly").isNotNull() & values.isNull(), name, "missing"),
            _finding(F.size(values) != F.size(times), name, "length"),
            # both skip nulls; NaN is above every number
            _finding(F.array_min(values) < 0, name, "negative"),
            _finding(F.array_max(values) >= float("inf"), name, "not finite"),
            _finding(
                F.col("hourly_units").isNotNull() & unit.isNull(), name, "unit missing"
            ),
            _finding(same_sign != EXPECTED_UNIT, name, "unit"),
        ]
    return rules


def _check(payloads: DataFrame) -> DataFrame:
    """Payloads plus ``violations``, computed row by row without a shuffle."""
    found = F.filter(F.array(*_findings(payloads)), lambda f: f.isNotNull())
    return payloads.withColumn("violations", found)


def contract_violations(payloads: DataFrame) -> DataFrame:
    """One row per broken rule: city, first hour of the document, field, problem."""
    return (
        _check(payloads)
        .select(
            "city_id",
            F.array_min("hourly.time").alias("first_hour"),
            F.inline("violations"),
        )
    )


def split_valid(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Payloads that keep the contract, and the violations of the others.

    One bad city hides none of the rest: the good ones can be landed while the
    violations are reported.
    """
    good = _check(payloads).filter(F.size("violations") == 0).drop("violations")
    return good, contract_violations(payloads)


def require_none(errors: DataFrame, quarantine: str) -> None:
    """Raise if there are violations, after writing all of them to ``quarantine``.

    However many cities fail, each is named there; the message gives the path and
    the totals.
    """
    spark, schema = errors.sparkSession, errors.schema
    errors.write.mode("overwrite").option("compression", "zstd").parquet(quarantine)
    errors = spark.read.schema(schema).parquet(quarantine)
    found, cities = errors.agg(F.count("*"), F.count_distinct("city_id")).first()
    if found:
        raise ContractError(f"{found} violations of the payload contract in {cities} cities, see {quarantine}", errors)


def require_valid(payloads: DataFrame, quarantine: str) -> DataFrame:
    """The payloads if all keep the contract; else raises, see ``require_none``."""
    require_none(contract_violations(payloads), quarantine)
    return payloads


def flatten_payload(payloads: DataFrame) -> DataFrame:
    """One row per (city, hour) from the parallel arrays of valid payloads.

    Run the contract check first: zipping pads a short array with nulls.
    """
    hours = F.arrays_zip(
        F.col("hourly.time").alias("observed_at"),
        *(F.col(f"hourly.{name}").alias(column) for name, column in API_FIELDS.items()),
    )
    return payloads.select("city_id", F.inline(hours))
