"""Places in an order, without a task that sees the whole order or a whole group.

Rows are range partitioned and sorted by the order, so a partition is a run of it.
A place is a place within the partition plus what the partitions before hold; only
counts of partitions are brought together, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage

PART = "_part"


def in_runs(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` staged in runs of the order, with the number of the run in ``_part``.

    Equal rows are told apart by where they were read, so that no number of them
    makes one run longer than the others. Staging fixes the runs: ranges are drawn
    from a sample and could differ the next time.
    """
    placed = df.repartitionByRange(*order, F.monotonically_increasing_id())
    return stage(placed.withColumn(PART, F.spark_partition_id()), "runs")


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with the number of each row (from 1) among the rows of equal ``by``, in ``order``.

    A group that is longer than a run is numbered run by run. A run has at most one
    group that began before it, so the offsets are at most as many as the runs, and
    may be broadcast. Null is a value of ``by`` like any other.
    """
    runs = in_runs(df, *(F.col(c) for c in by), *order)
    counts = runs.groupBy(*by, PART).agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(W.partitionBy(*by).orderBy(PART).rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select(
        *(F.col(c).alias(f"_by{i}") for i, c in enumerate(by)), F.col(PART).alias("_run"), before.alias("_before")
    ).filter("_before > 0")
    same = [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]
    local = F.row_number().over(W.partitionBy(PART, *by).orderBy(*order))
    return (
        runs.withColumn("_local", local)
        .join(F.broadcast(offsets), [F.col(PART) == F.col("_run"), *same], "left")
        .withColumn(name, F.col("_local") + F.coalesce("_before", F.lit(0)))
        .select(*df.columns, name)
    )


def ranked_values(df: DataFrame, value: str, name: str) -> DataFrame:
    """Each distinct value of a column with its rank, descending, nulls last; ties share a rank.

    Values are counted before they are ordered, so a run has every value once. What
    reaches the driver is one total per run.
    """
    counts = df.groupBy(value).agg(F.count("*").alias("_n"))
    runs = in_runs(counts, F.desc_nulls_last(value))
    totals = sorted(tuple(r) for r in runs.groupBy(PART).agg(F.sum("_n")).collect())
    starts = accumulate((n for _, n in totals), initial=0)
    offsets = df.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(totals, starts, strict=False)], f"{PART} int, _start bigint"
    )
    higher = W.partitionBy(PART).orderBy(F.desc_nulls_last(value)).rowsBetween(W.unboundedPreceding, -1)
    place = F.col("_start") + F.coalesce(F.sum("_n").over(higher), F.lit(0)) + 1
    return runs.join(F.broadcast(offsets), PART).select(value, place.alias(name))
