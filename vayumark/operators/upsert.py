"""Merging a batch into an existing table, as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staging import READING_KEY, newest_reading


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Match columns to ``schema`` by name, ignoring case, and cast them.

    Extra columns are dropped. A column the input lacks becomes null, unless the
    schema forbids null. In ANSI mode a value that does not fit aborts the job.
    """
    by_name: dict[str, list[str]] = {}
    for name in df.columns:
        by_name.setdefault(name.lower(), []).append(name)

    def pick(field: T.StructField) -> Column:
        found = by_name.get(field.name.lower(), [])
        if len(found) > 1:
            raise ValueError(f"columns {found} all match '{field.name}'")
        if not found and not field.nullable:
            raise ValueError(f"required column '{field.name}' is missing")
        source = F.col(f"`{found[0]}`") if found else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*(pick(field) for field in schema.fields))


def align_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Give ``df`` the columns of ``target`` in its order, new columns at the end.

    Columns only the target has become null; none is ever dropped.
    """
    known = df.sparkSession.createDataFrame([], target)
    return known.unionByName(df, allowMissingColumns=True)


def _at_least_as_new(version: Column, current: Column) -> Column:
    """An update needs a version not older than the current; null is no update."""
    return F.coalesce(version >= current, F.lit(False))


def upsert_latest(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = READING_KEY,
    version: str = "ingested_at",
) -> DataFrame:
    """Target after merging in the newest source row of each key.

    A matched row is replaced only if the source is not older; unmatched rows of
    both sides are kept. Source keys are unique after deduplication, which also
    leaves the source partitioned for the join, so no key multiplies and each
    side is shuffled once.
    """
    current = target.select(*keys, F.struct("*").alias("t"))
    incoming = newest_reading(source, keys, version).select(*keys, F.struct(*target.columns).alias("s"))
    replaced = F.col("t").isNull() | _at_least_as_new(F.col(f"s.{version}"), F.col(f"t.{version}"))
    merged = F.when(F.col("s").isNotNull() & replaced, F.col("s")).otherwise(F.col("t"))
    return (
        current.join(incoming, list(keys), "full").select(merged.alias("row")).select("row.*")
    )


def upsert_counts(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = READING_KEY,
    version: str = "ingested_at",
) -> DataFrame:
    """Rows an upsert inserts and updates; reads keys and versions only."""
    incoming = source.groupBy(*keys).agg(F.max(version).alias("incoming"))
    current = target.select(*keys, F.col(version).alias("current"), F.lit(True).alias("known"))
    return incoming.join(current, list(keys), "left").agg(
        F.count_if(F.col("known").isNull()).alias("inserted"),
        F.count_if(
            F.col("known") & _at_least_as_new(F.col("incoming"), F.col("current"))
        ).alias("updated"),
    )
