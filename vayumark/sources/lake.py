"""Reading the raw lake: Parquet files in one folder per calendar day.

A lake of many cities has hash buckets of cities below each day. Beside its files it
keeps a ledger of what was landed when, which names the days that were written late.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import local_today
from ..schemas import LAKE
from ..session import exists, names_in, read_text

#: Names that start so are not read as data.
LEDGER, LAYOUT = "_ledger", "_layout.json"
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("load", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("rows", T.LongType()),
        # begun before the files of a load change, done after
        T.StructField("state", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)


def open_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The Parquet table at ``path``, or None if there is none yet.

    The schema is given, so neither are files opened to infer it nor are folder
    names turned into other types. Opening lists the folders, which is the main
    cost for a long table: hand the result on instead of opening again.
    """
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else None


def bucket_count(spark: SparkSession, lake: str) -> int:
    """Hash buckets of cities below each day; with one, days have no folders below."""
    return json.loads(read_text(spark, f"{lake}/{LAYOUT}"))["buckets"] if LAYOUT in names_in(spark, lake) else 1


def lake_days(spark: SparkSession, lake: str) -> DataFrame:
    """The lake including its partition columns ``date`` and, if it has buckets, ``bucket``."""
    return spark.read.schema(LAKE).parquet(lake)


def read_raw(spark: SparkSession, lake: str, from_date: date | None = None, late: Iterable[date] = ()) -> DataFrame:
    """Raw hourly rows, optionally only folders from ``from_date`` on and of the ``late`` days before.

    Both are literals on the partition column, so other folders are not opened.
    """
    rows = lake_days(spark, lake)
    if from_date is not None:
        wanted = F.col("date") >= F.lit(from_date)
        late = sorted(set(late))
        rows = rows.filter(wanted | F.col("date").isin(late) if late else wanted)
    return rows.drop("date", "bucket")


def ledger(spark: SparkSession, lake: str) -> DataFrame | None:
    """Days and buckets of every load; None if nothing was landed with a ledger."""
    return open_table(spark, f"{lake}/{LEDGER}", LEDGER_SCHEMA)


def late_days(spark: SparkSession, lake: str, before: date, since: datetime) -> list[date]:
    """Days before a day that were written to since a moment; the calendar bounds them.

    They come from the ledger. A load that began and never ended counts until a later
    one of the same day ended. For moments before the ledger began, the write times of
    the older files are asked as well; only files written since are opened for that.
    """
    landed = ledger(spark, lake)
    begun = None
    days = set()
    if landed is not None:
        begun = landed.agg(F.min("at")).first()[0]
        ended = landed.filter("state = 'done'")
        open_loads = landed.filter("state = 'begun'").join(ended.select("load").distinct(), "load", "left_anti")
        touched = ended.select("date", "at", F.lit(True).alias("done")).unionByName(
            open_loads.select("date", "at", F.lit(False).alias("done"))
        )
        last = touched.groupBy("date").agg(
            F.max(F.when(F.col("done"), F.col("at"))).alias("done"), F.max(F.when(~F.col("done"), F.col("at"))).alias("open")
        )
        still_open = F.col("open").isNotNull() & (F.col("done").isNull() | (F.col("open") > F.col("done")))
        late = last.filter((F.col("date") < F.lit(before)) & ((F.col("done") >= F.lit(since)) | still_open))
        days |= {r.date for r in late.select("date").collect()}
    if begun is None or since < begun:
        written = F.col("_metadata.file_modification_time") >= F.date_trunc("second", F.lit(since))
        older = lake_days(spark, lake).filter(F.col("date") < F.lit(before)).filter(written)
        days |= {r.date for r in older.select("date").distinct().collect()}
    return sorted(days)


def read_days(spark: SparkSession, lake: str, days: Iterable[date]) -> DataFrame:
    """Raw rows of the given days; a day without a folder adds nothing."""
    wanted = sorted(set(days))
    return lake_days(spark, lake).filter(F.col("date").isin(wanted)).drop("date", "bucket")


def finished_days_only(
    df: DataFrame, day: str = "date", now: datetime | None = None
) -> DataFrame:
    """Drop days that have not ended on the cities' wall clock."""
    return df.filter(F.col(day) < local_today(now))


def last_finished_days(
    df: DataFrame, n: int = 3, day: str = "date", now: datetime | None = None
) -> DataFrame:
    """The last ``n`` finished days: the window re-loaded for late corrections."""
    today = local_today(now)
    return df.filter(F.col(day).between(F.date_sub(today, n), F.date_sub(today, 1)))


def raw_file_count(spark: SparkSession, lake: str) -> DataFrame:
    """Number of Parquet files in the lake, from the listing alone."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(lake)
        .agg(F.count("path").alias("raw_files"))
    )
