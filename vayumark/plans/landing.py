"""Writing the raw lake: landing whole slices and merging single readings.

The lake has one folder per calendar day and, if it is laid out so, hash buckets of
cities below. A slice is one city on one day; landing replaces slices, so loading
the same days again never duplicates rows. Slices are not folders: with many cities
that would be one small file per city and day. A load rewrites the buckets it has rows
of and no others, and enters them in the lake's ledger.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import day_of, whole_second_now
from ..operators.payloads import flatten_payload, require_none, split_valid
from ..operators.upsert import conform, upsert_counts, upsert_latest
from ..schemas import LAKE, RAW
from ..session import names_in, scratch_path, scratch_run, stage, write_text
from ..sources.lake import LAYOUT, LEDGER, LEDGER_SCHEMA, bucket_count, finished_days_only, open_table

SLICE = ["date", "city_id"]
CELL = ["date", "bucket"]


def stamp_lineage(
    df: DataFrame, source: str, run_id: str | None = None, now: datetime | None = None
) -> DataFrame:
    """Record on each row where it came from, when and in which run."""
    loaded = whole_second_now(now)
    utc = F.convert_timezone(None, F.lit("UTC"), loaded)
    run = F.lit(run_id) if run_id else F.date_format(utc, "yyyyMMdd'T'HHmmss'Z'")
    return df.withColumns(
        {"source": F.lit(source), "ingested_at": loaded, "run_id": run}
    )


def lay_out(spark: SparkSession, lake: str, buckets: int | None) -> int:
    """The number of buckets of a lake: what it has, else ``buckets`` (default 1), which it keeps from now on."""
    if open_table(spark, lake, LAKE) is None:
        write_text(spark, f"{lake}/{LAYOUT}", json.dumps({"buckets": buckets or 1}))
        return buckets or 1
    held = bucket_count(spark, lake)
    if buckets not in (None, held):
        raise ValueError(f"the lake has {held} bucket(s) a day, not {buckets}")
    return held


def _placed(df: DataFrame, buckets: int) -> DataFrame:
    """Rows with their day and bucket; a bucket is a hash of the city."""
    bucket = F.pmod(F.xxhash64("city_id"), F.lit(buckets)).cast("int")
    return conform(df, RAW).withColumns({"date": day_of("observed_at"), "bucket": bucket})


def _cells_in(batch: DataFrame) -> DataFrame:
    """Days and buckets of a batch with rows and newest run, as a local table: bounded by calendar times buckets."""
    cells = batch.groupBy(*CELL).agg(F.max("run_id").alias("run_id"), F.count("*").alias("rows"))
    return batch.sparkSession.createDataFrame(cells.collect(), cells.schema)


def _has_data(spark: SparkSession, lake: str) -> bool:
    return any(name.startswith("date=") for name in names_in(spark, lake))


def _current(landed: DataFrame, cells: DataFrame, buckets: int) -> DataFrame:
    """Rows of the lake in these cells; folders of other days and buckets are not opened."""
    known = cells.collect()
    days = sorted({c.date for c in known if c.date})
    wanted = F.col("date").isin(days)
    if any(c.date is None for c in known):
        wanted = wanted | F.col("date").isNull()
    rows = landed.filter(wanted)
    if buckets == 1:
        return rows.withColumn("bucket", F.lit(0))
    touched = cells.select(*(F.col(c).alias(f"_{c}") for c in CELL))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in CELL]
    return rows.filter(F.col("bucket").isin(sorted({c.bucket for c in known}))).join(F.broadcast(touched), same, "left_semi")


def _write_cells(rows: DataFrame, lake: str, buckets: int) -> None:
    """Replace the folders that ``rows`` have; all others stay as they are."""
    folders = CELL if buckets > 1 else ["date"]
    rows = rows if buckets > 1 else rows.drop("bucket")
    (
        rows.hint("rebalance", *folders)
        .sortWithinPartitions(*folders, "city_id", "observed_at")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*folders)
        .parquet(lake)
    )


def _enter(cells: DataFrame, lake: str, load: str, state: str) -> None:
    entry = cells.withColumns({"load": F.lit(load), "state": F.lit(state), "at": F.current_timestamp()})
    entry.select(*LEDGER_SCHEMA.names).coalesce(1).write.mode("append").option("compression", "zstd").parquet(f"{lake}/{LEDGER}")


def _replace(rows: DataFrame, cells: DataFrame, lake: str, buckets: int) -> None:
    """Write cells of an existing lake, entered in its ledger before their files change and after.

    If it dies between, the first entry alone tells the next build to look at its days.
    """
    load = uuid.uuid4().hex
    _enter(cells, lake, load, "begun")
    _write_cells(rows, lake, buckets)
    _enter(cells, lake, load, "done")


def _fill(rows: DataFrame, lake: str, buckets: int) -> None:
    """Write an empty lake; what no build has seen needs no entry beforehand."""
    _write_cells(rows, lake, buckets)
    written = open_table(rows.sparkSession, lake, LAKE)
    cells = _cells_in(written if buckets > 1 else written.withColumn("bucket", F.lit(0)))
    _enter(cells, lake, uuid.uuid4().hex, "done")


def land(df: DataFrame, lake: str, buckets: int | None = None) -> None:
    """Replace the slices present in ``df``; leave all others as they are.

    Into a lake with data, the batch is staged once, and the other cities' rows of
    the touched buckets are staged before their folders are overwritten, so a job
    that dies half-way loses nothing. ``buckets`` (a day, fixed when the lake is
    new; default 1) bounds what is rewritten when a few of many cities are loaded again.
    """
    spark = df.sparkSession
    buckets = lay_out(spark, lake, buckets)
    batch = _placed(df, buckets)
    if not _has_data(spark, lake):
        return _fill(batch, lake, buckets)
    with scratch_run(spark, "land"):
        batch = stage(batch, "land")
        cells = _cells_in(batch)
        slices = batch.select(*(F.col(c).alias(f"_{c}") for c in SLICE)).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SLICE]
        kept = _current(open_table(spark, lake, LAKE), cells, buckets).join(slices, same, "left_anti")
        _replace(batch.unionByName(stage(kept, "keep")), cells, lake, buckets)


def merge_into_lake(df: DataFrame, lake: str, buckets: int | None = None) -> tuple[int, int]:
    """Upsert single readings: newer versions replace, unknown keys are added.

    Returns how many readings were inserted and how many updated. Rewrites the
    buckets that hold a reading of the batch.
    """
    spark = df.sparkSession
    buckets = lay_out(spark, lake, buckets)
    known = _has_data(spark, lake)
    with scratch_run(spark, "merge"):
        batch = stage(_placed(df, buckets), "merge")
        cells = _cells_in(batch)
        current = _current(open_table(spark, lake, LAKE), cells, buckets) if known else batch.limit(0)
        counts = upsert_counts(current, batch).first()
        merged = stage(upsert_latest(current, batch), "merged")
        _replace(merged, cells, lake, buckets)
    return counts["inserted"], counts["updated"]


def require_finished(end: date, spark: SparkSession, now: datetime | None = None) -> None:
    """Refuse a range that ends on a day which is not over yet."""
    day = spark.range(1).select(F.lit(end).alias("date"))
    if finished_days_only(day, now=now).isEmpty():
        raise ValueError(f"{end} is not a finished day yet")


def ingest_payloads(
    payloads: DataFrame,
    lake: str,
    source: str,
    run_id: str | None = None,
    *,
    quarantine: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """Land every valid payload, then fail if there were others.

    Every violation is written to ``quarantine`` (default: a new scratch folder). If
    there is one, ``ContractError`` is raised after the valid payloads were landed, so
    a bad city hides none of the rest; with ``strict=False`` the violations are
    returned instead.
    """
    spark = payloads.sparkSession
    quarantine = quarantine or scratch_path(spark, "quarantine")
    with scratch_run(spark, "ingest"):
        good, violations = split_valid(stage(payloads, "payloads"))
        land(stamp_lineage(flatten_payload(good), source, run_id), lake)
        if strict:
            require_none(violations, quarantine)
        else:
            violations.write.mode("overwrite").option("compression", "zstd").parquet(quarantine)
    return spark.read.schema(violations.schema).parquet(quarantine)
