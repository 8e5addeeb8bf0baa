"""Payload documents: one JSON object per (city, date range)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import PAYLOAD

CORRUPT = "_corrupt_record"


def read_payloads(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Read payloads with their fixed schema; unknown keys are ignored.

    The city comes from a ``city_id=<id>`` folder or a ``city_id`` field. A
    document that does not parse keeps its text in ``_corrupt_record`` for the
    contract check to report. ``multi_line=False`` reads one document per line,
    which Spark can split: the form to use for large volumes.
    """
    return _with_options(spark.read, multi_line).json(path)


def payload_stream(
    spark: SparkSession, path: str, *, multi_line: bool = True, files_per_batch: int | None = None
) -> DataFrame:
    """The same documents as a stream of files, read as ``read_payloads`` reads them."""
    reader = _with_options(spark.readStream, multi_line)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def _with_options(reader, multi_line: bool):
    schema = T.StructType([*PAYLOAD.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        reader.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm[:ss]")
    )
