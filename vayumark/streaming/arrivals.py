"""Payload files that arrive in a folder, each ingested once.

Spark's file stream keeps the files it has handed out in its checkpoint, so a run
lists the folder but reads only what is new, and ends when that is done. A batch that
fails is repeated whole by the next run, with the same files: landing replaces slices
and the batch's violations are overwritten, so nothing is there twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.payloads import ContractError, contract_violations
from ..plans.landing import ingest_payloads
from ..sources.payloads import payload_stream


def ingest_arrivals(
    spark: SparkSession,
    path: str,
    lake: str,
    source: str,
    state: str,
    *,
    strict: bool = True,
    multi_line: bool = True,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Land the valid payloads of files below ``path`` that no run with this ``state`` has seen.

    ``state`` is a folder for the stream's checkpoint and the violations, by batch.
    Returns the violations of this run's batches; with ``strict`` they raise
    ``ContractError`` after everything valid was landed.
    """
    arrived = payload_stream(spark, path, multi_line=multi_line, files_per_batch=files_per_batch)
    done: list[str] = []

    def ingest(batch: DataFrame, number: int) -> None:
        bad = f"{state}/violations/batch={number}"
        ingest_payloads(batch, lake, source, quarantine=bad, strict=False)
        done.append(bad)

    run = arrived.writeStream.foreachBatch(ingest).option("checkpointLocation", f"{state}/checkpoint")
    run.trigger(availableNow=True).start().awaitTermination()
    schema = contract_violations(spark.createDataFrame([], arrived.schema)).schema
    found = spark.read.schema(schema).parquet(*done) if done else spark.createDataFrame([], schema)
    found = found.select(*schema.names)
    if strict and not found.isEmpty():
        raise ContractError(f"{found.count()} violations of the payload contract, see {state}/violations", found)
    return found
