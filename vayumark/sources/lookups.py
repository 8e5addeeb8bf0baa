"""City list and breakpoint table, bundled or read from a CSV file.

The bundled copies become local relations inside the plan, so no executor needs
the file, and their size is known to the planner: joins with them are broadcast
because they are small, and would be shuffled if someone supplied a table above
``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from importlib import resources

import pyarrow as pa
from pyarrow import csv as arrow_csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import schemas


def _bundled(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    target = to_arrow_schema(schema)
    with (resources.files("vayumark") / "data" / name).open("rb") as handle:
        table = arrow_csv.read_csv(
            handle,
            read_options=arrow_csv.ReadOptions(skip_rows=1),
            convert_options=arrow_csv.ConvertOptions(
                column_types={field.name: field.type for field in target}
            ),
        )
    return spark.createDataFrame(pa.table(table.columns, schema=target), schema)


def _from_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("comment", "#")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_cities(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The one list of cities that ingestion and modelling share."""
    if path is None:
        return _bundled(spark, "cities.csv", schemas.CITY)
    return _from_csv(spark, path, schemas.CITY)


def read_breakpoints(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Concentration bands as data."""
    if path is None:
        return _bundled(spark, "breakpoints.csv", schemas.BREAKPOINT)
    return _from_csv(spark, path, schemas.BREAKPOINT)
