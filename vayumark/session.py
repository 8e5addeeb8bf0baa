"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the library is written for. Parallelism is left to the cluster and AQE.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Call sites for error messages cost several driver round trips per column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

LOCAL_SCRATCH = "vayumark.scratch.dir"

_run: ContextVar[str | None] = ContextVar("run", default=None)


class CheckFailure(RuntimeError):
    """Data broke a rule before anything was overwritten."""


def local_scratch(spark: SparkSession) -> None:
    """Give a local session a scratch folder of its own if it names none.

    For tests, benchmarks and single machines; the library itself never chooses one.
    It has a name of its own because a running session cannot set Spark's.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_SCRATCH, None)
    if not named and spark.sparkContext.master.startswith("local["):
        spark.conf.set(LOCAL_SCRATCH, tempfile.mkdtemp(prefix="vayumark-"))


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: what ``spark.checkpoint.dir`` names."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_SCRATCH, None)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the folder of the run, or of all runs outside of one."""
    return f"{_run.get() or scratch_root(spark) + '/vayumark'}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession, label: str) -> Iterator[str]:
    """A scratch folder for what is staged inside the block; removed at its end.

    It goes on success and when a check fails, since nothing was overwritten then.
    After any other error it stays: staged rows may be the only copy of what a
    broken write was replacing. A block inside a block shares its folder.
    """
    outer = _run.get()
    if outer is not None:
        yield outer
        return
    path = f"{scratch_root(spark)}/vayumark/{label}-{uuid.uuid4().hex}"
    token = _run.set(path)
    try:
        yield path
    except CheckFailure:
        remove(spark, path)
        raise
    finally:
        _run.reset(token)
    remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the scratch space, wherever it is stored."""
    if not path.startswith(f"{scratch_root(spark)}/vayumark/"):
        raise ValueError(f"{path} is not below the scratch folder")
    files, folder = filesystem(spark, path)
    files.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = filesystem(spark, path)
    return files.exists(folder)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    files, folder = filesystem(spark, path)
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file as a whole."""
    files, file = filesystem(spark, path)
    stream = files.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that appears whole or not at all; refused if there is one."""
    files, file = filesystem(spark, path)
    if files.exists(file):
        raise FileExistsError(path)
    parent, name = path.rsplit("/", 1)
    _, draft = filesystem(spark, f"{parent}/.{name}-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not files.rename(draft, file):
        files.delete(draft, False)
        raise FileExistsError(path)


def filesystem(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Gives several consumers one computation, cuts the lineage, and keeps a copy
    that outlives executors while the rows it came from are being overwritten.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
