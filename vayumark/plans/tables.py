"""Tables that are published together.

A table is written to a folder of its own version. A snapshot, one small file, names
the folders in force of every table, and is written last: until then readers see the
set of tables of the snapshot before, and a run that dies leaves nothing but folders
no snapshot names. A table by day is a map from days to versions, so a run writes the
days it changes and carries the others on; the calendar bounds the map. The snapshot
also keeps each table's schema, so no file is opened to find it.

One run publishes at a time. The folders of the snapshot before stay until the next
one, for readers that are still at it.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import filesystem, names_in, read_text, write_text

SNAPSHOTS = "_snapshots"
#: How Spark names the folder of rows without a day; sorts after all days.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Table:
    """Where the rows of a table are: one version, or a version for each day."""

    schema: str
    version: str | None = None
    day: str | None = None
    days: dict[str, str] = field(default_factory=dict)
    #: days a version was written with: if all are in force, its folder is read as a whole
    written: dict[str, int] = field(default_factory=dict)

    def folders(self, since: date | None = None) -> list[str]:
        if self.day is None:
            return [f"version={self.version}"]
        days = {d: v for d, v in self.days.items() if since is None or since.isoformat() <= d < NO_DAY}
        held = Counter(days.values())
        whole = {v for v, n in held.items() if n == self.written[v]}
        parts = [f"version={v}/{self.day}={d}" for d, v in sorted(days.items()) if v not in whole]
        return [f"version={v}" for v in sorted(whole)] + parts

    def newest_day(self) -> date | None:
        return max((date.fromisoformat(d) for d in self.days if d < NO_DAY), default=None)

    def versions(self) -> set[str]:
        return {self.version} if self.day is None else set(self.days.values())

    def cells(self) -> set[tuple[str, str]]:
        """Pairs of version and day: what a sweep may have to delete."""
        return {(self.version, "")} if self.day is None else {(v, d) for d, v in self.days.items()}


@dataclass
class Snapshot:
    number: int
    tables: dict[str, Table] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n.split(".")[0]) for n in names_in(spark, f"{root}/{SNAPSHOTS}") if not n.startswith("."))


def _file(root: str, number: int) -> str:
    return f"{root}/{SNAPSHOTS}/{number:010d}.json"


def _load(spark: SparkSession, root: str, number: int) -> Snapshot:
    held = json.loads(read_text(spark, _file(root, number)))
    return Snapshot(number, {n: Table(**t) for n, t in held["tables"].items()}, held["notes"])


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """The snapshot in force; None if nothing was published yet."""
    numbers = _numbers(spark, root)
    return _load(spark, root, numbers[-1]) if numbers else None


def _open(spark: SparkSession, root: str, name: str, table: Table, since: date | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(table.schema))
    folders = table.folders(since)
    if not folders:
        return spark.createDataFrame([], schema)
    base = f"{root}/{name}"
    rows = spark.read.schema(schema).option("basePath", base).parquet(*(f"{base}/{f}" for f in folders))
    return rows.select(*schema.names)


def read(spark: SparkSession, root: str, name: str, since: date | None = None) -> DataFrame | None:
    """A published table, by day only from ``since`` on; None if there is none yet.

    Folders of earlier days are not even listed.
    """
    snapshot = current(spark, root)
    if snapshot is None or name not in snapshot.tables:
        return None
    return _open(spark, root, name, snapshot.tables[name], since)


class Publication:
    """A set of tables being written, to be committed as a whole.

    As a context it removes what it wrote if it ends without a commit.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.before = current(spark, self.root) or Snapshot(0)
        self.version = f"{self.before.number + 1:010d}-{uuid.uuid4().hex[:8]}"
        self.tables = dict(self.before.tables)
        self.written: list[str] = []
        self.committed = False

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, *_) -> None:
        if not self.committed:
            for folder in self.written:
                self._delete(folder)

    def _new_version(self, name: str) -> str:
        version = f"{self.version}-{len(self.written)}"
        self.written.append(f"{name}/version={version}")
        return version

    def put(self, name: str, rows: DataFrame) -> DataFrame:
        """Write a whole table; returns it."""
        version = self._new_version(name)
        rows.write.option("compression", "zstd").parquet(f"{self.root}/{name}/version={version}")
        self.tables[name] = Table(rows.schema.json(), version=version)
        return self.read(name)

    def put_days(self, name: str, rows: DataFrame, day: str, sort: list[str], *, replace_all: bool = False) -> DataFrame:
        """Write the days that ``rows`` hold in place of their rows now; returns the table.

        All other days are carried on unless ``replace_all``. Columns that are new to
        the table come last; rows of other days have null there.
        """
        version = self._new_version(name)
        path = f"{self.root}/{name}/version={version}"
        (
            rows.hint("rebalance", day)
            .sortWithinPartitions(day, *sort)
            .write.option("compression", "zstd")
            .partitionBy(day)
            .parquet(path)
        )
        written = [n.split("=", 1)[1] for n in names_in(self.spark, path) if n.startswith(f"{day}=")]
        held = self.tables.get(name)
        carried = {} if replace_all or held is None else held.days
        days = {**carried, **dict.fromkeys(written, version)}
        sizes = {**(held.written if held else {}), version: len(written)}
        self.tables[name] = Table(rows.schema.json(), None, day, days, {v: n for v, n in sizes.items() if v in set(days.values())})
        return self.read(name)

    def read(self, name: str, since: date | None = None) -> DataFrame | None:
        """A table as it will be, or is, if this run did not write it."""
        return _open(self.spark, self.root, name, self.tables[name], since) if name in self.tables else None

    def day_files(self, name: str) -> DataFrame:
        """Each day of a table with a digest of its files' names, sizes and times, from the listing alone."""
        table = self.tables[name]
        base = f"{self.root}/{name}"
        listed = (
            self.spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .option("basePath", base)
            .load([f"{base}/{f}" for f in table.folders()])
        )
        file = F.concat_ws("|", F.regexp_replace("path", "^.*/", ""), "length", F.unix_micros("modificationTime"))
        files = F.sha2(F.array_join(F.array_sort(F.collect_list(file)), ","), 256)
        return listed.groupBy(F.col(table.day).cast("date").alias(table.day)).agg(files.alias("files"))

    def commit(self, **notes) -> None:
        """Put the written tables in force, all at once."""
        held = {"tables": {n: vars(t) for n, t in self.tables.items()}, "notes": notes}
        write_text(self.spark, _file(self.root, self.before.number + 1), json.dumps(held))
        self.committed = True
        self._sweep()

    def _sweep(self) -> None:
        """Remove what only older snapshots name, and what runs that died left."""
        for number in _numbers(self.spark, self.root):
            if number < self.before.number:
                old = _load(self.spark, self.root, number)
                for name, table in old.tables.items():
                    kept = [s.tables[name].cells() for s in (self.before, self) if name in s.tables]
                    for version, day in table.cells().difference(*kept):
                        self._delete(f"{name}/version={version}/{table.day}={day}" if day else f"{name}/version={version}")
                self._delete(f"{SNAPSHOTS}/{number:010d}.json")
        for name in self.tables:
            known = set().union(*(s.tables[name].versions() for s in (self.before, self) if name in s.tables))
            for folder in names_in(self.spark, f"{self.root}/{name}"):
                if folder.startswith("version=") and folder.removeprefix("version=") not in known:
                    self._delete(f"{name}/{folder}")

    def _delete(self, path: str) -> None:
        files, folder = filesystem(self.spark, f"{self.root}/{path}")
        files.delete(folder, True)
