"""Helpers shared by the operators: tables, row keys, stages and components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vayumark.session import local_scratch, stage

__all__ = ["among_smallest", "attach", "components", "keyed", "prepare", "stage", "table"]

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Settings the operators need, where the session leaves them open.

    A session without a scratch folder gets one of its own only if it is local.
    Arrow batches are bounded by bytes, so that a batch of very long texts is as
    large as one of short texts. Shuffle files go when the execution that wrote
    them ends: later steps read stages, not shuffles.
    """
    local_scratch(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(rows: DataFrame, *columns, by: str = "doc_id", value: str = "text") -> DataFrame:
    """``key`` (long, not null) and ``columns`` of ``rows``.

    The key is the column ``by`` if that tells all rows apart; else a hash of it
    and ``value``, so that rows with one id and different values stay different.
    Rows that are equal in both share a key.
    """
    ids = rows.groupBy(by).agg(F.count("*").alias("n"))
    clash = ids.filter((F.col("n") > 1) | F.col(by).isNull()).limit(1).count()
    key = F.xxhash64(by, value) if clash else F.col(by).cast("long")
    return rows.select(key.alias("key"), *columns)


def attach(rows: DataFrame, totals: DataFrame, keys: list[str], salt: str = "salt") -> DataFrame:
    """``rows`` joined with the one row of ``totals`` that has their keys (not null).

    ``rows`` carry a salt. Each pair of key and salt that occurs fetches the totals
    once, and the rows are joined by both, so a key that holds a third of all rows is
    spread over as many groups as there are salts.
    """
    wanted = rows.select(*keys, salt).distinct()
    return rows.join(wanted.join(totals, keys), [*keys, salt])


def among_smallest(draw, most: int, count):
    """Whether the 64-bit hash ``draw`` is so small that about 2 x ``most`` of ``count`` rows pass.

    Before the ``most`` smallest hashes are picked, this keeps what reaches the task
    that picks in proportion to ``most``, however many tasks read the table.
    """
    part = F.least(F.lit(1.0), (2 * F.lit(most) + 100) / F.greatest(count, F.lit(1)))
    return (draw.cast("double") / 2.0**64 + 0.5) <= part


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of every node in ``edges`` (a, b: long).

    Large-star and small-star steps by turns: every step hangs neighbours onto
    the smallest node seen, with a grouped minimum and an equality join, so no
    task ever holds the neighbours of a node. Each round is written out. It ends
    when a round changes nothing; the number of rounds is logarithmic. Loops and
    repeated edges do no harm; an empty table gives an empty result.
    """
    links = stage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(),
        "links",
    )
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stage(small.union(low.select("u", "m")).distinct(), "links")
        same = links.count() == after.count() and after.join(links, ["u", "v"], "left_anti").isEmpty()
        links = after
        if same:
            break
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
