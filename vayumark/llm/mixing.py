"""Mixing sources to target weights by capped water-filling.

A source may be repeated at most ``epochs`` times. Its share of all words follows
its weight; a source whose share is more than it may give is clamped there, and
the excess is dealt to the others by weight, until none is above its cap. The
level (words per unit of weight) only rises, so the clamped sources of a round are
those with a cap below level x weight: one number is all that a round passes on.

Whole repetitions take every document. The rest of a target takes documents in a
seeded order until it is used up; the last one gives a part of its words, so that
a source gives its target to the word. The order's running sums are cut into
slices of each source, so a source with most of the rows is spread over many tasks.

Only DataFrame expressions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vayumark.llm.common import WORD, stage

WEIGHTS = (5, 2, 1)


def sized(docs: DataFrame, seed: str, *columns: str) -> DataFrame:
    """``columns`` as a struct ``row``, source, ``size`` (words of the text; null: 0) and ``draw``, a seeded digest of the id."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return docs.select(F.struct(*columns).alias("row"), "source", size.alias("size"), draw.alias("draw"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = 3) -> DataFrame:
    """source, source_size, weight and target (double) of every source of ``sizes`` (source, size).

    Weights are dealt to sources by code point, null last, again and again.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("n") - 1) % len(weights) + 1)
    sources = stage(
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("n", F.row_number().over(order))
        .select("source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * epochs).alias("cap")),
        "sources",
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    room, share = total, sources.agg(F.sum("weight")).first()[0] or 1
    while True:
        # level = room / share; whole numbers, so that reruns and other engines agree
        above = F.lit(room).cast("decimal(38,0)") * F.col("weight") > F.col("cap").cast("decimal(38,0)") * F.lit(share)
        state = sources.agg(
            F.sum(F.when(above, F.col("cap")).otherwise(0)).alias("clamped"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("share"),
        ).first()
        if not state["share"] or (room, share) == (total - state["clamped"], state["share"]):
            break
        room, share = total - state["clamped"], state["share"]
    level = F.lit(room).cast("double") * F.col("weight") / F.lit(share).cast("double")
    return sources.select("source", "source_size", "weight", F.when(above, F.col("cap").cast("double")).otherwise(level).alias("target"))


def mix(docs: DataFrame, *columns: str, weights: tuple[int, ...] = WEIGHTS, epochs: int = 3, seed: str = "mix") -> DataFrame:
    """``columns`` of every row of ``docs`` (doc_id, text, source) as a struct ``row``, with size, source_size, target and taken.

    ``taken`` counts the words that the mix takes from the row, repetitions
    included: at most ``epochs`` times its size. The taken words of a source are
    its target, rounded. The same rows and seed give the same result.

    A null source is a source of its own. Null and empty texts have size 0 and
    give nothing. Repeated rows count like others. Other columns are ignored unless
    named. An empty table gives an empty result.
    """
    rows = stage(sized(docs, seed, *columns), "sizes")
    goal = targets(rows, weights, epochs)
    # a join needs a source that is not null
    tag = F.struct(F.col("source").isNull(), F.coalesce("source", F.lit("")))
    rows = rows.withColumn("tag", tag).withColumn("slice", F.substring("draw", 1, 3))
    slices = rows.groupBy("tag", "slice").agg(F.sum("size").alias("slice_size"))
    before = Window.partitionBy("tag").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        "tag", "slice", F.coalesce(F.sum("slice_size").over(before), F.lit(0)).alias("slice_start")
    )
    goal = goal.select(
        tag.alias("tag"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(0).alias("whole"),
    )
    starts = slices.join(goal, "tag").withColumn(
        "rest", F.round("target").cast("long") - F.col("whole") * F.col("source_size")
    )
    inside = (
        Window.partitionBy("tag", "slice").orderBy("draw", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = rows.withColumn("until", F.sum("size").over(inside)).join(starts, ["tag", "slice"])
    part = F.greatest(
        F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("slice_start") - F.col("until") + F.col("size"))
    )
    return placed.select(
        "row", "size", "source_size", "target", (F.col("whole") * F.col("size") + part).cast("long").alias("taken")
    )
