"""Exact duplicates: a two-pass Bloom filter finds texts that may be repeated; only those shuffle.

Texts are equal when they are identical without ASCII white space; null is the empty
text. The first pass hashes every text to a few of ``m`` slots and counts rows by
slot; a slot that two or more rows hit is set in the filter. A text that is
repeated sets all its slots, so one that finds a slot unset in the second pass has no
copy, and passes straight through. The others are grouped by their SHA-256, which
settles what the filter only suspects. Only digests travel, never texts.

The filter has ``SLOTS`` slots per row but never more than ``MOST_SLOTS``, which
bounds what is broadcast (``MOST_SLOTS / 8`` bytes of bits). Beyond
``MOST_SLOTS / SLOTS`` rows it says "maybe" more often, and more digests are grouped
that need not be; the result is exact at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vayumark.llm.common import attach, stage

#: Slots a row, and slots each text sets: 1.4 of 100 texts without a copy are suspected.
SLOTS, HASHES = 16, 2
#: 128 MB of bits, and with the keys of its rows 160 MB; enough for 67 million rows at the full width.
MOST_SLOTS = 1 << 30
#: Slots of one row of the filter: 64 words of 64 bits.
SEGMENT = 1 << 12
#: A group is split over this many tasks while it is counted and told its row that stays.
SALTS = 64


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\x0c\r", "")


def slot(digest: Column, n: int, slots: int) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit(n)), F.lit(slots))


def bloom(keys: DataFrame, slots: int, hashes: int = HASHES) -> DataFrame:
    """The filter as segments of 64 words: ``segment`` and ``words`` (array of long).

    Rows of a hot text are combined before the shuffle, so a slot is as cheap as any
    other however many rows hit it. Segments without a set slot have no row.
    """
    hits = keys.select(F.explode(F.array(*(slot(F.col("digest"), n, slots) for n in range(hashes)))).alias("slot"))
    words = (
        hits.groupBy("slot")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS int))")).alias("bits"))
    )
    held = F.map_from_entries(F.collect_list(F.struct((F.col("word") % 64).cast("int"), "bits")))
    dense = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.try_element_at("held", i), F.lit(0)))
    return (
        words.groupBy(F.shiftright("word", 6).alias("segment"))
        .agg(held.alias("held"))
        .select("segment", dense.alias("words"))
    )


def suspected(keys: DataFrame, filter_: DataFrame, slots: int, hashes: int = HASHES) -> DataFrame:
    """``keys`` with ``suspect``: whether all slots of the row are set."""
    for n in range(hashes):
        at = slot(F.col("digest"), n, slots)
        segment = filter_.select(F.col("segment").alias(f"segment{n}"), F.col("words").alias(f"words{n}"))
        keys = keys.withColumns({f"at{n}": at, f"segment{n}": F.floor(at / SEGMENT)})
        keys = keys.join(F.broadcast(segment), f"segment{n}", "left")
        word = f"words{n}[CAST((at{n} % {SEGMENT}) div 64 AS int)]"
        bit = F.expr(f"getbit({word}, CAST(at{n} & 63 AS int)) = 1")
        keys = keys.withColumn(f"set{n}", F.coalesce(bit, F.lit(False)))
        keys = keys.drop(f"segment{n}", f"words{n}", f"at{n}")
    everything = F.lit(True)
    for n in range(hashes):
        everything = everything & F.col(f"set{n}")
    return keys.withColumn("suspect", everything).drop(*(f"set{n}" for n in range(hashes)))


def classes(docs: DataFrame, *columns: str, by: str = "doc_id", text: str = "text", most_slots: int = MOST_SLOTS) -> DataFrame:
    """``row`` (struct of ``columns``) of every row, with its group of equal texts.

    ``keep_id`` is the id of the row that stays, ``group_size`` the number of rows,
    ``kept`` whether this is the row that stays, ``digest`` the SHA-256 of the text
    without white space. The row with most code points stays, of those the one with
    the smallest id (null last), of those the one read first; so of rows that are
    equal in all of it exactly one stays. An empty table gives an empty result.
    """
    whole = F.col(f"`{text}`")
    keys = stage(
        docs.select(
            F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"),
            F.unhex(F.sha2(normalised(whole), 256)).alias("digest"),
            F.struct(
                (-F.coalesce(F.length(whole), F.lit(0))).alias("shortness"),
                F.col(f"`{by}`").isNull().alias("no_id"),
                F.col(f"`{by}`").alias("id"),
                F.monotonically_increasing_id().alias("place"),
            ).alias("rank"),
        ),
        "dedup-keys",
    )
    slots = min(most_slots, max(SEGMENT, SLOTS * keys.count()))
    tested = suspected(keys, stage(bloom(keys, slots), "dedup-filter"), slots)
    alone = tested.filter("not suspect").select(
        "row", F.col("rank.id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    suspects = stage(tested.filter("suspect").drop("suspect"), "dedup-suspects").withColumn(
        "salt", F.pmod(F.col("rank.place"), F.lit(SALTS)).cast("int")
    )
    groups = suspects.groupBy("digest", "salt").agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    totals = groups.groupBy("digest").agg(F.min("first").alias("first"), F.sum("n").alias("group_size"))
    found = attach(suspects, totals, ["digest"])
    repeated = found.select(
        "row",
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("rank.place") == F.col("first.place")).alias("kept"),
        "digest",
    )
    return alone.unionByName(repeated)


def keep_one(docs: DataFrame, by: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of every group of equal texts; all columns, whatever they are called."""
    found = classes(docs, *docs.columns, by=by, text=text)
    return found.filter("kept").select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
