"""The trie of conversations that share their first turns, with totals of every subtree.

A conversation is rebuilt from the first turns of the conversation that opens its
block and the rest of its own. Every distinct sequence of first turns is a node. Its
key is the exclusive or of two 64-bit hashes of each turn with its place, so keys of
a long conversation are running totals that can be computed in pieces, and the
parent's key is the node's own without its last turn.

Totals of subtrees are rolled up in bands of fixed height. In its band a node is
exploded to its ancestors, at most ``BAND`` of them, and sums are grouped by ancestor.
The tops of bands, with the totals of their bands, form a trie that is ``BAND``
times less deep; it is rolled up the same way until one band holds it. Then
completed totals of tops are added to the ancestors in the band above, level by level
back to single turns. A trie of depth D takes 2 x log(D) rounds to the base ``BAND``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vayumark.llm.common import attach, stage
from vayumark.operators.ordered import numbered

#: Height of a band, of which each node is exploded to its ancestors.
BAND = 8
#: Conversations of a block share the first turns of the one with the smallest id, fewer than ``HEAD`` of them.
BLOCK, HEAD = 100, 6
#: Turns whose running keys are one group's work; ids in one piece of a digest; tasks a hot key is split over.
CHUNK, PIECE, SALTS = 4096, 1024, 64

NODE = ["depth", "k1", "k2"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1), two hashes ``a`` and ``b`` of role and text, ``chars`` of the text.

    Turns are ordered by turn (null first), then role and text, which tells all but
    equal rows apart. Null roles and texts are empty; rows without a conv_id belong to
    no conversation and are left out.
    """
    told = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = [F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    placed = numbered(told, ["conv_id"], order, "place")
    return placed.select(
        "conv_id",
        "place",
        F.xxhash64(F.lit("a"), "role", "text").alias("a"),
        F.xxhash64(F.lit("b"), "text", "role").alias("b"),
        F.length("text").cast("long").alias("chars"),
    )


def head_length(conv_id):
    """How many turns a conversation takes from the one that opens its block."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEAD


def rebuilt(turns: DataFrame) -> DataFrame:
    """Rows of rebuilt conversations: ``conv_id``, ``depth``, ``a``, ``b``, ``chars`` and ``turns``, their number.

    Depth 0 is one row for each conversation, also for those without a turn.
    """
    turns = stage(turns, "turns")
    counts = turns.groupBy("conv_id").agg(F.max("place").alias("own"))
    convs = counts.withColumns({"h": head_length(F.col("conv_id")), "opens": F.expr(f"conv_id - conv_id % {BLOCK}")})
    opening = counts.select(F.col("conv_id").alias("opens"), F.col("own").alias("there"))
    given = F.least("h", F.coalesce("there", F.lit(0)))
    convs = stage(
        convs.join(opening, "opens", "left").select(
            "conv_id", "opens", "h", given.alias("given"), (given + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("turns")
        ),
        "convs",
    )
    columns = ["conv_id", "depth", "a", "b", "chars", "turns"]
    heads = turns.filter(F.col("place") < HEAD).withColumnRenamed("conv_id", "opens")
    heads = heads.join(convs, "opens").filter("place <= given").withColumn("depth", F.col("place"))
    rest = turns.filter(F.col("place") > head_length(F.col("conv_id"))).withColumn("salt", F.pmod("place", F.lit(SALTS)))
    rest = attach(rest, convs, ["conv_id"]).withColumn("depth", F.expr("given + place - h"))
    root = convs.select("conv_id", *(F.lit(0).cast("long").alias(c) for c in ("depth", "a", "b", "chars")), "turns")
    return heads.select(columns).unionByName(rest.select(columns)).unionByName(root)


def with_keys(rows: DataFrame) -> DataFrame:
    """Rows of rebuilt conversations with the key of their node (k1, k2) and its parent's (p1, p2).

    Keys run on within pieces of ``CHUNK`` turns, and the totals of earlier pieces
    are added, so a conversation of any length is spread over as many groups.
    """
    turn = F.col("depth") > 0
    own = rows.withColumns(
        {
            "h1": F.when(turn, F.xxhash64(F.lit(1), "depth", "a", "b")).otherwise(0),
            "h2": F.when(turn, F.xxhash64(F.lit(2), "depth", "b", "a")).otherwise(0),
            "chunk": F.expr(f"depth div {CHUNK}"),
        }
    )
    own = stage(own.drop("a", "b"), "turn-hashes")
    so_far = Window.partitionBy("conv_id", "chunk").orderBy("depth")
    local = own.withColumns({f"l{n}": F.bit_xor(f"h{n}").over(so_far) for n in (1, 2)})
    totals = own.filter(F.col("turns") >= CHUNK).groupBy("conv_id", "chunk").agg(*(F.bit_xor(f"h{n}").alias(f"t{n}") for n in (1, 2)))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("conv_id", "chunk", *(F.bit_xor(f"t{n}").over(earlier).alias(f"c{n}") for n in (1, 2)))
    keyed = local.join(carried.filter("c1 IS NOT NULL"), ["conv_id", "chunk"], "left")
    keyed = keyed.withColumns({f"k{n}": F.expr(f"l{n} ^ coalesce(c{n}, 0L)") for n in (1, 2)})
    keyed = keyed.withColumns({f"p{n}": F.expr(f"k{n} ^ h{n}") for n in (1, 2)})
    return keyed.select("conv_id", *NODE, "p1", "p2", "chars", "turns")


def with_children(nodes: DataFrame) -> DataFrame:
    """``nodes`` with their number of children and the conv_id of their parent.

    A node may hold a third of all nodes as children (the root does): they are
    counted, and told their parent, in salted groups.
    """
    up = [F.expr("depth - 1").alias("_d"), F.col("p1").alias("_1"), F.col("p2").alias("_2")]
    below = nodes.filter("depth > 0").select("*", *up, F.pmod("k1", F.lit(SALTS)).alias("salt"))
    parent = nodes.select(F.col("depth").alias("_d"), F.col("k1").alias("_1"), F.col("k2").alias("_2"), F.col("conv_id").alias("parent_conv_id"))
    told = attach(below, parent, ["_d", "_1", "_2"]).select(*nodes.columns, "parent_conv_id")
    root = nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    counts = below.groupBy("_d", "_1", "_2").agg(F.count("*").alias("n_children"))
    counts = counts.select(F.col("_d").alias("depth"), F.col("_1").alias("k1"), F.col("_2").alias("k2"), "n_children")
    return told.unionByName(root).join(counts, NODE, "left").fillna(0, ["n_children"])


def band_paths(rows: DataFrame, nodes: DataFrame, step: int, band: int) -> DataFrame:
    """Nodes at depths that ``step`` divides, with ``path``: their ancestors in their band and themselves.

    Bands overlap in one depth: a node there is the top of its own band and, with
    ``bottom`` set, the last of a path in the band above. A path is read off the
    conversation that stands for the node.
    """
    at = F.expr(f"depth div {step}")
    bands = F.when((at % band == 0) & (at > 0), F.array(F.expr(f"depth div {step * band}"), F.expr(f"depth div {step * band} - 1")))
    bands = bands.otherwise(F.array(F.expr(f"depth div {step * band}")))
    so_far = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    paths = (
        rows.filter(F.col("depth") % step == 0)
        .select("conv_id", *NODE, F.explode(bands).alias("band"))
        .withColumn("path", F.collect_list(F.struct(*NODE)).over(so_far))
        .withColumn("bottom", F.col("band") < F.expr(f"depth div {step * band}"))
    )
    return paths.join(nodes.select("conv_id", "depth"), ["conv_id", "depth"], "left_semi").select(*NODE, "bottom", "path")


def summed(values: DataFrame, sums: list[str]) -> DataFrame:
    return values.groupBy(*NODE).agg(*(F.sum(c).alias(c) for c in sums))


def roll_up(rows: DataFrame, nodes: DataFrame, values: DataFrame, sums: list[str], band: int = BAND) -> DataFrame:
    """Sums of ``values`` over the subtree of every node, itself included.

    ``rows`` are the rows of rebuilt conversations with the keys of their nodes,
    ``nodes`` has the conversation that stands for each node, ``values`` columns
    ``sums`` of every node.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    levels, step = [], 1
    while True:
        paths = stage(band_paths(rows, nodes, step, band), "band-paths")
        inside = paths.filter("not bottom").join(values, NODE).select(F.explode("path").alias("up"), *sums).select("up.*", *sums)
        totals = stage(summed(inside, sums), "band-totals")
        levels.append((paths, totals))
        step *= band
        if step > deepest:
            break
        values = totals.filter(F.col("depth") % step == 0)
    complete = levels.pop()[1]
    for paths, totals in reversed(levels):
        below = paths.filter("bottom").join(complete, NODE)
        above = below.select(F.explode(F.expr("slice(path, 1, size(path) - 1)")).alias("up"), *sums).select("up.*", *sums)
        complete = stage(summed(totals.unionByName(above), sums), "band-complete")
    return complete


def digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined pieces of every node; a node's pieces come one after the other, in order."""
    node, state = None, None
    for batch in batches:
        done = []
        columns = [batch.column(c).to_pylist() for c in (*NODE, "piece")]
        for *key, piece in zip(*columns, strict=True):
            if key != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        if done:
            yield _digests(done)
    if node is not None:
        yield _digests([(*node, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=[*NODE, "ends_sha256"]
    )


def end_digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of the ids, ascending, of the conversations that end at a node.

    Ids are numbered in their node and joined in pieces, all in parallel; only the
    pieces of one node, not its rows, meet in one task, which hashes them as they
    come. SHA-256 has no parallel form.
    """
    ends = rows.filter("depth = turns").select(*NODE, "conv_id")
    placed = numbered(ends, NODE, [F.col("conv_id")], "n")
    pieces = placed.groupBy(*NODE, F.expr(f"(n - 1) div {PIECE}").alias("part")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("piece")
    )
    ordered = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "part")
    return ordered.mapInArrow(digest_pieces, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations.

    ``conv_id`` is the smallest member, ``parent_conv_id`` that of the parent (null at
    the root), ``n_convs`` the number of members, ``n_children`` and ``n_leaves``
    (childless nodes of the subtree), ``saved_tokens`` the characters of last texts
    that a cache of prefixes saves in the subtree, ``ends_sha256`` a digest of the
    members that end here. Other columns of the input are not looked at. Without any
    conversation there is no node.
    """
    rows = stage(with_keys(rebuilt(numbered_turns(conversations))), "trie-rows")
    nodes = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *(F.min(c).alias(c) for c in ("p1", "p2", "chars"))
    )
    nodes = stage(with_children(stage(nodes, "trie-nodes")), "trie-nodes")
    leaf = (F.col("n_children") == 0).cast("long").alias("n_leaves")
    values = nodes.select(*NODE, leaf, ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    complete = roll_up(rows, nodes, values, ["n_leaves", "saved_tokens"], band)
    found = nodes.join(complete, NODE).join(end_digests(rows), NODE, "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
