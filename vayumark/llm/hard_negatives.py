"""Hard negatives of anchors, with bounds handed down spanning trees of anchors.

Anchors are dealt to blocks of neighbours, and the anchors of a block are joined to a
minimum spanning tree. All rows meet every block of anchors, in blocks of rows. Scores
at the root are computed; below, the score of a row at an anchor is its score at the
parent plus or minus the length of the edge times the norm of the row. Only rows
whose bounds overlap a window of the anchor are scored again, and their bounds are
exact from there on. The first pass finds the positives of each anchor (window: the
scores that could still be among the best of its label), the second the negatives in
the windows that the scores of the positives set.

A pair of blocks returns the few best rows of every window; they are merged by a
window function that is cut to them on both sides of the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vayumark.llm.common import stage

#: Rows and anchors of a block; blocks of rows in one chunk, blocks of anchors in one group (key of the join).
ROWS, ANCHORS, CHUNK, GROUP = 1024, 512, 8, 64
#: Rows whose vector is longer take no part: their scores need not fit a long.
LONGEST = 2.0**31
#: Blocks of anchors whose best scores so far a task remembers.
REMEMBERED = 4096

BLOCK = "dim int, size int, rows binary, ids binary, named binary, labels binary, vectors binary"
TREE = f"tree long, parents binary, edges binary, depths binary, {BLOCK}"
FOUND = "anchor_row long, anchor_id long, tree long, place int, low long, other_row long, other_id long, score long"


def scaled(embeddings: DataFrame) -> DataFrame:
    """Rows that take part: ``row``, ``vec_id``, ``label``, ``vector`` (whole numbers: floor of 256 times a component).

    Rows with a null label, a null vector or a component that is null or not finite
    are left out, as are vectors of ``LONGEST`` or more. A label is one higher, modulo
    10, where 7 divides vec_id. Rows that repeat an id, or are equal, are different rows.
    """
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    unusable = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    known = embeddings.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(~unusable)
    rows = known.select(F.monotonically_increasing_id().alias("row"), "vec_id", moved.alias("label"), whole.alias("vector"))
    return rows.filter(square < LONGEST**2)


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows of a matrix; shorter ones end in zeros, which add nothing to a score."""
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    dim = int(lengths.max(initial=0))
    if (lengths == dim).all():
        return values.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.arange(dim)[None, :] < lengths[:, None]] = values
    return out


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows of a task in tables of at most ``most`` rows, however they arrive."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            room = most - sum(b.num_rows for b in held)
            held.append(batch.slice(0, room))
            batch = batch.slice(room)
            if sum(b.num_rows for b in held) == most:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def packed(table: pa.Table, order: np.ndarray | None = None) -> tuple[dict, np.ndarray]:
    """The fields of a block, and its vectors."""
    table = table.combine_chunks()
    vectors = matrix(table.column("vector").combine_chunks())
    ids = table.column("vec_id").combine_chunks()
    columns = {
        "rows": table.column("row").to_numpy(),
        "ids": ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False),
        "named": ids.is_valid().to_numpy(zero_copy_only=False),
        "labels": table.column("label").to_numpy(),
    }
    if order is not None:
        vectors, columns = vectors[order], {k: v[order] for k, v in columns.items()}
    kind = np.int16 if np.abs(vectors).max(initial=0) < 2**15 else np.int64
    fields = {k: np.ascontiguousarray(v).tobytes() for k, v in columns.items()}
    fields |= {"dim": vectors.shape[1], "size": np.dtype(kind).itemsize, "vectors": vectors.astype(kind).tobytes()}
    return fields, vectors


def as_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in gathered(batches, ROWS):
        yield _record([packed(table)[0]], BLOCK)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order by depth, parents (places in that order), lengths of edges to them, depths, of a minimum spanning tree."""
    x = x.astype(np.float64)
    n = len(x)
    squares = (x * x).sum(axis=1)
    root = int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))
    best, parent, depth = np.full(n, np.inf), np.full(n, root), np.zeros(n, np.int32)
    outside = np.ones(n, bool)
    at = root
    for _ in range(n):
        outside[at] = False
        near = squares + squares[at] - 2 * (x @ x[at])
        closer = outside & (near < best)
        best[closer], parent[closer] = near[closer], at
        if not outside.any():
            break
        at = int(np.argmin(np.where(outside, best, np.inf)))
        depth[at] = depth[parent[at]] + 1
    order = np.argsort(depth, kind="stable")
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    edges = np.sqrt(((x - x[parent]) ** 2).sum(axis=1))
    return order, place[parent[order]], edges[order], depth[order]


def as_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32
    for n, table in enumerate(gathered(batches, ANCHORS)):
        order, parents, edges, depths = spanning_tree(matrix(table.column("vector").combine_chunks()))
        fields, _ = packed(table, order)
        arrays = {"parents": parents.tobytes(), "edges": edges.tobytes(), "depths": depths.tobytes()}
        yield _record([{"tree": first + n, **arrays, **fields}], TREE)


ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _record(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(",")]
    return pa.RecordBatch.from_pydict(
        {name: pa.array([r[name] for r in rows], ARROW[kind]) for name, kind in fields}
    )


class Block:
    """A block of rows or anchors as arrays."""

    def __init__(self, fields: dict, prefix: str = ""):
        held = {k: fields[prefix + k] for k in ("rows", "ids", "named", "labels")}
        self.rows, self.ids, self.labels = (np.frombuffer(held[k], np.int64) for k in ("rows", "ids", "labels"))
        self.named = np.frombuffer(held["named"], bool)
        kind = {2: np.int16, 8: np.int64}[fields[prefix + "size"]]
        self.vectors = np.frombuffer(fields[prefix + "vectors"], kind).reshape(len(self.rows), fields[prefix + "dim"])

    def widened(self, dim: int, kind) -> np.ndarray:
        out = np.zeros((len(self.rows), dim), kind)
        out[:, : self.vectors.shape[1]] = self.vectors
        return out


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` highest scores; ties by smaller id, then row."""
    if len(scores) > most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        kept = np.nonzero(scores >= least)[0]
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((rows[kept], ids[kept], -scores[kept]))[:most]]


def tile(anchors: Block, fields: dict, others: Block, windows, seen: np.ndarray, same: bool, most: int, counts: dict):
    """Of a block of anchors and a block of rows: (anchor, window, rows found, their scores).

    ``windows`` has for each anchor its (low, high) pairs, ``seen`` for each window the
    score that a row must reach to be among the best so far; it is raised.
    """
    parents = np.frombuffer(fields["parents"], np.int32)
    edges, depths = np.frombuffer(fields["edges"]), np.frombuffer(fields["depths"], np.int32)
    dim = max(anchors.vectors.shape[1], others.vectors.shape[1])
    norms = np.sqrt((others.vectors.astype(np.float64) ** 2).sum(axis=1))
    longest = np.sqrt((anchors.vectors.astype(np.float64) ** 2).sum(axis=1)).max(initial=0)
    # sums of whole numbers below 2^53 are exact in doubles; longer vectors are multiplied as longs
    kind = np.float64 if longest * norms.max(initial=0) < 2.0**52 else np.int64
    a, c = anchors.widened(dim, kind), others.widened(dim, kind)
    low, high = np.zeros((len(a), len(c))), np.zeros((len(a), len(c)))
    for n in range(len(a)):
        allowed = ((others.labels == anchors.labels[n]) == same) & (others.rows != anchors.rows[n])
        if depths[n] == 0:
            exact = c @ a[n]
            low[n] = high[n] = exact
            scored = np.nonzero(allowed)[0]
            counts["scored"] = counts.get("scored", 0) + len(c)
        else:
            slack = edges[n] * norms * (1 + 1e-9) + (1e-12 * longest) * norms + 1e-3
            low[n], high[n] = low[parents[n]] - slack, high[parents[n]] + slack
            wanted = np.zeros(len(c), bool)
            for w, (least, greatest) in enumerate(windows[n]):
                wanted |= (high[n] >= max(least, seen[n, w])) & (low[n] <= greatest)
            scored = np.nonzero(wanted & allowed)[0]
            exact = np.zeros(len(c), kind)
            exact[scored] = c[scored] @ a[n]
            low[n, scored] = high[n, scored] = exact[scored]
            counts["scored"] = counts.get("scored", 0) + len(scored)
        counts["pairs"] = counts.get("pairs", 0) + len(c)
        for w, (least, greatest) in enumerate(windows[n]):
            inside = scored[(exact[scored] >= max(least, seen[n, w])) & (exact[scored] <= greatest)]
            if len(inside):
                top = inside[best(exact[inside], others.ids[inside], others.rows[inside], most)]
                if len(top) == most:
                    seen[n, w] = max(seen[n, w], float(exact[top[-1]]))
                yield n, w, top, exact[top].astype(np.int64)


def search(batches: Iterator[pa.RecordBatch], most: int, same: bool) -> Iterator[pa.RecordBatch]:
    """The best rows of every window of every anchor, for each pair of blocks that arrives."""
    seen: dict[int, np.ndarray] = {}
    counts: dict = {}
    for batch in batches:
        for fields in batch.to_pylist():
            anchors, others = Block(fields), Block(fields, "c_")
            if same:
                windows = [[(-math.inf, math.inf)]] * len(anchors.rows)
            else:
                windows = [[] for _ in anchors.rows]
                for w in sorted(fields["windows"], key=lambda w: -w["score"]):
                    windows[w["place"]].append((-(-80 * w["score"] // 100), w["score"]))
            if fields["tree"] not in seen:
                if len(seen) >= REMEMBERED:
                    seen.pop(next(iter(seen)))
                seen[fields["tree"]] = np.full((len(anchors.rows), max(map(len, windows), default=0)), -np.inf)
            out: list[list] = [[] for _ in range(8)]
            for n, w, top, scores in tile(anchors, fields, others, windows, seen[fields["tree"]], same, most, counts):
                k = len(top)
                target = 0 if same else windows[n][w][1]
                ids = [int(i) if named else None for i, named in zip(others.ids[top], others.named[top], strict=True)]
                values = ([anchors.rows[n]] * k, [anchors.ids[n]] * k, [fields["tree"]] * k, [n] * k, [target] * k)
                for column, more in zip(out, (*values, others.rows[top], ids, scores), strict=True):
                    column.extend(more)
            if out[0]:
                names = [f.split() for f in FOUND.split(", ")]
                yield pa.RecordBatch.from_pydict(
                    {name: pa.array(column, ARROW[kind]) for (name, kind), column in zip(names, out, strict=True)}
                )


def met(trees: DataFrame, blocks: DataFrame, groups: int, chunks: int) -> DataFrame:
    """Every block of anchors with every block of rows.

    The anchors are the stated queries. Blocks of rows go to every group of trees, trees
    to every chunk of blocks, and those of one group and chunk are joined.
    """
    def every(count):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = trees.withColumn("group", F.pmod(F.xxhash64("tree"), F.lit(groups)).cast("int")).withColumn("chunk", every(chunks))
    right = blocks.select(
        *(F.col(c).alias(f"c_{c}") for c in blocks.columns),
        F.pmod(F.xxhash64("rows"), F.lit(chunks)).cast("int").alias("chunk"),
        every(groups).alias("group"),
    )
    return left.join(right, ["group", "chunk"]).drop("group", "chunk")


def ranked(found: DataFrame, by: list[str], most: int, name: str) -> DataFrame:
    first = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("other_id"), "other_row")
    return found.withColumn(name, F.row_number().over(first)).filter(F.col(name) <= most)


def mine(embeddings: DataFrame, positives: int = 5, negatives: int = 5) -> DataFrame:
    """Hard negatives of the rows whose vec_id 100 divides.

    The positives of an anchor are the ``positives`` other rows of its label with the
    highest inner product, the negatives of a positive the first ``negatives`` rows of
    other labels that score from 80 to 100 of 100 of it. One row for each of them:
    ``anchor_id``, ``positive_id``, ``rank`` (int, from 1), ``negative_id``,
    ``positive_score``, ``negative_score``. Ties go to the smaller vec_id (null last),
    then to the row read first; a positive with a negative score has no negatives, nor
    has an anchor without positives. Other columns of the input are not looked at.
    """
    rows = stage(scaled(embeddings), "mining-rows")
    anchors = rows.filter("vec_id % 100 = 0")
    n_rows, n_anchors = rows.count(), anchors.count()
    # neighbours on a fixed random direction share a block; the row splits copies of one vector
    line = F.aggregate(
        F.transform("vector", lambda x, i: x.cast("double") * (F.pmod(F.xxhash64(i), F.lit(2001)) - 1000)), F.lit(0.0), lambda t, x: t + x
    )
    parts = math.ceil(n_anchors / (8 * ANCHORS)) or 1
    near = anchors.withColumn("line", line).repartitionByRange(parts, "label", "line", "row").sortWithinPartitions("label", "line", "row")
    trees = stage(near.drop("line").mapInArrow(as_trees, TREE), "mining-trees")
    blocks = stage(rows.mapInArrow(as_rows, BLOCK), "mining-blocks")
    groups, chunks = math.ceil(n_anchors / (ANCHORS * GROUP)) or 1, math.ceil(n_rows / (ROWS * CHUNK)) or 1

    found = met(trees, blocks, groups, chunks).mapInArrow(partial(search, most=positives, same=True), FOUND)
    good = stage(ranked(found, ["anchor_row"], positives, "nth"), "mining-positives")
    windows = good.filter("score >= 0").groupBy("tree").agg(F.collect_set(F.struct("place", "score")).alias("windows"))
    found = met(trees.join(windows, "tree"), blocks, groups, chunks)
    found = found.mapInArrow(partial(search, most=negatives, same=False), FOUND)
    bad = ranked(found, ["anchor_row", "low"], negatives, "rank")
    return good.select(
        "anchor_row", "anchor_id", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")
    ).join(
        bad.select("anchor_row", F.col("low").alias("positive_score"), "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score")),
        ["anchor_row", "positive_score"],
    ).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
