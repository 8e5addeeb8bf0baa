"""Near-duplicate vectors by int8 tile products with error bounds.

Equal vectors become one row with a multiplicity. Distinct vectors are dealt to
cells around pivots. By the triangle inequality of angles a vector can only link
into a cell whose pivot is at most the cell's radius plus the threshold's angle
away, so it visits those cells and no others. Cells are cut into tiles of bounded
size; in a tile, products of vectors quantised to 8 bits decide all pairs but those
within the quantisation error of the threshold, and only these and the ones above
are recomputed in double precision.

A tile returns one row per linked vector, with its number of links and one link
that ties it into its component; it never returns pairs.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vayumark.llm.common import among_smallest, components, keyed, stage

#: Most pivots of one dimension; they and the cells' sizes are all that reaches the driver.
PIVOTS = 4096
#: Of float32 products and sums of exact integers, and of angles.
SLACK = 1e-5


def rows_of(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of ``dim`` components as a matrix of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(values, np.float64).reshape(-1, dim)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # else squares of extreme components leave the range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def quantise(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """8-bit components, scale, norm of what quantising lost, norm of what is left."""
    scale = np.abs(u).max(axis=1) / 127
    q = np.rint(u / scale[:, None])
    back = q * scale[:, None]
    return q.astype(np.int8), scale, np.linalg.norm(u - back, axis=1), np.linalg.norm(back, axis=1)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 rows. Single precision holds sums of 1024 products exactly."""
    out = 0.0
    for low in range(0, a.shape[1], 1024):
        out = out + a[:, low : low + 1024].astype(np.float32) @ b[:, low : low + 1024].astype(np.float32).T
    return out


def linked(ua: np.ndarray, ub: np.ndarray, threshold: float, within: bool, block: int = 512):
    """Blocks of (i, j) with the cosine of ``ua[i]`` and ``ub[j]`` at least ``threshold``; i < j if ``within``."""
    qa, sa, ea, na = quantise(ua)
    qb, sb, eb, _ = (qa, sa, ea, na) if within else quantise(ub)
    most = eb.max()
    for low in range(0, len(ua), block):
        part = slice(low, low + block)
        least = (threshold - ea[part] - na[part] * most - SLACK) / sa[part]
        scaled = product(qa[part], qb) * sb[None, :].astype(np.float32)
        i, j = np.nonzero(scaled >= least[:, None].astype(np.float32))
        i += low
        keep = (i < j) if within else np.ones(len(i), bool)
        keep &= scaled[i - low, j] * sa[i] + ea[i] + na[i] * eb[j] >= threshold - SLACK
        i, j = i[keep], j[keep]
        for at in range(0, len(i), 1 << 16):
            x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            above = np.einsum("ij,ij->i", ua[x], ub[y]) >= threshold
            yield x[above], y[above]


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels of components after adding the links (i, j)."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


def tile_links(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        dim = group.column("dim")[0].as_py()
        nodes, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
        second = group.column("second").to_numpy(zero_copy_only=False).astype(bool)
        vectors = unit(rows_of(group.column("embedding").chunk(0), dim))
        a, b = np.flatnonzero(~second), np.flatnonzero(second)
        links, label = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
        # a tile of one block holds its rows once and is compared with itself
        within = group.column("alone")[0].as_py()
        if within or (len(a) and len(b)):
            for x, y in linked(vectors[a], vectors[a] if within else vectors[b], threshold, within):
                i, j = a[x], (a if within else b)[y]
                links += np.bincount(i, copies[j], len(nodes)).astype(np.int64)
                links += np.bincount(j, copies[i], len(nodes)).astype(np.int64)
                label = merge(label, i, j)
        some = np.flatnonzero(links)
        return pa.table({"node": nodes[some], "links": links[some], "mate": nodes[label[some]]})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, tile: int = 2048) -> DataFrame:
    """vec_id, n_links and component_id of every row of ``vectors`` (vec_id, embedding).

    Two rows link if the cosine of their vectors is at least ``threshold`` in double
    precision, whatever their other columns hold. Vectors that are null, empty, zero,
    or hold a null or a component that is not finite link with nothing, nor do
    vectors of different lengths. Equal vectors link. component_id is the smallest
    vec_id reachable. Repeated rows and ids stay rows of their own; a null vec_id
    never names a component that has another id. An empty table gives an empty result.

    Distinct lengths of vectors are assumed to be few.
    """
    rows = keyed(vectors, "vec_id", "embedding", by="vec_id", value="embedding")
    infinite = float("inf")
    good = F.expr("size(embedding) > 0 and forall(embedding, x -> x is not null) and exists(embedding, x -> x <> 0)") & (
        F.forall("embedding", lambda x: ~F.isnan(x) & (F.abs(x) < infinite))
    )
    usable = F.coalesce(F.col("embedding").isNotNull() & good, F.lit(False))
    rows = rows.withColumn("usable", usable)
    distinct = stage(
        rows.filter("usable")
        .groupBy("embedding")
        .agg(F.min("key").alias("node"), F.count("*").alias("copies"), F.min("vec_id").alias("first"))
        .withColumn("dim", F.size("embedding")),
        "vectors",
    )

    sizes = {r["dim"]: r["n"] for r in distinct.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    wanted = {dim: min(PIVOTS, -(-n // tile)) for dim, n in sizes.items()}
    order = Window.partitionBy("dim").orderBy(F.xxhash64("node"), "node")
    count = F.coalesce(*(F.when(F.col("dim") == dim, n) for dim, n in sizes.items()), F.lit(0))
    picked = (
        distinct.select("dim", "node", "embedding")
        .filter(among_smallest(F.xxhash64("node"), max([1, *wanted.values()]), count))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= max([1, *wanted.values()]))
    )
    by_dim = defaultdict(list)
    for r in picked.orderBy("dim", "rank").collect():
        if r["rank"] <= wanted[r["dim"]]:
            by_dim[r["dim"]].append(r["embedding"])
    pivots = {dim: unit(np.array(v, np.float64)) for dim, v in by_dim.items()}

    def homes(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cell, angle = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                for low in range(0, len(at), 1024):
                    some = at[low : low + 1024]
                    cosine = unit(rows_of(batch.column("embedding").take(pa.array(some)), dim)) @ pivots[dim].T
                    cell[some] = cosine.argmax(axis=1)
                    angle[some] = np.arccos(np.clip(cosine.max(axis=1), -1, 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(angle)], names=[*batch.schema.names, "cell", "angle"]
            )

    kind = dict(distinct.dtypes)["embedding"]
    base = f"node long, copies long, dim int, embedding {kind}"
    dealt = stage(
        distinct.select("node", "copies", "dim", "embedding").mapInArrow(homes, f"{base}, cell int, angle double"),
        "cells",
    )
    radius, held = {}, {}
    for r in dealt.groupBy("dim", "cell").agg(F.max("angle").alias("r"), F.count("*").alias("n")).collect():
        radius[r["dim"], r["cell"]], held[r["dim"], r["cell"]] = r["r"], r["n"]
    reach = {
        dim: np.array([radius.get((dim, c), -9.0) for c in range(len(p))]) + math.acos(threshold) + SLACK
        for dim, p in pivots.items()
    }

    def visits(batches):
        """The earlier cells that a row may link into."""
        for batch in batches:
            dims, cell = batch.column("dim").to_numpy(), batch.column("cell").to_numpy()
            out: list[np.ndarray] = [np.empty(0, np.int32)] * len(dims)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                for low in range(0, len(at), 1024):
                    some = at[low : low + 1024]
                    cosine = unit(rows_of(batch.column("embedding").take(pa.array(some)), dim)) @ pivots[dim].T
                    near = np.arccos(np.clip(cosine, -1, 1)) <= reach[dim][None, :]
                    near &= np.arange(near.shape[1])[None, :] < cell[some][:, None]
                    for row, cells in zip(some, near, strict=True):
                        out[row] = np.flatnonzero(cells).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("node", "copies", "dim", "embedding", "cell")), pa.array(out, pa.list_(pa.int32()))],
                names=["node", "copies", "dim", "embedding", "cell", "visits"],
            )

    going = stage(dealt.drop("angle").mapInArrow(visits, f"{base}, cell int, visits array<int>"), "visits")
    calls = {
        (r["dim"], r["to"]): r["n"]
        for r in going.select("dim", F.explode("visits").alias("to")).groupBy("dim", "to").agg(F.count("*").alias("n")).collect()
    }
    blocks = {k: -(-n // tile) for k, n in held.items()}
    guests = {k: -(-n // tile) for k, n in calls.items()}

    def tiles(batches):
        """Tile as (cell, guests or not, block, block); ``second`` marks the side of a row, ``alone`` a block with itself."""
        for batch in batches:
            tile_ids, second, alone = [], [], []
            columns = (batch.column(c) for c in ("dim", "cell", "visits", "node"))
            for dim, cell, visited, node in zip(*(c.to_pylist() for c in columns), strict=True):
                spread = node * 0x9E3779B97F4A7C15 % (1 << 64) >> 33
                n = blocks[dim, cell]
                own = spread % n
                ids = [cell << 41 | min(own, j) << 20 | max(own, j) for j in range(n)]
                sides, lone = [own > j for j in range(n)], [own == j for j in range(n)]
                ids += [cell << 41 | 1 << 40 | own << 20 | j for j in range(guests.get((dim, cell), 0))]
                for to in visited:
                    j = spread % guests[dim, to]
                    ids += [to << 41 | 1 << 40 | i << 20 | j for i in range(blocks[dim, to])]
                n_home = n + guests.get((dim, cell), 0)
                tile_ids.append(ids)
                second.append(sides + [False] * (n_home - n) + [True] * (len(ids) - n_home))
                alone.append(lone + [False] * (len(ids) - n))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("node", "copies", "dim", "embedding")),
                    pa.array(tile_ids, pa.list_(pa.int64())),
                    pa.array(second, pa.list_(pa.bool_())),
                    pa.array(alone, pa.list_(pa.bool_())),
                ],
                names=["node", "copies", "dim", "embedding", "tile", "second", "alone"],
            )

    placed = going.mapInArrow(tiles, f"{base}, tile array<long>, second array<boolean>, alone array<boolean>")
    spread = placed.select(
        "node", "copies", "dim", "embedding", F.explode(F.arrays_zip("tile", "second", "alone")).alias("t")
    ).select("node", "copies", "dim", "embedding", "t.*")
    found = stage(
        spread.groupBy("dim", "tile").applyInArrow(tile_links(threshold), "node long, links long, mate long"), "found"
    )

    joined = components(found.select(F.col("node").alias("a"), F.col("mate").alias("b")))
    totals = found.groupBy("node").agg(F.sum("links").alias("links"))
    owned = (
        distinct.select("embedding", "node", "copies", "first")
        .join(joined, "node", "left")
        .join(totals, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    lowest = owned.groupBy("component").agg(F.min("first").alias("lowest"))
    named = owned.join(lowest, "component").select(
        "embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "lowest"
    )
    lone = rows.filter(~F.col("usable")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    together = (
        rows.filter("usable")
        .join(named, "embedding")
        .select("vec_id", F.col("links").alias("n_links"), F.col("lowest").alias("component_id"))
    )
    return together.union(lone)
