"""Removal of long repeated byte strings by prefix doubling over sampled suffixes.

A suffix array of all positions would move many times the corpus. Here only
positions that the text itself selects are sorted: of the core strings inside
each window of ``length`` bytes the one with the smallest name is its anchor.
Equal windows have equal anchors at equal offsets, so a repeated window is found
at its anchor, and one position in about fifty is enough.

Names are made by prefix doubling: the name of the 2h bytes at i is a hash of
the names of h bytes at i and at i + h. Ranks grow in four rounds, and each
round drops what has become unique or is past the threshold:

1. core bytes at an anchor: anchors whose core occurs once are done;
2. all windows of an anchor at once: if that string occurs twice, all of them repeat;
3. for one anchor of each other kind, the bytes that a few neighbouring windows share;
4. the single windows of what is left.

Names have 64 bits and are compared together with the names of the rounds before.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vayumark.llm.common import keyed, stage

CHUNK = 1 << 18
#: Neighbouring windows that are told apart in the last round only.
CELL = 13
TABLE = np.random.default_rng(20_240_229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ODD1, ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Name of the string made of the strings named ``a`` and ``b``."""
    out = a * ODD1
    out += b
    out ^= out >> np.uint64(32)
    out *= ODD2
    out ^= out >> np.uint64(29)
    return out


def doubled(data: np.ndarray, lengths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Names of the strings of each of ``lengths`` at every position that has one."""
    names, size, out = TABLE[data], 1, {}
    for length in sorted(lengths):
        while size * 2 <= length:
            names = pair(names[:-size], names[size:]) if len(names) > size else names[:0]
            size *= 2
        rest = length - size
        out[length] = names if rest == 0 else pair(names[:-rest], names[rest:]) if len(names) > rest else names[:0]
    return out


def leftmost_minimum(names: np.ndarray, width: int) -> np.ndarray:
    """Position of the first smallest name in every window of ``width`` names."""
    low, at, size = names, np.arange(len(names), dtype=np.int32), 1
    while True:
        step = min(size, width - size)
        if step == 0:
            return at
        if len(low) <= step:
            return at[:0]
        less = low[step:] < low[:-step]
        low = np.where(less, low[step:], low[:-step])
        at = np.where(less, at[step:], at[:-step])
        size += step


def chunks(batch: pa.RecordBatch, column: str = "text"):
    """Rows of ``batch`` and their bytes one behind the other, about CHUNK bytes at a time."""
    rows, parts, size = [], [], 0
    for row, value in enumerate(batch.column(column)):
        data = value.as_buffer() if value.is_valid else b""
        rows.append(row)
        parts.append(np.frombuffer(data, np.uint8))
        size += len(parts[-1])
        if size >= CHUNK:
            yield np.array(rows), parts
            rows, parts, size = [], [], 0
    if rows:
        yield np.array(rows), parts


def find_anchors(length: int, core: int):
    def run(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for rows, parts in chunks(batch):
                sizes = np.array([len(p) for p in parts])
                if sizes.max() < length:
                    continue
                data, ends = np.concatenate(parts), np.cumsum(sizes)
                if len(data) < length:
                    continue
                half = 1 << (length.bit_length() - 1)
                names = doubled(data, (core, half))
                cores, halves = names[core], names[half]
                at = leftmost_minimum(cores, length - core + 1)
                owner = np.repeat(np.arange(len(parts)), sizes)[: len(at)]
                starts = np.flatnonzero(np.arange(len(at)) + length <= ends[owner])
                anchor = at[starts]
                first = np.flatnonzero(np.diff(anchor, prepend=-1))
                last = np.append(first[1:], len(starts)) - 1
                lo, hi, a = starts[first], starts[last], anchor[first]
                rest = length - half
                span = pair(pair(halves[lo], halves[lo + rest]), halves[hi + rest])
                span = pair(span, ((a - lo) << 16 | (hi - lo)).astype(np.uint64))
                doc = owner[lo]
                start = lo - (ends - sizes)[doc]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cores[a].view(np.int64)),
                        pa.array(span.view(np.int64)),
                        pa.array(keys[rows[doc]]),
                        pa.array(start << 24 | (a - lo) << 12 | (hi - lo)),
                    ],
                    names=["core", "span", "key", "at"],
                )

    return run


def listed_windows(length: int, core: int):
    """Windows of the listed anchors of each text, ``CELL`` neighbouring places to a row.

    ``cell`` names the bytes that the windows of a full row have in common.
    """

    def run(batches):
        half = 1 << (length.bit_length() - 1)
        rest = length - half
        width = min(CELL, rest + 1)
        common = length - width + 1
        for batch in batches:
            keys, listed = batch.column("key").to_numpy(), batch.column("anchors")
            for rows, parts in chunks(batch):
                for row, data in zip(rows, parts, strict=True):
                    marks = listed[int(row)].values.to_numpy()
                    alone, at = marks & 1, marks >> 1
                    lo, off, n = at >> 24, at >> 12 & 0xFFF, at & 0xFFF
                    names = doubled(data, (core, half))
                    which = np.repeat(np.arange(len(at)), n + 1)
                    start = lo[which] + np.arange(len(which)) - np.repeat(np.cumsum(n + 1) - (n + 1), n + 1)
                    anchor = (lo + off)[which]
                    cell = (anchor - start) // width
                    first = np.flatnonzero(np.diff(which, prepend=-1) | np.diff(cell, prepend=-1))
                    low = anchor[first] - cell[first] * width
                    name = pair(names[half][low], names[half][low + common - half])
                    name = pair(name, cell[first].astype(np.uint64))
                    windows = pair(names[half][start], names[half][start + rest]).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names[core][anchor[first]].view(np.int64)),
                            pa.array(name.view(np.int64)),
                            pa.array(np.full(len(first), keys[row])),
                            pa.array(start[first]),
                            pa.array(alone[which[first]] == 1),
                            pa.ListArray.from_arrays(
                                pa.array(np.append(first, len(start)), pa.int32()), pa.array(windows)
                            ),
                        ],
                        names=["core", "cell", "key", "start", "alone", "windows"],
                    )

    return run


def cut(length: int):
    def run(batches):
        for batch in batches:
            n_bytes, spans, kept = [], [], []
            ranges = batch.column("ranges")
            for rows, parts in chunks(batch):
                for row, data in zip(rows, parts, strict=True):
                    marks, left, runs = ranges[int(row)], data, 0
                    if marks.is_valid:
                        at = marks.values.to_numpy()
                        edge = np.zeros(len(data) + 1, np.int32)
                        np.add.at(edge, at >> 16, 1)
                        np.add.at(edge, (at >> 16) + (at & 0xFFFF) + length, -1)
                        gone = np.cumsum(edge[:-1]) > 0
                        runs = int(np.count_nonzero(gone[1:] > gone[:-1]) + gone[0])
                        left = data[~gone]
                    n_bytes.append(len(data))
                    spans.append(runs)
                    kept.append(left.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_spans", "kept"],
            )

    return run


def repeated_ranges(rows: DataFrame, length: int, core: int) -> DataFrame:
    """``key`` and packed ``range`` (first start << 16 | further starts) of windows that occur elsewhere."""
    anchors = rows.filter(F.octet_length("text") >= length).mapInArrow(
        find_anchors(length, core), "core long, span long, key long, at long"
    )
    # stages on both sides let the joins split a core that has many of the rows
    seen = stage(anchors.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select("core"), "cores")
    hits = stage(anchors.join(seen, "core"), "anchors")

    kinds = stage(
        hits.groupBy("core", "span").agg(F.count("*").alias("n"), F.min(F.struct("key", "at")).alias("one")), "kinds"
    )
    whole = stage(
        hits.join(kinds.filter("n > 1").select("core", "span"), ["core", "span"]).select(
            "key", F.expr("shiftleft(shiftright(at, 24), 16) | (at & 4095)").alias("range")
        ),
        "ranges",
    )

    mixed = stage(kinds.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select("core"), "cores")
    wanted = (
        kinds.join(mixed, "core")
        .select("one.key", (F.col("one.at") * 2 + (F.col("n") == 1).cast("long")).alias("mark"))
        .groupBy("key")
        .agg(F.collect_list("mark").alias("anchors"))
    )
    cells = stage(
        rows.select("key", "text")
        .join(wanted, "key")
        .mapInArrow(
            listed_windows(length, core),
            "core long, cell long, key long, start long, alone boolean, windows array<long>",
        ),
        "cells",
    )
    shared = stage(
        cells.groupBy("core", "cell").agg(F.count("*").alias("n")).filter("n > 1").select("core", "cell"), "cells"
    )
    windows = stage(
        cells.join(shared, ["core", "cell"])
        .select("core", "key", "start", "alone", F.posexplode("windows").alias("n", "window"))
        .select("core", "window", "key", (F.col("start") + F.col("n")).alias("start"), "alone"),
        "windows",
    )
    twice = stage(
        windows.groupBy("core", "window").agg(F.count("*").alias("n")).filter("n > 1").select("core", "window"), "windows"
    )
    single = stage(
        windows.filter("alone")
        .join(twice, ["core", "window"])
        .select("key", F.shiftleft("start", 16).alias("range")),
        "ranges",
    )
    return whole.union(single)


def remove_repeats(docs: DataFrame, length: int = 200, core: int = 96) -> DataFrame:
    """Texts of ``docs`` (doc_id, text) without the bytes of repeated strings of ``length`` bytes.

    A byte goes if a string of ``length`` bytes that covers it also starts at
    another place of any text, the same text included; what is cut elsewhere does
    not matter. Matches never reach over the end of a text.

    Returns doc_id, n_bytes, n_spans (maximal removed runs) and kept (binary: a
    cut may fall inside a character).

    A null text counts as empty. Texts shorter than ``length`` stay as they are.
    Repeated rows are repeated texts, so they lose all their bytes if long
    enough. Null or repeated ids are allowed; other columns are ignored. An empty
    table gives an empty result.
    """
    assert core < length < 4096
    rows = keyed(docs, "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranges = repeated_ranges(rows, length, core).groupBy("key").agg(F.collect_list("range").alias("ranges"))
    return rows.join(ranges, "key", "left").select("doc_id", "text", "ranges").mapInArrow(
        cut(length), "doc_id long, n_bytes long, n_spans long, kept binary"
    )
