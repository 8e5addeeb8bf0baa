from __future__ import annotations

import math

import numpy as np
import pytest

from vayumark.llm import hard_negatives as op

SCHEMA = "vec_id long, embedding array<double>, label int, row string, score string, tree string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "r", "s", "t") for r in rows], SCHEMA)


def expected(rows):
    """Every anchor with every row, in whole numbers."""
    good = []
    for place, (i, x, label) in enumerate(rows):
        if x is not None and label is not None and all(v is not None and math.isfinite(v) for v in x):
            moved = (label + 1) % 10 if i is not None and i % 7 == 0 else label
            good.append((place, i, moved, [math.floor(256 * v) for v in x]))
    out = []
    for place, i, label, x in good:
        if i is None or i % 100:
            continue
        scored = [
            (-sum(p * q for p, q in zip(x, y, strict=False)), j is None, j or 0, at, j, other == label)
            for at, j, other, y in good
            if at != place
        ]
        scored.sort()
        for p in [s for s in scored if s[5]][:5]:
            hard = [s for s in scored if not s[5] and 80 * -p[0] <= 100 * -s[0] <= 100 * -p[0]]
            out += [(i, p[4], n, s[4], -p[0], -s[0]) for n, s in enumerate(hard[:5], 1)]
    return sorted(out, key=str)


def clustered(seed, n, spread=0.15, dim=12, copies=0):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(6, dim))
    at = pick.integers(0, 6, n)
    x = centres[at] + spread * pick.normal(size=(n, dim))
    rows = [(int(i), [float(v) for v in x[i]], int(pick.integers(0, 10))) for i in range(n)]
    return rows + [(20_000 + i, rows[0][1], i % 10) for i in range(copies)]


def check(spark, rows):
    # one task reads the rows in order, so that rows which tie in all of it keep their places
    got = op.mine(table(spark, rows).coalesce(1)).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
    assert dict(got.dtypes)["rank"] == "int"
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


@pytest.mark.parametrize("spread", [0.05, 1.5])
def test_all_negatives_as_by_all_pairs(spark, monkeypatch, spread):
    monkeypatch.setattr(op, "ROWS", 64)
    monkeypatch.setattr(op, "ANCHORS", 4)
    check(spark, clustered(1, 1500, spread))


def test_copies_of_an_anchor_and_ties(spark):
    check(spark, clustered(2, 700, 0.3, copies=350) + [(0, [1.0] * 12, 3), (100, [0.0] * 12, 4), (None, [0.9] * 12, 5)])


def test_odd_rows(spark):
    rows = clustered(3, 300, 0.4)
    rows += [(900, None, 1), (1000, [1.0] * 12, None), (1100, [None] + [1.0] * 11, 2), (1200, [math.nan] * 12, 3)]
    rows += [(1300, [math.inf] * 12, 4), (1400, [], 5), (1500, [0.5, 2.0], 6), (1600, [2.0e5] * 12, 7), (1700, [-2.0e5] * 12, 8)]
    rows += [(1800, [1.5e5] * 12, 7), (1801, [1.6e5] * 12, 8), (1900, [-3.0] * 12, 9), (1901, [3.0] * 12, 9)]
    check(spark, rows)


def test_vectors_too_long_for_a_score_take_no_part(spark):
    rows = clustered(4, 250, 0.4)
    far = [(2000, [1.0e300] * 12, 1), (2001, [1.0e9] * 12, 2)]
    got = op.mine(table(spark, rows + far).coalesce(1)).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_nothing_to_mine(spark):
    assert op.mine(table(spark, [])).count() == 0
    assert op.mine(table(spark, [(100, [1.0], 1)])).count() == 0
    assert op.mine(table(spark, [(100, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)]).filter("vec_id < 100")).count() == 0


def test_bounds_spare_most_of_clustered_rows():
    """One block of each: what is scored again against all pairs, and the best of it against all products."""
    rows = clustered(5, 900, 0.02)
    x = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    labels = np.array([r[2] for r in rows])

    def block(at):
        import pyarrow as pa

        fields = pa.table(
            {"row": at, "vec_id": at, "label": labels[at], "vector": pa.array([list(v) for v in x[at]], pa.list_(pa.int64()))}
        )
        return fields

    picked = np.arange(0, 900, 9)
    order, parents, edges, depths = op.spanning_tree(x[picked])
    fields, _ = op.packed(block(picked), order)
    fields |= {"parents": parents.tobytes(), "edges": edges.tobytes(), "depths": depths.tobytes()}
    others, _ = op.packed(block(np.arange(900)))
    anchors, counts = op.Block(fields), {}
    windows = []
    for row in anchors.rows:
        score = int(np.sort(x @ x[row])[-40])
        windows.append([(-(-80 * score // 100), score)])
    seen = np.full((len(picked), 1), -np.inf)
    got = {n: list(s) for n, _, _, s in op.tile(anchors, fields, op.Block(others), windows, seen, False, 5, counts)}
    for n, row in enumerate(anchors.rows):
        scores = x @ x[row]
        low, high = windows[n][0]
        want = sorted((int(s) for s, l in zip(scores, labels, strict=True) if l != labels[row] and low <= s <= high), reverse=True)[:5]
        assert got.get(n, []) == want
    assert counts["scored"] < 0.5 * counts["pairs"]
