from __future__ import annotations

import numpy as np

from vayumark.llm import embedding_dedup as op

SCHEMA = "vec_id long, embedding array<float>, label int, node string, dim string, copies string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "n", "d", "c") for i, v in rows], SCHEMA)


def brute(rows, threshold):
    good = [v is not None and len(v) > 0 and None not in v and bool(np.isfinite(v).all()) and any(v) for _, v in rows]
    links, label = [0] * len(rows), list(range(len(rows)))
    near = [[] for _ in rows]
    for a in range(len(rows)):
        for b in range(len(rows)):
            if a != b and good[a] and good[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], np.float32).astype(float), np.array(rows[b][1], np.float32).astype(float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold - (1e-12 if np.array_equal(x, y) else 0):
                    near[a].append(b)
                    links[a] += 1
    for a in range(len(rows)):
        todo = [a]
        while todo:
            for b in near[todo.pop()]:
                if label[b] > label[a]:
                    label[b] = label[a]
                    todo.append(b)
    ids = [i for i, _ in rows]
    out = []
    for a in range(len(rows)):
        named = [ids[b] for b in range(len(rows)) if label[b] == label[a] and ids[b] is not None]
        out.append((ids[a], links[a], min(named) if named else None))
    return sorted(out, key=str)


def test_equals_all_pairs(spark):
    draw = np.random.default_rng(3)
    rows = [(n, draw.normal(size=16).tolist()) for n in range(60)]
    for n in range(60):  # close to the threshold from both sides
        base = np.array(rows[n % 12][1])
        rows.append((100 + n, (base + draw.normal(size=16) * np.linalg.norm(base) / 4 * (0.3 + n / 80)).tolist()))
    rows += [(200, rows[0][1]), (201, rows[0][1]), (201, rows[0][1]), (202, [2 * x for x in rows[1][1]])]
    nan, inf = float("nan"), float("inf")
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [nan] * 16), (304, [inf] + [1.0] * 15), (305, [None] + [1.0] * 15)]
    rows += [(306, [1.0, 2.0]), (307, [2.0, 4.1]), (308, [1e38] * 16), (309, [1e-40] * 16), (None, rows[2][1]), (300, rows[3][1])]
    got = op.near_duplicates(frame(spark, rows), 0.9, tile=16).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 0.9)


def test_error_bounds_hold():
    draw = np.random.default_rng(4)
    u = op.unit(draw.normal(size=(300, 24)))
    q, scale, lost, left = op.quantise(u)
    bound = lost[:, None] + left[:, None] * lost[None, :]
    assert (np.abs(u @ u.T - op.product(q, q) * scale[:, None] * scale[None, :]) <= bound + 1e-12).all()


def test_empty_table(spark):
    assert op.near_duplicates(frame(spark, [])).count() == 0
