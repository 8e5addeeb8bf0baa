from __future__ import annotations

from collections import defaultdict
from fractions import Fraction

from tests.llm.fixtures import corpus, documents, words
from vayumark.llm import mixing as op

ROWS = "doc_id long, text string, source string, size string, tag string, weight string"


def filled(sizes, weights=(5, 2, 1), epochs=3):
    """Targets by clamping one round after the other, in whole numbers."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    total, clamped = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in clamped]
        room = total - sum(epochs * sizes[s] for s in clamped)
        share = sum(weight[s] for s in open_)
        want = {s: Fraction(room * weight[s], share) for s in open_} if share else {}
        over = {s for s in open_ if want[s] > epochs * sizes[s]}
        if not over:
            return {s: float(want[s]) if s in want else float(epochs * sizes[s]) for s in names}
        clamped |= over


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "s", "t", "w") for i, t, s in rows], ROWS)


def check(spark, rows):
    got = op.mix(frame(spark, rows), "doc_id", "source", "size").collect()
    assert len(got) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for _, t, s in rows:
        sizes[s] += len((t or "").encode().split())
    for r in got:
        assert r.row.size == "s" and 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.row.source]
        taken[r.row.source] += r.taken
        target[r.row.source] = r.target
    want = filled(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        assert taken[s] == round(want[s] + 1e-9)
    again = op.mix(frame(spark, rows[::-1]), "doc_id", "source", "size").collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_targets_are_met(spark):
    rows = [(n, words(n, 5 + n % 40), f"s{n % 7}") for n in range(150)]
    rows += [(500 + n, words(n, 300), "s9") for n in range(40)]
    rows += [(900, "only one", "a"), (901, None, "b"), (902, "", "b"), (903, words(1, 30), None), (None, words(2, 9), "s1"), (3, words(3, 8), "s3")]
    rows += [(77, words(77, 20), "s0")] * 2
    check(spark, rows)


def test_clamps_in_several_rounds(spark):
    check(spark, [(n, words(n, size), f"s{n}") for n, size in enumerate((1, 4, 2, 40, 3, 900, 20, 60))])


def test_nothing_to_mix(spark):
    assert op.mix(frame(spark, []), "doc_id").count() == 0
    assert [r.taken for r in op.mix(frame(spark, [(1, None, "a"), (2, "", None)]), "doc_id").collect()] == [0, 0]
    assert op.mix(documents(spark, corpus()), "doc_id").count() == len(corpus())
