from __future__ import annotations

from hypothesis import given
from hypothesis import strategies as st

from vayumark.llm import chat as op

TREES = "tree long, node long, parent long, role string, text string, score double, leaf string, name string, above string"
text = st.lists(st.sampled_from([*"ab\\<|>\n_n é😀", op.START, op.END]), max_size=20).map("".join)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb<|"]) | text, text), max_size=5))
def test_round_trip(turns):
    formatted, spans = op.format_turns(turns)
    assert op.read_turns(formatted) == turns
    assert [op.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def trees(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TREES)


def branches(rows):
    """Root-to-leaf paths by walking up."""
    up = {}
    for tree, node, parent, *_ in rows:
        up.setdefault((tree, node), parent)
    inner = {(t, p) for (t, _), p in up.items() if (t, p) in up}
    out = {}
    for tree, node in up:
        if (tree, node) not in inner:
            path, at = [], node
            while at is not None and (tree, at) in up and at not in path:
                path.append(at)
                at = up[tree, at]
            if at is None or (tree, at) not in up:
                out[tree, node] = path[::-1]
    return out


ROWS = [
    (1, 0, None, "user", "q", 1.0),
    (1, 1, 0, "assistant", "a1", 2.0),
    (1, 2, 0, "assistant", "a2", 2.5),
    (1, 3, 1, "user", "more", 1.0),
    (1, 4, 3, None, None, None),
    (1, 5, 99, "user", "parent is gone", 0.5),
    (2, 7, None, "user", "tie", 0.0),
    (2, 8, 7, "assistant", "x", 1.0),
    (2, 9, 7, "assistant", "y", 1.0),
    (3, 1, 2, "user", "circle", 1.0),
    (3, 2, 1, "user", "circle", 1.0),
    (3, 3, 2, "user", "below a circle", 9.0),
    (None, 1, None, "user", "no tree", 1.0),
    (None, 2, 1, "assistant", "none", 1.0),
    *((4, n, n - 1 if n else None, "user", f"t{n}", 0.0) for n in range(37)),
]


def test_paths_and_ranks(spark):
    want = branches(ROWS)
    score = {(t, n): s or 0.0 for t, n, _, _, _, s in ROWS}
    said = {(t, n): (r or "", x or "") for t, n, _, r, x, _ in ROWS}
    got = op.format_trees(trees(spark, ROWS + ROWS[:1]), top=9).collect()
    assert {(r.tree, r.leaf): r.score for r in got} == {k: sum(score[k[0], n] for n in p) for k, p in want.items()}
    for r in got:
        turns = [said[r.tree, n] for n in want[r.tree, r.leaf]]
        assert op.read_turns(r.text) == turns == [tuple(t) for t in r.turns]
        assert (r.text, [tuple(x) for x in r.loss]) == op.format_turns(turns)
    best = {r.tree: r.leaf for r in op.format_trees(trees(spark, ROWS)).collect()}
    assert best == {1: 4, 2: 8, 4: 36, None: 2}


def test_chains(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 5, None, None), (None, 0, "user", "x"), (1, 1, "assistant", "b"), (1, None, "system", "s")]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.tree: [tuple(t) for t in r.turns] for r in op.format_trees(op.chains(talks)).collect()}
    assert got == {
        1: [("system", "s"), ("user", "a"), ("assistant", "b"), ("assistant", "b")],
        2: [("", "")],
        None: [("user", "x")],
    }
    assert op.digests(op.format_trees(op.chains(talks.limit(0)))).count() == 0
