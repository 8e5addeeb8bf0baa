from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from vayumark.llm import prefix_trie as op

SCHEMA = "conv_id long, turn long, role string, text string, depth long, k1 string, salt string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "k", "s") for r in rows], SCHEMA)


def expected(rows):
    """The trie with whole sequences as keys, one node after the other."""
    told = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            told[conv].append((turn is not None, turn or 0, role or "", text or ""))
    told = {c: [t[2:] for t in sorted(turns)] for c, turns in told.items()}
    built = {}
    for c, turns in told.items():
        h = zlib.crc32(str(c).encode()) % 6
        opens = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(told.get(opens, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, cs in members.items():
        gain = (len(cs) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += gain
    out = []
    for node, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if built[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        row = (min(cs), len(node), parent, len(cs), children[node], leaves[node], saved[node])
        out.append((*row, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, band=op.BAND):
    got = op.trie(table(spark, rows), band)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def conversations(seed, n, most=9, words=3):
    pick = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(pick.randint(1, most)):
            rows.append((c * 3 - 20, t, pick.choice(["user", "assistant"]), pick.choice(["a", "bb", "ccc", "é😀"][:words])))
    return rows


@pytest.mark.parametrize("band", [2, 8])
def test_all_columns_as_by_whole_sequences(spark, band):
    rows = conversations(1, 150)
    rows += [(500, None, "user", "late"), (500, 3, None, None), (500, 3, None, None), (500, 3, "user", "x"), (None, 1, "user", "lost")]
    rows += [(-7, 0, "user", "below zero"), (-100, 0, "user", "block"), (-100, 1, "user", "of minus"), (-101, 5, "user", "y")]
    check(spark, rows, band)


def test_long_conversations_take_rounds_by_the_logarithm(spark, monkeypatch):
    monkeypatch.setattr(op, "CHUNK", 16)
    monkeypatch.setattr(op, "PIECE", 4)
    rows = [(c, t, "user", "same" if t < 90 + c else f"own {c}") for c in (0, 1, 2, 3, 100) for t in range(130)]
    rows += conversations(2, 60, most=3, words=1)
    staged, stage = [], op.stage
    monkeypatch.setattr(op, "stage", lambda df, label: staged.append(label) or stage(df, label))
    check(spark, rows, 2)
    # 130 turns are 8 levels of bands of two, up and down
    assert staged.count("band-totals") == 8 and staged.count("band-complete") == 7


def test_one_conversation_that_holds_a_third_of_all_turns(spark):
    rows = [(300, t, "user", f"{t % 7}") for t in range(700)] + conversations(3, 250, most=8)
    check(spark, rows)


def test_many_conversations_that_end_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(op, "PIECE", 16)
    check(spark, [(c, 0, "user", "hello") for c in range(0, 4000, 7)])


def test_no_conversation_no_node(spark):
    assert op.trie(table(spark, [])).count() == 0
    check(spark, [(5, None, None, None)])
