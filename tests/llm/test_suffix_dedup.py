from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from tests.llm.fixtures import corpus, documents, words
from vayumark.llm import suffix_dedup as op


def brute(texts, length):
    data = [(t or "").encode() for _, t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(bool(x) for x in bytes(gone).split(b"\0"))
        out.append((len(d), runs, bytes(b for b, g in zip(d, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize(("length", "core"), [(200, 96), (50, 20)])
def test_equals_all_substrings(spark, length, core):
    texts = corpus() + [(70, "pre" + words(99, 60)[:260]), (71, words(99, 60)[5:240] + "post")]
    got = op.remove_repeats(documents(spark, texts), length, core).collect()
    want = sorted(((i is not None, i or 0), *r) for (i, _), r in zip(texts, brute(texts, length), strict=True))
    assert sorted(((r[0] is not None, r[0] or 0), r[1], r[2], bytes(r[3])) for r in got) == want


def test_empty_table(spark):
    assert op.remove_repeats(documents(spark, [])).count() == 0


def test_names_and_minimum():
    data = np.frombuffer(b"abcabcabcabcabcx" * 3, np.uint8)
    names = op.doubled(data, (5, 8))
    for length, values in names.items():
        parts = [bytes(data[i : i + length]) for i in range(len(data) - length + 1)]
        assert len(values) == len(parts)
        assert len(set(values.tolist())) == len(set(parts)) == len(set(zip(parts, values.tolist(), strict=True)))
    low = np.array([5, 3, 3, 9, 1, 4, 4, 4], np.uint64)
    assert op.leftmost_minimum(low, 3).tolist() == [1, 1, 4, 4, 4, 5]
