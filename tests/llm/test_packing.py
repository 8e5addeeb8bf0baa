from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.fixtures import corpus, documents
from vayumark.llm import packing as op

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize(("bits", "dims"), [(4, 2), (3, 3), (2, 4)])
def test_hilbert_visits_neighbours(bits, dims):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    place = op.hilbert(grid, bits)
    assert sorted(place) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def slow_ids(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_reference_tokenizer():
    code = op.encoder(RANKS)
    odd = ["<|endoftext|>", "a  b\n\n c\t", "naïve ½ ٣ 数 😀👍🏽", "  x", "can't WE'LL 'S", "\x00\x1f", "é", "１２ab"]
    for text in [t for _, t in corpus() if t and len(t) < 5000] + odd:
        assert code.encode_ordinary(text) == slow_ids(text)


def test_pieces_cover_every_document(spark):
    texts = corpus()
    got = op.pack(documents(spark, texts), RANKS, size=64).collect()
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length > 0
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 64 or (at < 64 and at & (at - 1) == 0)
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.start, tuple(np.frombuffer(bytes(r.ids), "<u4").tolist()), r.doc_tokens))
    want = defaultdict(list)
    for i, t in texts:
        want[i].append(tuple(slow_ids(t)) + (0,))
    for i, documents_of in want.items():
        assert sum(map(len, documents_of)) == sum(len(ids) for _, ids, _ in pieces[i])
        if len(documents_of) == 1:
            assert sum((ids for _, ids, _ in sorted(pieces[i])), ()) == documents_of[0]
            assert {n for _, _, n in pieces[i]} == {len(documents_of[0])}
        else:
            assert Counter(x for d in documents_of for x in d) == Counter(x for _, ids, _ in pieces[i] for x in ids)
    assert op.pack(documents(spark, []), RANKS).count() == 0
