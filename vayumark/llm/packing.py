"""Packing of documents into sequences along a space-filling curve.

A document's tokens are counted in hashed buckets, the counts are projected to a
few dimensions, and the point's place on a Hilbert curve is the document's key.
Documents are range-sorted by key, so neighbours in a sequence are neighbours on
the curve. Every task writes its documents one behind the other into sequences
and cuts where one is full; what is left at its end is cut at powers of two, which
need no padding.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vayumark.llm.common import stage

BUCKETS = 1024
DIMENSIONS = 4
BITS = 12
SIGNS = np.random.default_rng(20_240_229).standard_normal((BUCKETS, DIMENSIONS))


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of ``points`` (rows of integers below 2 ** bits)."""
    x = points.astype(np.int64).T.copy()
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the turns of the cells, from the largest down
        p = q - 1
        for i in range(len(x)):
            turned = (x[i] & q) > 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(turned, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):  # Gray code
        x[i] ^= x[i - 1]
    flip, q = np.zeros(x.shape[1], np.int64), top
    while q > 1:
        flip = np.where(x[-1] & q, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    place = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for row in x:
            place = place << 1 | row >> bit & 1
    return place


def curve_keys(counts: np.ndarray) -> np.ndarray:
    """Hilbert places of rows of bucket counts."""
    length = np.linalg.norm(counts, axis=1, keepdims=True)
    points = counts / np.where(length == 0, 1, length) @ SIGNS
    return hilbert(np.clip((points + 4) / 8 * (1 << BITS), 0, (1 << BITS) - 1))


def encoder(path: str):
    """Encoder of whole texts from a file of byte-pair ranks; strings of special tokens are ordinary text."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def tokenised(docs: DataFrame, path: str, end: int, *columns: str) -> DataFrame:
    """``columns`` of ``docs`` (text), ``place`` on the curve and ``ids`` (binary, little-endian, 16 bits)."""

    def run(batches):
        code = encoder(path)
        assert code.n_vocab <= 1 << 16
        for batch in batches:
            ids, counts = [], np.zeros((batch.num_rows, BUCKETS), np.float32)
            for row, text in enumerate(batch.column("text").to_pylist()):
                found = np.append(np.array(code.encode_ordinary(text or ""), "<u2"), np.array([end], "<u2"))
                counts[row] = np.bincount(found % BUCKETS, minlength=BUCKETS)
                ids.append(found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(curve_keys(counts)), pa.array(ids, pa.binary())],
                names=[*columns, "place", "ids"],
            )

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), "place long, ids binary"])
    return docs.select(*dict.fromkeys([*columns, "text"])).mapInArrow(run, schema)


def packed(size: int):
    def run(batches):
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        sequence, fill, held = task << 40, 0, []

        def flush(pieces):
            doc, start, ids, total, owner, offset = zip(*pieces, strict=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()),
                    pa.array(start, pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                    pa.array(total, pa.int64()),
                    pa.array(owner, pa.int64()),
                    pa.array(offset, pa.int64()),
                ],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        for batch in batches:
            done = []
            for doc, data in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                ids, at = np.frombuffer(data.as_buffer(), "<u2"), 0
                while at < len(ids):
                    piece = ids[at : at + size - fill]
                    held.append((doc, at, piece, len(ids), sequence, fill))
                    at, fill = at + len(piece), fill + len(piece)
                    if fill == size:
                        done += held
                        sequence, fill, held = sequence + 1, 0, []
                    if len(done) >= 4096:
                        yield flush(done)
                        done = []
            held = [(d, s, x.copy(), t, q, o) for d, s, x, t, q, o in held]  # outlive the batch
            if done:
                yield flush(done)
        done, left = [], [(d, s, x, t) for d, s, x, t, _, _ in held]
        while fill:
            room, offset = 1 << (fill.bit_length() - 1), 0
            fill -= room
            while offset < room:
                doc, start, ids, total = left.pop(0)
                piece = ids[: room - offset]
                done.append((doc, start, piece, total, sequence, offset))
                offset += len(piece)
                if len(piece) < len(ids):
                    left.insert(0, (doc, start + len(piece), ids[len(piece) :], total))
            sequence += 1
        if done:
            yield flush(done)

    return run


def pack(docs: DataFrame, path: str, size: int = 1024, end: int = 0) -> DataFrame:
    """Pieces of the tokens of ``docs`` (doc_id, text) in sequences of at most ``size``.

    ``path`` names a file of byte-pair ranks that every machine has. Every document is
    followed by the id ``end``. Returns doc_id, start (in its document), length, ids
    (binary, little-endian, 32 bits), doc_tokens (with the end), sequence_id and offset
    (in its sequence, without gaps). Sequences are full, or a power of two long at a
    task's end, so there is no padding.

    A null text counts as empty and gives its end alone. Repeated rows are packed as
    often as they occur; rows with equal keys are told apart by id and place in the
    table. Other columns are ignored. An empty table gives an empty result.
    """
    rows = stage(
        tokenised(docs.select(F.col("doc_id").cast("long"), "text"), path, end, "doc_id").withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "tokens",
    )
    order = ["place", "doc_id", "row"]
    return (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "ids")
        .mapInArrow(
            packed(size),
            "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
        )
    )
