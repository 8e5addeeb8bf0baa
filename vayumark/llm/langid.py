"""Language identification by mixtures of languages.

A language is a distribution over hashed character n-grams of one to three code
points, learned from labelled texts. A document is a mixture of languages whose
proportions expectation-maximisation estimates from the likelihoods of all its
n-grams. Sets of its strongest languages are then compared by likelihood minus a
penalty for every further language, and the language with the largest proportion
in the best set is the prediction.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vayumark.llm.common import among_smallest, stage

#: Buckets of hashed n-grams.
BUCKETS = 1 << 15
#: Most training rows of a language: those with the smallest hashes.
TRAIN_ROWS = 2048
#: N-grams overlap, so their likelihoods count this part of what independent draws would.
INDEPENDENT = 1 / 6
ROUNDS = 12
#: Most bytes of a model, which every executor holds once: 2,048 languages.
MOST_BYTES = 1 << 29


def letters(text: str) -> str:
    """Lower-case letters and marks of ``text``; all else becomes one space between words."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def letters_table() -> dict[int, str]:
    """Code points below 0x3000 that are no letters, as a table for ``str.translate``."""
    return {c: " " for c in range(0x3000) if not chr(c).isalpha()}


def grams(text: str, blank: dict[int, str]) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets of the n-grams of a whole text and how often each occurs; None without a letter."""
    words = text.lower().translate(blank).split()
    if not words:
        return None
    joined = " " + " ".join(words) + " "
    if not any(w[0].isalpha() for w in words):
        joined = letters(text)
        if not joined:
            return None
        joined = f" {joined} "
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    one = points * np.uint64(0x9E3779B97F4A7C15)
    two = (one[:-1] ^ (one[:-1] >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F) + one[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint64(31))) * np.uint64(0x165667B19E3779F9) + one[2:]
    hashed = np.concatenate([one[points != 32], two, three])
    hashed ^= hashed >> np.uint64(29)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    counts = np.bincount((hashed >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at].astype(np.float64)


def proportions(likelihood: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the languages (rows of ``likelihood``) in a document, and its log-likelihood."""
    share, total = np.full(len(likelihood), 1 / len(likelihood)), counts.sum()
    for _ in range(ROUNDS if len(share) > 1 else 0):
        joint = share[:, None] * likelihood
        share = joint @ (counts / joint.sum(axis=0)) / total
    return share, float(counts @ np.log(np.maximum(share @ likelihood, 1e-300)))


def mixture(likelihood: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The languages of a document and their shares, by penalised likelihood."""
    share, _ = proportions(likelihood, counts)
    order = np.argsort(-share, kind="stable")
    penalty = 0.5 * math.log(max(2.0, counts.sum() * INDEPENDENT))
    best, chosen = -math.inf, None
    for size in range(1, len(order) + 1):
        some = order[:size]
        shares, value = proportions(likelihood[some], counts)
        value = value * INDEPENDENT - penalty * (size - 1)
        if value <= best:
            break
        best, chosen = value, (some, shares)
    return chosen


def train(docs: DataFrame, most: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    """Probability of each bucket in each language of ``docs`` (doc_id, text, lang).

    At most ``most`` rows of a language are used, with whole texts: different rows, as
    rows that are equal in id, text and language count once, and an id that repeats is
    drawn text by text. Rows without an id, a language or a letter teach nothing.
    """
    order = Window.partitionBy("lang").orderBy("draw", "doc_id", "other")
    row = ["doc_id", "lang", "draw", "other"]
    marked = docs.filter("lang is not null and text is not null and doc_id is not null").select(
        "doc_id", "lang", "text", F.xxhash64("doc_id", "text").alias("draw"), F.xxhash64("text", "lang").alias("other")
    )
    usable = stage(marked.select(row).distinct(), "training-rows")
    counts = stage(usable.groupBy("lang").agg(F.count("*").alias("rows")), "languages")
    picked = (
        usable.join(counts, "lang")
        .filter(among_smallest(F.col("draw"), most, F.col("rows")))
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= most)
        .select(row)
    )
    # staged, so its size is known: a few megabytes go to every task, more are shuffled
    rows = marked.join(stage(picked, "picked"), row).groupBy(*row).agg(F.first("text").alias("text")).select("lang", "text")
    blank = letters_table()

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = grams(text, blank)
                if found:
                    sums.setdefault(lang, np.zeros(BUCKETS))[found[0]] += found[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            names=["lang", "counts"],
        )

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = sum(np.frombuffer(c.as_buffer(), np.float64) for b in batches for c in b.column("counts"))
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([whole.tobytes()], pa.binary())], names=["lang", "counts"])

    counted = rows.mapInArrow(count, "lang string, counts binary").groupBy("lang").applyInArrow(add, "lang string, counts binary")
    total: dict[str, np.ndarray] = {}
    for r in stage(counted, "language-counts").toLocalIterator():
        total[r["lang"]] = np.frombuffer(bytes(r["counts"]), np.float64)
        if len(total) * BUCKETS * 8 > MOST_BYTES:
            raise ValueError(f"the model of more than {len(total) - 1} languages is over {MOST_BYTES} bytes")
    return {lang: (total[lang] + 0.1) / (total[lang].sum() + 0.1 * BUCKETS) for lang in sorted(total)}


def identify(docs: DataFrame, model: dict[str, np.ndarray], *columns: str) -> DataFrame:
    """``columns`` of every row of ``docs`` (text) with lang_pred, score and langs.

    ``langs`` maps the languages of the document to their shares; lang_pred is the
    one with the largest share and score that share. A null text, a text without
    a letter, and any text if nothing was learned give ``und`` and 0. Ties go to the
    first name. Only the text is looked at, so repeated rows get equal results.
    Other columns are ignored unless named. An empty table gives an empty result.
    """
    names = list(model)
    held = np.stack(list(model.values())) if names else np.zeros((0, BUCKETS))
    if held.nbytes > MOST_BYTES:
        raise ValueError(f"a model of {held.nbytes} bytes is over {MOST_BYTES}")
    shared = docs.sparkSession.sparkContext.broadcast(held)
    blank = letters_table()

    def run(batches):
        table = shared.value
        for batch in batches:
            best, score, shares = [], [], []
            for text in batch.column("text").to_pylist():
                found = grams(text, blank) if text and names else None
                if found is None:
                    best.append("und")
                    score.append(0.0)
                    shares.append([])
                    continue
                some, share = mixture(table[:, found[0]], found[1])
                top = int(share.argmax())
                best.append(names[some[top]])
                score.append(float(min(1.0, share[top])))
                shares.append([(names[i], float(s)) for i, s in zip(some, share, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in columns),
                    pa.array(best, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(shares, pa.map_(pa.string(), pa.float64())),
                ],
                names=[*columns, "lang_pred", "score", "langs"],
            )

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), "lang_pred string, score double, langs map<string,double>"])
    return docs.select(*dict.fromkeys([*columns, "text"])).mapInArrow(run, schema)


def fold(docs: DataFrame):
    """Remainder by 3 of the CRC-32 of the id as text (null: empty)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3
