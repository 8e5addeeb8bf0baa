"""Quality rules: fixed base rules and a calibrated logistic regression on hashed n-grams.

The classifier sees hashed words and hashed character trigrams, each part with
length one. It is trained on a bounded sample of labelled rows, the rows with the
smallest hashes of their ids, of which a fifth is held back to calibrate
probabilities. Scores are computed over whole texts in Arrow batches and compared
with a fixed threshold.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vayumark.llm.common import among_smallest, stage

#: Buckets of words, and as many of character trigrams.
BUCKETS = 1 << 15
#: Most labelled rows that the classifier is trained and calibrated on.
TRAIN_ROWS = 4096
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
WORD = re.compile(rb"[^\x20\x09-\x0D]")


def measured(data: bytes) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Base measures of a UTF-8 text, and its word and trigram buckets with repeats."""
    words = data.split()  # at ASCII white space
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    repeated = 0
    if len(ids) >= 4:
        windows = (ids[:-2] * len(seen) + ids[1:-1]) * len(seen) + ids[2:]
        _, kind, count = np.unique(windows, return_inverse=True, return_counts=True)
        again = count[kind] > 1
        covered = np.zeros(len(ids), bool)
        for shift in range(3):
            covered[shift : len(ids) - 2 + shift] |= again
        repeated = int(covered.sum())
    lines: set[bytes] = set()
    doubles = 0
    for line in data.split(b"\n"):
        if line in lines:
            doubles += 1
        elif WORD.search(line):
            lines.add(line)
    raw = np.frombuffer(data, np.uint8)
    starts = (raw & 0xC0) != 0x80  # one byte of each code point
    blank = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    base = [len(words), int(np.count_nonzero(starts & ~blank)), int(np.count_nonzero(SYMBOLS[raw])), doubles, repeated]
    hashed = np.fromiter((xxhash.xxh32_intdigest(w) for w in seen), np.int64, len(seen)) % BUCKETS
    points = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    grams = points[:0]
    if len(points) >= 3:
        grams = points[:-2] * np.uint64(0x9E3779B1) + points[1:-1] * np.uint64(0x85EBCA77) + points[2:] * np.uint64(0xC2B2AE3D)
        grams = (grams ^ (grams >> np.uint64(17))) * np.uint64(0x27D4EB2F165667C5) >> np.uint64(40)
    return base, hashed[ids] if len(ids) else hashed, (grams % np.uint64(BUCKETS)).astype(np.int64)


def features(words: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Both parts one behind the other, each of length one (or zero)."""
    out = np.concatenate([np.bincount(words, minlength=BUCKETS), np.bincount(grams, minlength=BUCKETS)]).astype(np.float64)
    for part in (out[:BUCKETS], out[BUCKETS:]):
        part /= np.linalg.norm(part) or 1
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, rounds: int = 300, rate: float = 0.05, l2: float = 1e-5):
    """Weights and intercept of a logistic regression on sparse rows, by Adam on all rows."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column, value = np.concatenate(rows), np.concatenate(values)
    w, b = np.zeros(2 * BUCKETS), 0.0
    m, v = np.zeros(2 * BUCKETS + 1), np.zeros(2 * BUCKETS + 1)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    for t in range(1, rounds + 1):
        z = np.bincount(at, value * w[column], len(rows)) + b
        error = (sigmoid(z) - y) * weight
        g = np.append(np.bincount(column, value * error[at], 2 * BUCKETS) + l2 * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def platt(score: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset that turn scores into probabilities, by Newton steps with smoothed labels."""
    high, low = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    goal, x = np.where(y == 1, high, low), np.stack([score, np.ones(len(score))])
    at = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = sigmoid(at @ x)
        hessian = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        at = at - np.linalg.solve(hessian, x @ (p - goal))
    return float(at[0]), float(at[1])


@dataclass
class Model:
    weights: np.ndarray
    offset: float
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, words: np.ndarray, grams: np.ndarray) -> float:
        score = float(features(words, grams) @ self.weights) + self.offset
        return float(sigmoid(np.array(self.slope * score + self.shift)))


def labelled_rows(docs: DataFrame, known: DataFrame, most: int) -> DataFrame:
    """doc_id, draw, text and quality of at most ``most`` rows: those with the smallest hashes among the different (doc_id, text) of ``known`` ids."""
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "text", "quality")
    rows = stage(rows.distinct().withColumn("draw", F.xxhash64("doc_id", "text")), "labelled")
    count = rows.count()
    if count > most:
        chosen = rows.filter(among_smallest(F.col("draw"), most, F.lit(count))).select("doc_id", "draw").orderBy("draw", "doc_id").limit(most)
        rows = rows.join(F.broadcast(chosen), ["doc_id", "draw"], "left_semi")
    return rows.select("doc_id", "draw", "text", "quality")


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model | None:
    """Model from at most ``most`` labelled rows; None if the labels lack a class.

    ``labels`` has doc_id and quality (0 or 1). Ids with null or contradicting
    labels are left out; repeated labels count once, and so do rows equal in id and text.
    """
    known = (
        labels.filter("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .filter("low = high")
        .select("doc_id", F.col("low").alias("quality"), F.xxhash64("doc_id").alias("draw"))
    )
    known = (
        known.filter(among_smallest(F.col("draw"), most, F.lit(known.count())))
        .orderBy("draw", "doc_id")
        .limit(most)
        .drop("draw")
    )
    sample = labelled_rows(docs, known, most)

    def sparse(batches):
        for batch in batches:
            columns, values = [], []
            for text in batch.column("text"):
                _, words, grams = measured(text.as_buffer().to_pybytes() if text.is_valid else b"")
                full = features(words, grams)
                columns.append(np.flatnonzero(full).astype(np.int32))
                values.append(full[columns[-1]].astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "draw", "quality")), pa.array(columns, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
                names=["doc_id", "draw", "quality", "columns", "values"],
            )

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "draw"], kind="stable")
        y = frame["quality"].to_numpy(float)
        hold = np.array([xxhash.xxh32_intdigest(str(i)) % 5 == 0 for i in frame["doc_id"]])
        if len(set(y[~hold])) < 2:
            return pd.DataFrame({"weights": [], "offset": [], "slope": [], "shift": []})
        rows, values = list(frame["columns"]), list(frame["values"])
        w, b = fit([r for r, h in zip(rows, hold, strict=True) if not h], [v for v, h in zip(values, hold, strict=True) if not h], y[~hold])
        slope, shift = 1.0, 0.0
        if len(set(y[hold])) == 2:
            score = np.array([v @ w[r] + b for r, v, h in zip(rows, values, hold, strict=True) if h])
            slope, shift = platt(score, y[hold])
        return pd.DataFrame({"weights": [w.tobytes()], "offset": [b], "slope": [slope], "shift": [shift]})

    kinds = dict(sample.dtypes)
    learned = (
        sample.mapInArrow(sparse, f"doc_id {kinds['doc_id']}, draw long, quality {kinds['quality']}, columns array<int>, values array<float>")
        .withColumn("all", F.lit(1))
        .groupBy("all")
        .applyInPandas(learn, "weights binary, offset double, slope double, shift double")
        .collect()
    )
    if not learned:
        return None
    r = learned[0]
    return Model(np.frombuffer(bytes(r["weights"]), np.float64), r["offset"], r["slope"], r["shift"])


def judge(docs: DataFrame, model: Model | None, *columns: str, threshold: float = 0.5, least_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """``columns`` of every row of ``docs`` (text) with its measures, base_failed, probability and kept.

    Measures: n_words, word_chars (code points in words), n_symbols, n_dup_lines
    (lines with a word that equal an earlier line), n_repeat_words (words in 3-word
    windows found at least twice in the text). base_failed: fewer than
    ``least_words`` words, or more than ``most_repeated`` percent repeated. kept:
    not base_failed and a probability of at least ``threshold``; without a model
    the base rules decide and the probability is null.

    A null text has no words. Rows are judged one by one, so repeated rows get
    equal results. Other columns are ignored unless named. An empty table gives an
    empty result.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        for batch in batches:
            base, chance = [], []
            for text in batch.column("text"):
                numbers, words, grams = measured(text.as_buffer().to_pybytes() if text.is_valid else b"")
                base.append(numbers)
                chance.append(model.probability(words, grams) if model else None)
            numbers = np.array(base, np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), *(pa.array(numbers[:, i]) for i in range(len(names))), pa.array(chance, pa.float64())],
                names=[*columns, *names, "probability"],
            )

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), *(f"{n} long" for n in names), "probability double"])
    judged = docs.select(*dict.fromkeys([*columns, "text"])).mapInArrow(run, schema)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    good = F.coalesce(F.col("probability") >= threshold, F.lit(True))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & good)
