from __future__ import annotations

import re
from collections import Counter

import pytest

from tests.llm.fixtures import corpus, documents, words
from vayumark.llm import quality as op


def slow(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    inside = {i + s for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for s in range(3)}
    lines = text.split("\n")
    doubles = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:n] for n, x in enumerate(lines))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), doubles, len(inside))


def test_measures(spark):
    texts = corpus()
    got = op.judge(documents(spark, texts), None, "doc_id", "key").collect()
    assert [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got] == [slow(t) for _, t in texts]
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed) and r.probability is None and r.key == "k"


@pytest.fixture(scope="module")
def labelled(spark):
    texts = [(n, words(n, 80)) for n in range(300)] + [(1000 + n, " ".join(w + "!!" for w in words(n, 80).upper().split())) for n in range(300)]
    docs = documents(spark, texts)
    labels = [(i, int(i < 1000), 0) for i, _ in texts if i % 3] + [(1, 1, 0), (2, 0, 0), (5, None, 0), (None, 1, 0), (9999, 1, 0)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    model = op.train(docs, labels)
    right = [r.kept == (r.doc_id < 1000) for r in op.judge(docs, model, "doc_id").collect() if r.doc_id % 3 == 0]
    assert len(right) == 200 and sum(right) >= 196


def test_training_is_bounded_and_repeatable(labelled):
    docs, labels = labelled
    a, b = op.train(docs, labels, most=120), op.train(docs, labels.union(labels), most=120)
    assert (a.weights == b.weights).all() and (a.slope, a.shift) == (b.slope, b.shift)


def test_repeated_rows_train_once(spark, labelled):
    docs, labels = labelled
    copies = docs.filter("doc_id = 4").crossJoin(spark.range(300)).drop("id")
    a, b = op.train(docs, labels), op.train(docs.union(copies), labels)
    assert (a.weights == b.weights).all() and (a.slope, a.shift) == (b.slope, b.shift)
    texts = spark.createDataFrame([(4, words(5000 + n, 60)) for n in range(300)], "doc_id long, text string")
    known = spark.createDataFrame([(4, 1), (7, 1)], "doc_id long, quality int")
    assert op.labelled_rows(texts, known, 120).count() == 120
    assert op.labelled_rows(texts.union(texts), known, 500).count() == 300


def test_no_labels_no_model(spark, labelled):
    docs, labels = labelled
    assert op.train(docs, labels.limit(0)) is None
    assert op.train(docs, labels.filter("quality = 1")) is None
    assert op.judge(docs.limit(0), None, "doc_id").count() == 0
