from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import corpus, documents, words
from vayumark.llm import exact_dedup as op


def expected(texts):
    """(doc_id, keep_id, size, kept, digest) by looking at every group as a whole."""
    groups = defaultdict(list)
    for i, t in texts:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for bare, rows in groups.items():
        rows.sort()
        for n, row in enumerate(rows):
            out.append((row[3], rows[0][3], len(rows), n == 0, hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    rows = df.select("row.doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("sha")).collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("most_slots", [op.MOST_SLOTS, op.SEGMENT])
def test_groups_are_those_of_whole_texts(spark, most_slots):
    """Also with a filter that is far too small, which suspects nearly everything."""
    texts = corpus() + [(100 + n, f"  {words(n % 12, 120)}\n") for n in range(40)]
    texts += [(200, " x\ty\x0b\x0cz\r"), (201, "xyz"), (202, "x yz"), (203, "xyz"), (203, "xyz"), (None, "x y z"), (None, None)]
    texts += [(1000 + n, words(1000 + n, 6)) for n in range(3000)]
    assert found(op.classes(documents(spark, texts), "doc_id", most_slots=most_slots)) == expected(texts)


def test_a_text_without_a_copy_seldom_passes_the_filter_and_copies_always_do(spark):
    keys = spark.range(20_000).select(F.unhex(F.sha2((F.col("id") % 19_000).cast("string"), 256)).alias("digest"))
    slots = op.SLOTS * 20_000
    tested = op.suspected(keys, op.bloom(keys, slots), slots)
    n = tested.groupBy("digest").agg(F.count("*").alias("n"), F.max("suspect").alias("s"), F.min("suspect").alias("t"))
    assert n.filter("n > 1 AND NOT t").isEmpty()
    assert n.filter("n = 1 AND s").count() < 0.03 * 18_000


def test_a_group_of_a_third_of_all_rows_is_spread(spark):
    texts = [(n, "same text" if n % 3 == 0 else words(n, 5)) for n in range(1500)]
    got = op.classes(documents(spark, texts), "doc_id")
    assert found(got) == expected(texts)
    salts = spark.range(500).select(F.pmod(F.col("id"), F.lit(op.SALTS)).alias("s")).distinct().count()
    assert salts == op.SALTS


def test_kept_rows_keep_their_columns(spark):
    docs = documents(spark, corpus()).withColumns({"digest": F.lit("d"), "rank": F.lit(1), "suspect": F.lit("s"), "salt": F.lit(2)})
    kept = op.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r[3] for r in expected(corpus()))
    assert op.keep_one(docs.filter("false")).count() == 0
    assert found(op.classes(docs.filter("false"), "doc_id")) == []
