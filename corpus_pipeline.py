"""A corpus in five stages: quality rules, near-duplicates, secrets, mixture, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
keep the columns of ``docs``. ``run`` writes what a stage returns to the shared folder
and hands the next stage what was written.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vayumark.llm import mixing, packing, quality, secrets, simhash
from vayumark.llm.common import prepare, stage, table

#: Words of a shingle and least Jaccard similarity of a near-duplicate.
SHINGLE_WORDS, SIMILARITY = 5, 0.8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep; the classifier is trained on the labelled rows among ``docs``."""
    prepare(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    names = {c: f"doc:{c}" for c in docs.columns if c != "text"}
    renamed = docs.select("text", *(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    kept = quality.judge(renamed, model, "text", *names.values()).filter("kept")
    return kept.select(*(F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near-duplicates."""
    prepare(spark)
    return simhash.keep_one(docs, SHINGLE_WORDS, SIMILARITY)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets replaced by a mark."""
    prepare(spark)
    return secrets.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them: parts of a row are rounded to whole rows."""
    prepare(spark)
    mixed = mixing.mix(docs, *(F.col(f"`{c}`") for c in docs.columns))
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    return mixed.withColumn("times", times).filter("times > 0").select(
        "row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")
    ).select("row.*")


def curve_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secret_scans),
    ("source mixing", source_mixing),
    ("curve packing", curve_packing),
]
#: Classifier, fingerprints, digests of shingles and tokens have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
