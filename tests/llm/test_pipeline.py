from __future__ import annotations

import corpus_pipeline
from tests.llm.fixtures import corpus, documents, words
from vayumark.llm import mixing, secrets
from vayumark.llm.common import stage


def test_stages(spark, tmp_path):
    texts = corpus() + [(300 + n, words(300 + n, 70) + f" password=abcdefgh{n}") for n in range(20)]
    texts += [(400 + n, " ".join(w + "!!" for w in words(n, 80).upper().split())) for n in range(60)]
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i < 400), 0) for i, _ in texts if i is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = docs.columns, {}
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, str(tmp_path)), "stage")
        seen[name] = docs
        assert docs.columns == columns or name == "curve packing"
    ids = {name: [r[0] for r in df.select("doc_id").collect()] for name, df in seen.items()}
    assert not [i for i in ids["quality rules"] if i is not None and (i in (40, 41, 42, 43, 44, 61, 62) or i >= 400)]
    assert {0, 5, 30, 31, 300} <= set(ids["quality rules"])
    assert 5 in ids["SimHash near-dedup"] and not {30, 31} & set(ids["SimHash near-dedup"])
    assert sorted(map(str, ids["secret scans"])) == sorted(map(str, ids["SimHash near-dedup"]))
    assert secrets.scan(seen["secret scans"])[0].count() == 0
    mixed = mixing.mix(seen["secret scans"], "doc_id").collect()
    times = {r.row.doc_id: int(r.taken / r.size + 0.5) for r in mixed if r.row.doc_id is not None}
    for i, n in times.items():
        assert i == 20 or ids["source mixing"].count(i) == n
    assert set(ids["curve packing"]) == set(ids["source mixing"])
    assert sum(r.length for r in seen["curve packing"].collect()) > 0
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.columns == seen["curve packing"].columns
    assert whole.selectExpr("sum(length)").first()[0] == seen["curve packing"].selectExpr("sum(length)").first()[0]


def test_empty_tables(spark, tmp_path):
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
