"""The registered queries over whole tables, against SQL where there is one."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.compare import connect, spark_result, sql_result
from vayumark.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id:bigint n_bytes:bigint n_removed:bigint n_spans:bigint kept_sha256:string",
    "op2": "vec_id:bigint n_links:bigint component_id:bigint kept:boolean",
    "op3": "doc_id:bigint n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint n_repeat_words:bigint base_failed:boolean kept:boolean",
    "op4": "conv_id:bigint n_turns:bigint turns_sha256:string loss_chars:bigint loss_sha256:string formatted_chars:bigint",
    "op5": "doc_id:bigint fingerprint:string component_id:bigint",
    "op6": "doc_id:bigint start:bigint length:bigint ids_crc32:bigint doc_tokens:bigint sequence_id:bigint offset:bigint",
    "op7": "doc_id:bigint n_assign:bigint n_access:bigint n_hex:bigint base_sha256:string spans:string",
    "op8": "doc_id:bigint size:bigint source_size:bigint target:double taken:bigint",
    "op9": "page_id:bigint url:string text:string n_chars:bigint",
    "op10": "doc_id:bigint held_out:boolean lang_pred:string score:double",
    "op11": "conv_id:bigint depth:bigint parent_conv_id:bigint n_convs:bigint n_children:bigint n_leaves:bigint saved_tokens:bigint ends_sha256:string",
    "op12": "anchor_id:bigint positive_id:bigint rank:int negative_id:bigint positive_score:bigint negative_score:bigint",
    "op13": "doc_id:bigint keep_id:bigint group_size:bigint kept:boolean text_sha256:string",
}
ROWS = {"op2": "embeddings", "op4": "conversations", "op9": "pages", "op11": "conversations", "op12": "embeddings"}


def test_all_are_registered():
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()
    assert {n.split("_")[0] for n in QUERIES} == set(COLUMNS)
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_whole_tables(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    op = name.split("_")[0]
    kinds = dict(df.dtypes)
    for column in COLUMNS[op].split():
        column, kind = column.split(":")
        assert kinds[column] == kind
    rows = spark.read.parquet(f"{SF_DIR}/{ROWS.get(op, 'documents')}.parquet")
    if name in ORACLES:
        assert spark_result(df) == sql_result(connect(SF_DIR), ORACLES[name])
    elif op == "op6":
        assert df.select("doc_id").distinct().count() == rows.count()
    else:
        assert df.count() == rows.count()
