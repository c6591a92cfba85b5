"""The contract queries that SQL can express against their DuckDB twins, and the others' columns."""

from __future__ import annotations

import os

import duckdb
import pytest

from phenospark.llm.oracle import ORACLE_SQL
from phenospark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2_html": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op3_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op4_lm": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint",
               "base_score": "double", "score": "double"},
    "op6_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op7_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op11_quality": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
                     "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean", "score": "double"},
}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{file}')")
    df = QUERIES[name](spark, SF)
    expected = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(df.columns)
    order = lambda rows: sorted(tuple(map(str, r)) for r in rows)
    assert order(df.select(*columns).collect()) == order(expected.fetchall())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_has_a_row_for_every_input_row(spark, name):
    df = QUERIES[name](spark, SF)
    assert dict(df.dtypes) == COLUMNS[name]
    table = "pages" if name == "op2_html" else "documents"
    assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
