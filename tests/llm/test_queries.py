"""Queries with SQL against it, and columns of the others."""

import os

import duckdb
import pytest
from compare import TABLES, _rows

import __spark_entry__ as registered
from voltscape.llm.queries import QUERIES
from voltscape.llm.sql import ORACLES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

COLUMNS = {
    "op3_quality_knn": ["doc_id", "held_out", "score", "predicted"],
    "op4_simhash": ["doc_id", "fingerprint", "component_id"],
    "op6_decontaminate": ["doc_id", "item_id", "score"],
    "op7_repeats": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op9_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op10_personal_data": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op11_language": ["doc_id", "held_out", "lang_pred", "score"],
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from read_parquet('{FOLDER}/{table}.parquet')")
    frame = QUERIES[name](spark, FOLDER)
    cursor = connection.execute(ORACLES[name])
    assert _rows(frame.columns, frame.collect()) == _rows([c[0] for c in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(name, spark):
    frame = QUERIES[name](spark, FOLDER)
    assert [c for c in frame.columns if c in COLUMNS[name]] == COLUMNS[name]
    if name != "op6_decontaminate":
        assert frame.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_registered():
    assert {*QUERIES, "pipeline"} <= set(registered.queries())
    assert set(ORACLES) <= set(registered.oracle_sql())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
