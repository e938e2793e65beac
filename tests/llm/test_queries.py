"""The registered queries: names, columns, and SQL where there is one."""

import duckdb
import pytest

import __spark_entry__
from sensorflow.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_": {"doc_id", "held_out", "score", "predicted"},
    "op2_": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"},
    "op3_": {"doc_id", "held_out", "score", "predicted"},
    "op4_": {"doc_id", "held_out", "lang_pred", "score"},
    "op5_": {"doc_id", "score"},
    "op6_": {"query_id", "rank", "vec_id", "score"},
    "op7_": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op8_": {"doc_id", "class_id"},
    "op9_": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op10_": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op11_": {"word", "form", "root", "n", "n_near", "form_n"},
    "op12_": {"doc_id", "n_features", "weight", "score", "rank"},
    "op13_": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
}


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert QUERIES.keys() <= names.keys() and "pipeline" in names
    assert [sum(n.startswith(p) for n in QUERIES) for p in COLUMNS] == [1] * len(COLUMNS)


@pytest.mark.parametrize("name", QUERIES)
def test_query_returns_its_columns_for_every_document(spark, name):
    got = QUERIES[name](spark, SF)
    assert COLUMNS[name.split("_")[0] + "_"] <= set(got.columns)
    if "doc_id" in got.columns:
        ids = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
        assert got.select("doc_id").distinct().count() == ids.distinct().count()


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
