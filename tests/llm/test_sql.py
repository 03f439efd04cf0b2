"""The queries that SQL can express, against their SQL on the same tables."""

import os

import duckdb
import pytest

from tidemark.llm import queries


@pytest.mark.parametrize("name", ["op2_jaccard_join", "op4_warc_archives", "op7_source_mixing", "op8_near_vectors", "op12_conversation_trie"])
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    df = queries.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    rel = con.sql(queries.oracle_sql()[name])
    assert sorted(rel.columns) == columns
    want = sorted((tuple(r[rel.columns.index(c)] for c in columns) for r in rel.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == want
    assert want


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_names_and_rows(spark, sf_dir, name):
    assert name.startswith("op")
    df = queries.queries()[name](spark, sf_dir)
    key = next(c for c in ("doc_id", "page_id", "vec_id", "conv_id") if c in df.columns)
    if key == "conv_id":  # smallest members of nodes, not all conversations
        assert df.filter("depth = 0").count() == 1
        return
    source = {"doc_id": "documents", "page_id": "pages", "vec_id": "embeddings"}[key]
    assert df.select(key).distinct().count() == spark.read.parquet(f"{sf_dir}/{source}.parquet").count()
