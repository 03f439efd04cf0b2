"""Each catalogue query against its SQL on the same tables."""

import os

import duckdb
import pytest

from tidemark.plans import catalogue, columns, files, streams  # noqa: F401


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = catalogue.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    rel = duck.sql(catalogue.SQL[name])
    assert sorted(rel.columns) == columns
    want = sorted((tuple(r[rel.columns.index(c)] for c in columns) for r in rel.fetchall()), key=str)
    assert got == want


def test_entry_needs_no_llm(spark):
    import __spark_entry__ as entry

    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert entry.entry(spark).columns == ["user_id", "synoptic", "event_id", "scaled"]
