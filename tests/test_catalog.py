"""Every query with an SQL twin gives the same rows in DuckDB on the small tables."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def ordered(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in at], sorted([tuple(r[i] for i in at) for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cur = duck.execute(entry.oracle_sql()[name])
    assert ordered(df.columns, [tuple(r) for r in df.collect()]) == ordered([d[0] for d in cur.description], cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_twins_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
