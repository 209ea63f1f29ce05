"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from dialogprep.plans.oracle import ORACLES
from dialogprep.plans.queries import QUERIES

TABLES = ("conversations", "documents", "events", "labels", "benchmark")


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([r[i] for i in order]) for r in data)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLES.items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).count() == 14


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, small, name):
    df = entry.queries()[name](spark, small)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    answer = duck.execute(entry.oracle_sql()[name])
    assert got == rows([d[0] for d in answer.description], answer.fetchall())
