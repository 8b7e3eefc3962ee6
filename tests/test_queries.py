"""Every query against the same result in SQL, over all rows of the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import DATA
from workload.oracles import ORACLES
from workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return ""
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    assert len(contract.entry(spark).collect()) == 7


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sql, name):
    df = contract.queries()[name](spark, DATA)
    got = _rows(df.columns, df.collect())
    done = sql.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in done.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == _rows(columns, done.fetchall())
