"""Every registered query against its SQL over the same files, at two sizes."""

from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_points
from checks.queries import QUERIES
from checks.sql import SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value.normalize()))
    return (type(value).__name__, repr(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name, scale):
    sf_dir = f"/root/testdata/{scale}"
    df = QUERIES[name](spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = _connect(sf_dir).execute(SQL[name])
    want = _rows([c[0] for c in result.description], result.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["id", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    assert df.count() > 0
