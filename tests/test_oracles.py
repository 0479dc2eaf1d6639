"""Every registered query with a SQL twin equals DuckDB on the same files."""

import math
from collections import Counter

import duckdb
import pytest

from faultline.plans import ORACLES, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return str(v)

    return Counter(tuple(text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    got = _bag([tuple(r) for r in df.collect()], df.columns)
    cur = duck.execute(ORACLES[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == _bag(cur.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
