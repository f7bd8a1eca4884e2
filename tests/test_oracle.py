"""Every registered query against its DuckDB oracle on the sf0.001 tables."""
import duckdb
import pytest

import __spark_entry__ as E
from eventide.plans.queries import REGISTRY
from eventide.sources.tables import TABLE_NAMES
from tools.oracle_check import norm

from conftest import SF_SMALL

QUERIES = dict(REGISTRY)
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "customer_name" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    if name not in ORACLE:
        assert rows and all(len(r) == len(df.columns) for r in rows)
        return
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(dcols)
    si = [df.columns.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    s = sorted((tuple(norm(r[i]) for i in si) for r in rows), key=repr)
    d = sorted((tuple(norm(r[i]) for i in di) for r in res.fetchall()), key=repr)
    assert s == d
