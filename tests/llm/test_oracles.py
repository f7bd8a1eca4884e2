"""The training-data queries that SQL can express, against DuckDB on the sf0.001 tables; the others give rows."""
import duckdb
import pytest

from eventide.llm.oracle import ORACLE
from eventide.llm.queries import REGISTRY
from eventide.sources.tables import TABLE_NAMES
from tools.oracle_check import norm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in REGISTRY} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}
    assert set(ORACLE) <= set(REGISTRY)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, duck, name):
    df = REGISTRY[name](spark, SF)
    rows = df.collect()
    if name not in ORACLE:
        assert rows and not any(t == "void" for _, t in df.dtypes)
        return
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    order = sorted(dcols)
    assert sorted(df.columns) == order
    s = sorted((tuple(norm(r[df.columns.index(c)]) for c in order) for r in rows), key=repr)
    d = sorted((tuple(norm(r[dcols.index(c)]) for c in order) for r in res.fetchall()), key=repr)
    assert s == d
