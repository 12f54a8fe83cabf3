"""The driver contract and the SQL checks on the smallest tables."""


import duckdb
import pytest

import __spark_entry__ as entry_mod
from core_help import SF_SMALL
from personalens.plans.registry import all_queries

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def test_entry_and_registry(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q) and set(all_queries()) <= set(o)
    assert len(q) >= 50


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


names = list(all_queries())


@pytest.mark.parametrize("name", names)
def test_spark_matches_sql(spark, duck, name):
    q = all_queries()[name]
    s = sorted(tuple(_norm(v) for v in r) for r in q.run(spark, SF_SMALL).collect())
    d = sorted(tuple(_norm(v) for v in r) for r in duck.execute(q.sql()).fetchall())
    assert s == d
