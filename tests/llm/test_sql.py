"""Queries with SQL against DuckDB, on driver tables and on edge rows."""

import os

import duckdb
import pytest

from llm_help import MEDIUM, SMALL
from personalens.llm.registry import QUERIES, SQL


def norm(v):
    return repr(round(v, 5) + 0.0) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", list(SQL))
@pytest.mark.parametrize("where", ["small", "edge"])
def test_matches_sql(spark, edge_dir, name, where):
    top = SMALL if where == "small" else edge_dir
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        path = f"{top}/{table}.parquet"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    df = QUERIES[name](spark, top)
    result = con.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert set(names) == set(df.columns)
    want = sorted(tuple(norm(r[names.index(c)]) for c in df.columns) for r in result.fetchall())
    assert sorted(tuple(norm(v) for v in r) for r in df.collect()) == want


def test_mixing_reaches_target_shares(spark):
    from personalens.llm import mixing
    from llm_help import documents
    docs = documents(spark, MEDIUM)
    rates = mixing.mixing_rates(docs, weights={"src1": 3.0, "src2": 1.0}, epochs=0.5)
    out = mixing.poisson_mix(docs, rates)
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert set(n) == {"src1", "src2"}
    rate = {r.mix_source: r.mix_rate for r in rates.collect()}
    before = {r["source"]: r["count"] for r in docs.groupBy("source").count().collect()}
    for s in n:  # a Poisson sum: within five standard deviations
        mean = before[s] * rate[s]
        assert abs(n[s] - mean) < 5 * mean ** 0.5
    again = mixing.poisson_mix(docs, rates).collect()
    assert sorted(again, key=repr) == sorted(out.collect(), key=repr)
