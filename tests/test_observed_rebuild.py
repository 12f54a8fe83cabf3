"""dq_observed builds and tests every model of a rebuild."""

from functools import reduce

import pytest

from core_help import rows
from personalens.operators import quality
from personalens.plans import extra_queries
from personalens.plans.warehouse import Warehouse
from personalens.sources.tpch_binding import DRIVER_SCHEMAS

N = 60

#: Rows of the driver's tables, by a number from 0.
TABLES = {
    "region": lambda i: (i % 5, f"R{i % 5}"),
    "nation": lambda i: (i % 25, f"N{i % 25}", i % 5),
    "customer": lambda i: (i, f"c{i}", i % 25, 1.5, "BUILDING"),
    "supplier": lambda i: (i, f"Supplier{i}", i % 25, 2.5),
    "part": lambda i: (i, f"{('small', 'large')[i % 2]} {('ring', 'gear', 'bolt')[i % 3]}", f"Brand{i % 4}", "STEEL", i % 9, 900.0),
    "orders": lambda i: (i, i, "O", 10.0, f"1998-02-{1 + i % 28:02d}", "5-LOW"),
    "lineitem": lambda i: (i, i, i, 1 + i % 7, 17.0, 840.5, 0.01 * (i % 9), 0.02, "N", "O", "1996-09-13"),
    "events": lambda i: (i, "2024-01-01", i, "view", 3.5, None),
}


@pytest.fixture
def own_tables(spark, tmp_path):
    for name, row in TABLES.items():
        n = {"region": 5, "nation": 25}.get(name, N)
        types = DRIVER_SCHEMAS[name]
        df = spark.createDataFrame([row(i) for i in range(n)], types.replace("timestamp_ntz", "string"))
        times = [c.split()[0] for c in types.split(",") if "timestamp_ntz" in c]
        df = reduce(lambda d, c: d.withColumn(c, d[c].cast("timestamp_ntz")), times, df)
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_every_model_of_the_layer_is_built_and_tested(spark, own_tables, monkeypatch):
    write, counts = quality.write_observed, {}

    def noted(df, model, path):
        figures = write(df, model, path)
        counts[model] = figures["rows"]
        return figures

    monkeypatch.setattr(quality, "write_observed", noted)
    got = rows(extra_queries.dq_observed(spark, own_tables))
    assert tuple(counts) == Warehouse.BUILD_ORDER
    assert all(counts.values()), counts

    layer = [m for m, _ in quality.NOT_NULL_TESTS if not m.startswith("stg_")]
    want = [(m, c, "not_null", n, s) for m, c, n, s in rows(extra_queries.dq_not_null(spark, own_tables)) if m in layer]
    want += [(m, c, "accepted_values", bad, s) for m, c, _, bad, s in rows(extra_queries.dq_accepted_values(spark, own_tables))]
    assert got == sorted(want, key=repr)
    assert {"cross_account_mapping", "scorecard", "gap_analysis", "ad_performance", "opportunity_index"} <= {r[0] for r in got}
