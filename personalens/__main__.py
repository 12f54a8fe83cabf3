"""Command line: the reference's run / test / seed workflow as Spark jobs.

    python -m personalens build  --raw-dir DIR | --tpch-dir DIR  --target DIR [--version NAME]
    python -m personalens test   --raw-dir DIR | --tpch-dir DIR  [--target DIR]
    python -m personalens seed   --csv FILE --target DIR
    python -m personalens report NAME --raw-dir DIR | --tpch-dir DIR [--limit N]

``--raw-dir`` holds one parquet folder per raw table (``cad_ads``,
``review_reviews``, ..., ``seed_mapping``); ``--tpch-dir`` projects them from
TPC-H-style tables instead. The Spark master and every other setting come
from ``spark-submit`` / the environment; ``spark.checkpoint.dir`` must name a
shared folder on a cluster.
"""

from __future__ import annotations

import argparse
from functools import reduce

from pyspark.sql import DataFrame

from personalens.operators import quality
from personalens.plans.warehouse import Warehouse
from personalens.session import get_session
from personalens.sources import io
from personalens.sources.tpch_binding import BINDINGS, LazyTables, raw_schema


def _warehouse(spark, args, reuse=()) -> Warehouse:
    if args.tpch_dir:
        return Warehouse.from_driver_tables(spark, args.tpch_dir, materialize=reuse)
    root = args.raw_dir.rstrip("/")
    raw = LazyTables(lambda name: io.read_table(spark, f"{root}/{name}", raw_schema(spark, name)), list(BINDINGS))
    return Warehouse(raw, materialize=reuse)


def _model(wh: Warehouse, name: str) -> DataFrame:
    return wh.stg[name] if name.startswith("stg_") else getattr(wh, name)


def _tests(wh: Warehouse) -> DataFrame:
    by_model: dict[str, list[str]] = {}
    for m, c in quality.NOT_NULL_TESTS:
        by_model.setdefault(m, []).append(c)
    parts = [quality.not_null_counts(_model(wh, m), cols, m)
             .selectExpr("model", "column_name", "'not_null' as test",
                         "coalesce(null_rows, -1) as failing_rows", "status")
             for m, cols in by_model.items()]
    for m, c in quality.UNIQUE_TESTS:
        parts.append(quality.unique_violations(_model(wh, m), c, m).groupBy("model", "column_name")
                     .count().selectExpr("model", "column_name", "'unique' as test",
                                         "count as failing_rows", "'fail' as status"))
    for m, c, values in quality.ACCEPTED_VALUES_TESTS:
        parts.append(quality.accepted_values_violations(_model(wh, m), c, values, m)
                     .groupBy("model", "column_name").sum("n_rows")
                     .selectExpr("model", "column_name", "'accepted_values' as test",
                                 "`sum(n_rows)` as failing_rows", "'fail' as status"))
    return reduce(DataFrame.unionByName, parts)


def main(argv=None):
    p = argparse.ArgumentParser(prog="personalens")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("build", "test", "report"):
        s = sub.add_parser(name)
        g = s.add_mutually_exclusive_group(required=True)
        g.add_argument("--raw-dir")
        g.add_argument("--tpch-dir")
        if name == "build":
            s.add_argument("--target", required=True)
            s.add_argument("--version", help="name of the version to build or to take up")
        if name == "test":
            s.add_argument("--target")
        if name == "report":
            s.add_argument("name")
            s.add_argument("--limit", type=int, default=20)
    s = sub.add_parser("seed")
    s.add_argument("--csv", required=True)
    s.add_argument("--target", required=True)
    args = p.parse_args(argv)
    spark = get_session()

    if args.cmd == "seed":
        io.write_table(io.read_seed_csv(spark, args.csv), args.target)
    elif args.cmd == "build":
        wh = _warehouse(spark, args)
        report = wh.build_all(args.target, version=args.version)
        for name, path in report.paths.items():
            print(f"{name}\t{path}" + ("\tfrom an earlier attempt" if name in report.reused else ""))
        for model, column, n, *_, status in report.not_null() + report.accepted_values():
            if status != "pass":
                print(f"{model}.{column}\t{status}\t{n}")
    elif args.cmd == "test":
        results = _tests(_warehouse(spark, args, ("review_persona_attributes",
                                                  "ad_persona_attributes")))
        if args.target:
            io.write_table(results, args.target)
        failing = results.where("status <> 'pass'").cache()
        failing.show(failing.count(), truncate=False)  # a row for each test of the fixed lists
    elif args.cmd == "report":
        _model(_warehouse(spark, args), args.name).show(args.limit, truncate=False)


if __name__ == "__main__":
    main()
