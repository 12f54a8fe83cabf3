import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from core_help import rows
from personalens.operators import quality, snapshots
from personalens.sources import io


def test_unique_not_null_accepted(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "zz")], "k long, v string")
    assert rows(quality.unique_violations(df, "k", "m"), "value", "n_rows") == [("1", 2)]
    nn = quality.not_null_counts(df, ["k", "v", "missing"], "m")
    assert rows(nn, "column_name", "null_rows", "status") == sorted(
        [("k", 1, "fail"), ("v", 1, "fail"), ("missing", None, "missing_column")], key=repr)
    acc = quality.accepted_values_violations(df, "v", ["a", "b"], "m")
    assert rows(acc, "value", "n_rows") == [("zz", 1)]
    contract = quality.column_contract(spark, df, ["k", "w"], "m")
    assert rows(contract, "column_name", "status") == [("v", "undocumented"), ("w", "missing")]


def test_run_results_summary_and_top_k(spark):
    d = tempfile.mkdtemp(prefix="runres-")
    for run, res in [("r1", [("m.a", "success", 1.0), ("m.b", "error", 5.0), ("m.c", "success", 3.0)]),
                     ("r2", [("m.a", "success", 2.0)])]:
        doc = {"metadata": {"invocation_id": run, "generated_at": "t"},
               "results": [{"unique_id": u, "status": s, "execution_time": t, "message": None,
                            "failures": 0} for u, s, t in res]}
        with open(os.path.join(d, f"{run}.json"), "w") as fh:
            json.dump(doc, fh)
    results = quality.read_run_results(spark, d)
    summary = quality.run_summary(results)
    assert rows(summary, "run_id", "total_models", "successful", "failed", "run_status") == [
        ("r1", 3, 2, 1, "1 model(s) failed"), ("r2", 1, 1, 0, "all models succeeded")]
    top = quality.slowest_models(results, 2)
    assert rows(top, "run_id", "unique_id", "slow_rank") == [
        ("r1", "m.b", 1), ("r1", "m.c", 2), ("r2", "m.a", 1)]
    assert rows(quality.failed_models(results), "unique_id") == [("m.b",)]


def test_seed_csv_roundtrip_quotes_crlf_escapes(spark):
    d = tempfile.mkdtemp(prefix="seed-")
    path = os.path.join(d, "seed.csv")
    with open(path, "w", newline="") as fh:
        fh.write("ad_account_id,ad_account_name,product,matched_review_product,"
                 "review_account_name,review_account_id\r\n")
        fh.write('123,Acme,"""Blue \\u00e9 kit""",blue kit,Shop,456\r\n')
        fh.write(',NoAds,"""x""",,Shop,\r\n')
    df = io.read_seed_csv(spark, path)
    assert rows(df) == sorted([
        (123, "Acme", '"Blue \\u00e9 kit"', "blue kit", "Shop", 456),
        (None, "NoAds", '"x"', None, "Shop", None)], key=repr)
    out = os.path.join(d, "out")
    io.write_seed_csv(df, out)
    assert rows(io.read_seed_csv(spark, out)) == rows(df)


def test_scd2_merge(spark):
    start, later = "2024-01-01", "2025-01-01"
    prev = snapshots.first_versions(
        spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string"), "k", ["v"], start)
    snap = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k long, v string")
    out = snapshots.scd2_merge(prev, snap, "k", ["v"], later)
    s, e = dt.date(2024, 1, 1), dt.date(2025, 1, 1)
    assert rows(out) == sorted([
        (1, "a", s, None, True), (2, "b", s, e, False), (2, "B", e, None, True),
        (3, "c", s, e, False), (4, "d", e, None, True)], key=repr)
    again = snapshots.scd2_merge(out, snap, "k", ["v"], "2026-01-01")
    assert again.where(F.col("is_current")).count() == 3
    assert again.count() == out.count()


def test_untargeted_personas_not_in_semantics(spark):
    from personalens.operators.documented import untargeted_review_personas
    rpa = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None)],
                                "review_id long, persona_attribute string")
    ins = spark.createDataFrame([(10, 3.0), (10, 3.5), (11, 1.0)], "ads_meta_id long, roas double")
    apa = spark.createDataFrame([(10, "a"), (11, "b")], "ads_meta_id long, persona_attribute string")
    got = untargeted_review_personas(rpa, apa, ins)
    assert rows(got) == [("b", 2)]                      # NULL persona dropped (NOT IN is NULL)
    apa_null = spark.createDataFrame([(10, "a"), (10, None)],
                                     "ads_meta_id long, persona_attribute string")
    assert untargeted_review_personas(rpa, apa_null, ins).count() == 0   # NULL in subquery
    none = untargeted_review_personas(rpa, apa, ins, min_roas=10.0)     # nothing targeted
    assert rows(none) == sorted([("a", 1), ("b", 2), (None, 1)], key=repr)
