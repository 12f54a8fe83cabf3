"""Fast forms equal the direct forms they replace."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from core_help import SF_SMALL, rows
from personalens.operators import mapping, ranking, reports, scorecard
from personalens.plans.warehouse import Warehouse

TS = dt.datetime(2025, 1, 1)


def _norm(df):
    out = []
    for r in df.collect():
        out.append(tuple(round(float(v), 6) if isinstance(v, (float, Decimal)) else v for v in r))
    return sorted(out, key=repr)


def test_mapping_fast_equals_windows_on_driver_tables(spark):
    wh = Warehouse.from_driver_tables(spark, SF_SMALL)
    fast = mapping.cross_account_persona_mapping(wh.ad_persona_attributes,
                                                 wh.review_persona_attributes, wh.seed)
    plain = mapping.cross_account_persona_mapping_windows(wh.ad_persona_attributes,
                                                          wh.review_persona_attributes, wh.seed)
    assert _norm(fast) == _norm(plain)


def test_mapping_fast_equals_windows_random(spark):
    rnd = random.Random(7)
    personas = ["a", "b", "c", "d"]
    apa = spark.createDataFrame(
        [(rnd.choice([1, 2, 3, None]), rnd.choice(personas),
          Decimal(rnd.choice(["0.5", "0.9"])) if rnd.random() > 0.2 else None,
          rnd.choice([10, 11, None]), TS) for _ in range(60)],
        "ad_account_id long, persona_attribute string, confidence_score decimal(18,6), "
        "ads_meta_id long, loaded_at timestamp")
    rpa = spark.createDataFrame(
        [(i, rnd.choice([7, 8, 9]), rnd.choice(personas), Decimal("0.8"),
          dt.date(2024, 1, 1 + rnd.randrange(20))) for i in range(80)],
        "review_id long, ad_account_id long, persona_attribute string, "
        "confidence_score decimal(18,6), review_date date")
    seed = spark.createDataFrame(
        [(rnd.choice([1, 2, 3, None]), f"n{i}", f"p{i}", "m", f"r{i % 3}",
          rnd.choice([7, 8, 9, None])) for i in range(12)],
        "ad_account_id long, ad_account_name string, product string, "
        "matched_review_product string, review_account_name string, review_account_id long")
    fast = mapping.cross_account_persona_mapping(apa, rpa, seed)
    plain = mapping.cross_account_persona_mapping_windows(apa, rpa, seed)
    assert _norm(fast) == _norm(plain)
    assert fast.count() > 0


def test_scorecard_metrics_fast_equals_direct(spark):
    wh = Warehouse.from_driver_tables(spark, SF_SMALL)
    fast = scorecard.persona_performance_metrics(wh.ad_persona_attributes, wh.insights)
    direct = scorecard.persona_performance_metrics_direct(wh.ad_persona_attributes, wh.insights)
    assert _norm(fast.select(*direct.columns)) == _norm(direct)


def test_ad_performance_matches_product(spark):
    wh = Warehouse.from_driver_tables(spark, SF_SMALL)
    apr, am, ins = wh.ad_personas_from_review_analysis, wh.ads_meta, wh.insights
    fast = reports.persona_ad_performance(apr, am, ins)
    prod = (apr.join(am.select("ad_id", "ads_meta_id"), "ad_id").join(ins, "ads_meta_id")
            .groupBy("persona_attribute").agg(
                F.countDistinct("ads_meta_id").alias("ad_count"),
                F.sum("amount_spent").alias("total_ad_spend"),
                F.count(F.lit(1)).alias("persona_mentions"),
                F.avg("confidence_score").alias("avg_confidence")))
    assert _norm(fast.select(*prod.columns)) == _norm(prod)


def test_global_row_number_equals_window(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(i, rnd.randrange(30), rnd.random()) for i in range(1000)],
                               "id long, k long, v double").repartition(8)
    order = [F.col("k").desc_nulls_first(), F.col("v").asc_nulls_last(), F.col("id").asc()]
    got = ranking.global_row_number(df, order, "rn", num_partitions=8)
    want = df.withColumn("rn", F.row_number().over(Window.orderBy(*order)))
    assert rows(got, "id", "rn") == rows(want, "id", "rn")


def test_coverage_partition_is_complete(spark):
    wh = Warehouse.from_driver_tables(spark, SF_SMALL)
    u = wh.unified_persona_attributes
    keys = u.select("ad_account_id", "persona_attribute", "coverage_type").distinct()
    counts = {r["coverage_type"]: r["count"] for r in keys.groupBy("coverage_type").count().collect()}
    assert set(counts) <= {"both", "review_only", "ad_only"}
    assert sum(counts.values()) == keys.select("ad_account_id", "persona_attribute").distinct().count()


def test_review_shares_sum_to_100(spark):
    wh = Warehouse.from_driver_tables(spark, SF_SMALL)
    r = wh.review_ranking.groupBy("ad_account_id").agg(F.sum("percentage").alias("s"))
    assert all(abs(x.s - 100.0) < 1e-6 for x in r.collect())


def test_unaddressed_branch_is_empty(spark):
    """Q-10: after the inner join ad_count is never 0."""
    wh = Warehouse.from_driver_tables(spark, SF_SMALL)
    sc = wh.scorecard
    assert sc.where(F.col("gap_analysis_category") == "unaddressed_persona").count() == 0
    assert sc.where(F.col("ad_count") == 0).count() == 0


def test_repeat_rows_chunks(spark):
    from personalens.operators.expand import repeat_rows
    df = spark.createDataFrame([("a", 1), ("b", 7), ("c", 0)], "k string, n long")
    out = repeat_rows(df, "n", chunk=3)
    assert sorted(r.k for r in out.collect()) == ["a"] + ["b"] * 7
