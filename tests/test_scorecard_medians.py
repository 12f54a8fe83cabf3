"""Medians of the scorecard, and what it reads from files."""

from collections import Counter

import pytest
from personalens.operators import scorecard
from personalens.plans.registry import all_queries
from pyspark.sql import functions as F


def _inputs(spark):
    apa = spark.createDataFrame(
        [(a, p, v, ad, c) for a in (1, None) for p, v in (("x", "u"), ("y", None)) for ad in (1, 2, 2, 3, None) for c in ("k", None)],
        "ad_account_id long, persona_attribute string, persona_value string, ads_meta_id long, core_persona string").selectExpr(
        "*", "cast(0.5 as decimal(38,12)) as confidence_score", "timestamp'2025-01-01' as loaded_at")
    rows = [(ad, (i * 7) % 11 - 4.0 if i % 5 else None, (i % 3) / 8 if i % 4 else None, -i / 2) for ad in (1, 2, 3, 3, None) for i in range(23)]
    ins = spark.createDataFrame(rows, "ads_meta_id long, roas double, ctr double, cpc double")
    ins = ins.select("ads_meta_id", *[F.col(c).cast("decimal(18,6)").alias(c) for c in ("roas", "ctr", "cpc")])
    others = ["thumbstop", "retention", "frequency", "amount_spent", "impressions", "reach", "click"]
    return apa, ins.select("*", *[F.lit(2).cast("decimal(18,6)").alias(c) for c in others])


def test_medians_shuffle_no_value_before_it_is_weighed(spark):
    apa, ins = _inputs(spark)
    fast = scorecard.persona_performance_metrics(apa, ins)
    plan = fast._jdf.queryExecution().sparkPlan().toString()
    # Insights meet the groups as they are: none is counted per ad and value.
    assert not [line for line in plan.splitlines() if "HashAggregate(keys=[ads_meta_id" in line and "metric" in line.split("functions=")[0]]
    medians = ["ad_account_id", "persona_attribute", "persona_value", "median_roas", "median_ctr", "median_cpc", "ad_count"]
    direct = scorecard.persona_performance_metrics_direct(apa, ins)
    got = Counter(fast.select(*medians).collect())
    assert len(got) == 4 and got == Counter(direct.select(*medians).collect())


@pytest.mark.parametrize("name", ["scorecard_tiers", "scorecard"])
def test_scorecard_reads_the_ad_personas_from_files(spark, name):
    plan = all_queries()[name].build(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "variant" not in plan
