"""Valid inputs that the driver's tables do not hold."""

import random

import pytest
from pyspark.sql import functions as F

from personalens.functions import json as J
from personalens.functions.numeric import guarded_number, loose_number
from personalens.operators import gaps, reports, scorecard
from personalens.operators.expand import repeat_rows


def _metric_inputs(spark, values):
    r = random.Random(3)
    personas = [(r.choice([1, 2, None]), r.choice("pq"), r.choice(["v", None]), 0.5, r.randrange(12), "c", None) for _ in range(120)]
    apa = spark.createDataFrame(personas, "ad_account_id long, persona_attribute string, persona_value string, confidence_score double, "
                                          "ads_meta_id long, core_persona string, loaded_at timestamp")
    rows = [(r.randrange(12), *(r.choice([None, values(r)]) for _ in range(3)), *[1.0] * 7) for _ in range(400)]
    ins = spark.createDataFrame(rows, "ads_meta_id long, roas double, ctr double, cpc double, amount_spent double, impressions double, "
                                      "reach double, click double, thumbstop double, retention double, frequency double")
    return apa, ins


@pytest.mark.parametrize("values", [lambda r: r.random() * 5, lambda r: float(r.randrange(3))], ids=["continuous", "few"])
def test_medians_with_null_groups_equal_the_product(spark, values):
    apa, ins = _metric_inputs(spark, values)
    fast = scorecard.persona_performance_metrics(apa, ins)
    direct = scorecard.persona_performance_metrics_direct(apa, ins)
    key = lambda r: tuple(str(r[c]) for c in ("ad_account_id", "persona_attribute", "persona_value"))
    got, want = ({key(r): r for r in df.collect()} for df in (fast, direct))
    assert set(got) == set(want) and any("None" in k for k in got)
    for k in want:
        for c in ("median_roas", "median_ctr", "median_cpc", "max_roas"):
            assert got[k][c] == pytest.approx(want[k][c]), (k, c)


def test_repeated_json_keys_keep_the_last_value(spark):
    spark.conf.unset("spark.sql.variant.allowDuplicateKeys")
    df = spark.createDataFrame([('[{"attribute":"a","attribute":"b"},{"attribute":"c"}]',)], "j string")
    out = J.keep_last_of_repeated_keys(df).select(F.explode(J.variant_elements("j")).alias("e"))
    assert [r.t for r in out.select(J.field_text(F.col("e"), "attribute").alias("t")).collect()] == ["b", "c"]


def test_long_numbers_are_kept_or_refused(spark):
    df = spark.createDataFrame([("1234567890123",), ("0.1234567",), ("12.",), ("-1",), ("1e3",)], "t string")
    got = [r.n for r in df.select(guarded_number(F.col("t")).alias("n")).collect()]
    assert [None if g is None else float(g) for g in got] == [1234567890123.0, 0.1234567, 12.0, None, None]
    assert [float(r.n) for r in df.select(loose_number(F.col("t")).alias("n")).collect()] == [1234567890123.0, 0.1234567, 12.0, -1.0, 1000.0]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|CAST_OVERFLOW|out of range|cannot be represented"):
        spark.createDataFrame([("9" * 30,)], "t string").select(guarded_number(F.col("t"))).collect()


def test_rank_counts_every_account_of_a_platform_id(spark):
    rpa = spark.createDataFrame([(1, "p")] * 3 + [(1, "q")] * 2 + [(1, "r")] * 2, "ad_account_id long, persona_attribute string")
    accounts = spark.createDataFrame([("1", "x"), ("1", "y"), ("zz", "n")], "meta_ad_account_id string, ad_account_name string")
    out = reports.review_ranking(rpa, accounts).collect()
    assert sorted((r.persona_name, r.review_rank) for r in out) == [("p", 1), ("p", 1), ("q", 3), ("q", 3), ("r", 3), ("r", 3)]
    assert {r.total_unique_reviews for r in out} == {7}


def test_copies_of_one_hot_key_use_many_tasks(spark):
    rows = spark.createDataFrame([("a", "p", 1, d, 50) for d in range(1000)], "account string, persona string, rev int, day int, n int")
    out = repeat_rows(rows, "n").withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in out.groupBy("task").count().collect()]
    assert sum(sizes) == 50_000 and len(sizes) >= 3 and max(sizes) < 25_000


@pytest.mark.parametrize("part_rows", [1, 7, 1000])
def test_persona_parts_make_up_the_summary(spark, part_rows):
    data = [(a, f"p{i * 37 % 50}") for a, n in ((1, 40), (2, 3), (None, 12)) for i in range(n)] * 2 + [(3, None), (2, "é"), (2, "")]
    rpa = spark.createDataFrame([(a, p, 0.5, None) for a, p in data], "ad_account_id long, persona_attribute string, confidence_score double, review_date date")
    parts = gaps.review_account_personas(rpa, part_rows).collect()
    assert all(0 < r.personas <= part_rows for r in parts)
    assert len({(r.review_account_id, r.part) for r in parts}) == len(parts)
    whole = {r.review_account_id: r.sample_personas for r in gaps.review_account_summary(rpa).collect()}
    joined = {a: ", ".join(r.persona_list for r in sorted(parts, key=lambda r: r.part) if r.review_account_id == a) for a in whole}
    assert joined == whole


def test_an_account_of_a_million_personas_has_bounded_parts(spark):
    rpa = spark.range(1_000_000).selectExpr("7L as ad_account_id", "'p' || id as persona_attribute")
    parts = gaps.review_account_personas(rpa, 1000)
    most, least, total, names = parts.selectExpr("max(personas)", "min(personas)", "sum(personas)", "sum(size(split(persona_list, ', ')))").first()
    assert (most, least, total, names) == (1000, 1000, 1_000_000, 1_000_000)
