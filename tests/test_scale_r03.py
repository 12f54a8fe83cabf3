"""Reports whose rows multiply: counted forms, distinct personas without a shuffle, figures by jobs of their own."""

from collections import Counter

from personalens.operators import expand, gaps, mapping, normalize, quality, ranking
from personalens.plans import extra_queries
from personalens.plans.warehouse import Warehouse
from pyspark.sql import functions as F


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _mapping_inputs(spark):
    apa = spark.createDataFrame([(1, "a", 10)], "ad_account_id long, persona_attribute string, ads_meta_id long").withColumn(
        "confidence_score", F.lit(0.5).cast("decimal(38,12)"))
    rpa = spark.createDataFrame([(r, 7, "b") for r in range(40)] + [(99, 7, "a")], "review_id long, ad_account_id long, persona_attribute string").selectExpr(
        "*", "cast(0.8 as decimal(38,12)) as confidence_score", "date'2024-01-01' as review_date")
    seed = spark.createDataFrame([(a, "n", "s", 7) for a in (1, None) for _ in range(30)],
                                 "ad_account_id long, ad_account_name string, review_account_name string, review_account_id long")
    return apa, rpa, seed


def test_counted_mapping_holds_equal_rows_once(spark):
    inputs = _mapping_inputs(spark)
    counted = mapping.counted_mapping(*inputs)
    assert counted.where("persona_coverage = 'review_only'").count() == 3  # (1, b), (null, a), (null, b), not 2430 rows
    fast = mapping.cross_account_persona_mapping(*inputs)
    assert fast.where("persona_coverage = 'review_only'").count() == 40 * 60 + 30
    assert Counter(fast.collect()) == Counter(mapping.cross_account_persona_mapping_windows(*inputs).collect())


def test_rank_of_counted_rows_is_the_rank_of_their_first_copy(spark):
    df = spark.createDataFrame([(x, x % 4) for x in range(200)], "x long, n long").where("n > 0")
    ranked = ranking.global_row_number(df, [F.col("x").desc()], "rank", 5, copies="n")
    out = expand.repeat_rows(ranked, "n", chunk=2, number="i").select("x", (F.col("rank") + F.col("i")).alias("rank")).collect()
    expected = sorted([x for x in range(200) for _ in range(x % 4)], reverse=True)
    assert [r.x for r in sorted(out, key=lambda r: r["rank"])] == expected
    assert sorted(r["rank"] for r in out) == list(range(1, len(expected) + 1))


def test_cross_system_sorts_counted_rows(spark):
    wh = Warehouse.from_driver_tables(spark, "/root/testdata/sf0.001")
    counted = wh.counted_cross_system()
    assert "Range" not in _plan(counted).split("Relation")[0]  # ranked rows are read back from files
    rows = gaps.expand_cross_system(counted).collect()
    assert sorted(r.opportunity_rank for r in rows) == list(range(1, len(rows) + 1))
    assert len(rows) == counted.agg(F.sum(gaps.COPIES)).first()[0]


def test_figures_weigh_counted_rows(spark):
    df = spark.createDataFrame([("a", 3), (None, 5)], "c string, n long")
    assert [r.null_rows for r in quality.not_null_counts(df, ["c"], "m", "n").collect()] == [5]
    assert [(r.column_name, r.filled_rows) for r in quality.contract_counts(df, ["c"], "m", "n").collect()] == [("c", 3)]
    empty = df.where("n > 9")
    assert [r.filled_rows for r in quality.contract_counts(empty, ["c"], "m", "n").collect()] == [0]


def test_figures_of_models_are_no_single_plan(spark):
    parts = (spark.range(n).selectExpr("count(*) as n") for n in (3, 4))
    out = extra_queries._one_by_one(spark, parts)
    assert "Union" not in _plan(out) and sorted(r.n for r in out.collect()) == [3, 4]


def test_personas_of_shared_and_missing_analysis_ids_are_distinct(spark):
    one, two = '[{"attribute":"A","value":"v"}, {"attribute":"a ","value":"v"}, "x"]', '[{"attribute":"a","value":"v"}]'
    rows = [(1, 5, 9, one, '["h", "H", "x"]'), (2, 5, 9, two, None), (2, 5, 9, two, None), (2, 6, 9, two, None), (None, 5, 9, two, '["h"]'),
            (None, 5, 9, two, "{}"), (3, 5, 9, "{}", '["h"]')]
    df = spark.createDataFrame(rows, "review_creative_analysis_id long, ad_account_id long, ad_id long, persona_attributes string, "
                                     "hook_persona_attributes string").withColumn("loaded_at", F.lit("2025-01-01").cast("timestamp"))
    out = normalize.ad_persona_attributes_from_review_analysis(df)
    got = Counter((r.review_creative_analysis_id, r.ad_account_id, r.persona_attribute, r.persona_value) for r in out.collect())
    expected = [(1, 5, "a", "v"), (1, 5, '"x"', '"x"'), (1, 5, "h", "h"), (1, 5, "h", "H"), (1, 5, "x", "x"), (2, 5, "a", "v"), (2, 6, "a", "v"),
                (None, 5, "a", "v"), (None, 5, "h", "h"), (3, 5, "h", "h")]
    assert got == Counter(expected)
    plan = _plan(out)
    assert "LeftAnti" in plan and plan.index("LeftAnti") < plan.index("LeftSemi")


def test_ad_rows_are_dealt_out_before_their_json_is_read(spark):
    wh = Warehouse.from_driver_tables(spark, "/root/testdata/sf0.001")
    plan = _plan(wh.ad_persona_attributes)
    assert plan.index("Generate explode") < plan.index("Repartition")
