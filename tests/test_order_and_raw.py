"""Row order of the sorted reports, and models from a folder of raw tables."""

from pyspark.sql import functions as F

from core_help import SF_SMALL
from personalens.__main__ import _warehouse
from personalens.operators import gaps, reports
from personalens.plans.warehouse import Warehouse
from personalens.sources.tpch_binding import DriverTables, raw_schema


def _key(*parts):
    """Sort key of a row: (column, descending) with NULL as the greatest value."""
    def of(r):
        out = []
        for c, desc in parts:
            v = r[c]
            out.append((v is not None, -v if v is not None else 0) if desc else (v is None, v if v is not None else 0))
        return out
    return of


def test_review_ranking_is_sorted_when_asked(spark):
    wh = Warehouse.from_driver_tables(spark, SF_SMALL)
    rows = reports.review_ranking(wh.review_persona_attributes, wh.ad_accounts, sort=True).collect()
    assert len(rows) > 10 and rows == sorted(rows, key=_key(("ad_account_id", False), ("review_count", True), ("persona_name", False)))


def test_opportunity_index_is_sorted_when_asked(spark):
    wh = Warehouse.from_driver_tables(spark, SF_SMALL)
    rows = reports.opportunity_index(wh.review_persona_attributes, wh.ad_performance, sort=True).collect()
    key = _key(("opportunity_index", True), ("review_count", True))
    assert len(rows) > 10 and [key(r) for r in rows] == sorted(key(r) for r in rows)


def test_ad_performance_is_sorted_when_asked(spark):
    wh = Warehouse.from_driver_tables(spark, SF_SMALL)
    rows = reports.persona_ad_performance(wh.ad_personas_from_review_analysis, wh.ads_meta, wh.insights, sort=True).collect()
    key = _key(("total_ad_spend", True))
    assert len(rows) > 10 and [key(r) for r in rows] == sorted(key(r) for r in rows)


def test_gap_analysis_is_sorted_when_asked(spark):
    wh = Warehouse.from_driver_tables(spark, SF_SMALL)
    rows = gaps.persona_gap_analysis(wh.review_persona_attributes, wh.scorecard, wh.ad_accounts, wh.as_of, sort=True).collect()
    key = _key(("priority_rank", False), ("priority_score", True), ("review_count", True))
    assert len(rows) > 10 and [key(r) for r in rows] == sorted(key(r) for r in rows)


def test_cross_system_is_sorted_by_rank_when_asked(spark):
    wh = Warehouse.from_driver_tables(spark, SF_SMALL)
    rows = gaps.persona_cross_system_analysis(wh.seed, wh.review_persona_attributes, wh.ad_personas_from_review_analysis,
                                              wh.insights, wh.ads_meta, wh.ads, sort=True).collect()
    assert [r.opportunity_rank for r in rows] == list(range(1, len(rows) + 1))
    scores = [r.priority_score for r in rows if r.priority_score is not None]
    assert scores == sorted(scores, reverse=True)


def test_account_opportunities_are_sorted_when_asked(spark):
    wh = Warehouse.from_driver_tables(spark, SF_SMALL)
    rows = gaps.account_level_opportunities(wh.seed, wh.review_persona_attributes, wh.ad_personas_from_review_analysis, wh.insights,
                                            wh.ads_meta, wh.ads, wh.ad_accounts, sort=True).collect()
    keys = [(r.priority_score, r.total_ad_spend) for r in rows]
    assert len(keys) > 5 and keys == sorted(keys, key=lambda k: tuple((x is None, x or 0) for x in k), reverse=True)


def test_raw_folder_is_read_with_declared_types_and_columns(spark, tmp_path):
    tables = DriverTables(spark, SF_SMALL)
    for name in ("cad_ad_accounts", "review_reviews", "review_ad_creative_analysis"):
        tables.raw(name).withColumn("_ingested_at", F.lit("x")).write.parquet(f"{tmp_path}/{name}")
    wh = _warehouse(spark, type("A", (), {"tpch_dir": None, "raw_dir": str(tmp_path)}))
    own = Warehouse.from_driver_tables(spark, SF_SMALL)
    assert wh.ad_accounts.dtypes == own.ad_accounts.dtypes and "_ingested_at" not in wh.reviews.columns
    assert sorted(wh.review_ranking.collect(), key=repr) == sorted(own.review_ranking.collect(), key=repr)
    assert "bigint" in raw_schema(spark, "cad_ad_accounts")
