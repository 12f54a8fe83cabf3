"""Registered queries: Spark builder, output contract and SQL check for each.

Every query reads the driver's tables at ``sf_dir`` through the raw-table
projections, so its work grows with them. Outputs are conformed to BIGINT /
DOUBLE (rounded to 6 places) / STRING columns in a fixed order on both
engines, because the checker compares value hashes: dates and timestamps are
compared as text, decimals as doubles.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personalens.operators import gaps, mapping
from personalens.plans import duck_checks as D
from personalens.plans.staging import STAGING
from personalens.plans.warehouse import Warehouse
from personalens.sources.tpch_binding import BINDINGS


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    spec: list[tuple[str, str]]          # (column, kind): i / d / s / b
    source: str | None = None            # CTE the SQL check selects from
    where: str | None = None
    counts: str | None = None            # build counts equal rows in this column,
    expand: Callable[[DataFrame], DataFrame] | None = None  # and this repeats them

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        if self.counts is None:
            return conform(self.build(spark, sf_dir), self.spec)
        # Values are conformed once for all copies of a row.
        return self.expand(conform(self.build(spark, sf_dir), self.spec + [(self.counts, "i")]))

    def sql(self) -> str | None:
        return None if self.source is None else D.select_sql(self.source, self.spec, self.where)


def conform(df: DataFrame, spec: list[tuple[str, str]]) -> DataFrame:
    cols = []
    for c, kind in spec:
        if kind == "i":
            cols.append(F.col(c).cast("long").alias(c))
        elif kind == "d":
            cols.append(F.round(F.col(c).cast("double"), 6).alias(c))
        elif kind == "b":
            cols.append(F.col(c).cast("boolean").alias(c))
        else:
            cols.append(F.col(c).cast("string").alias(c))
    return df.select(*cols)


def _spec(text: str) -> list[tuple[str, str]]:
    """'a:i b:d c' -> [(a, i), (b, d), (c, s)]"""
    out = []
    for tok in text.split():
        name, _, kind = tok.partition(":")
        out.append((name, kind or "s"))
    return out


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.from_driver_tables(spark, sf_dir)


# Models each query reads more than once (written once per run, see Warehouse).
SHARED = ("review_persona_attributes", "ad_persona_attributes")
REUSE = {
    "cross_account_mapping": SHARED,
    "scorecard": SHARED,
    "scorecard_tiers": ("ad_persona_attributes",),
    "gap_analysis": SHARED,
    "critical_gaps": SHARED,
    "top_opportunities": SHARED,
    "dq_accepted_values": SHARED,
    "dq_not_null": SHARED + ("ad_personas_from_review_analysis", "ad_performance", "scorecard"),
}


# Reports with many equal rows: (column that counts them, Warehouse method that gives the counted rows, their expansion).
COUNTED = {
    "cross_account_mapping": (mapping.COPIES, Warehouse.counted_mapping, mapping.expand_mapping),
    "cross_system_analysis": (gaps.COPIES, Warehouse.counted_cross_system, gaps.expand_cross_system),
}


def _model(attr: str, name: str) -> Callable[[SparkSession, str], DataFrame]:
    def build(spark, sf_dir):
        wh = Warehouse.from_driver_tables(spark, sf_dir, materialize=REUSE.get(name, ()))
        return COUNTED[name][1](wh) if name in COUNTED else getattr(wh, attr)
    return build


REVIEW_ITEM = "review_id:i ad_account_id:i review_date review_author"
AD_ITEM = "cad_creative_analysis_id:i ad_analysis_id:i ads_meta_id:i ad_creative_id:i ad_account_id:i"

SPECS = {
    "review_persona_attributes": (
        f"{REVIEW_ITEM} persona_attribute persona_value confidence_score:d source_system loaded_at",
        "rpa"),
    "review_value_propositions": (
        f"{REVIEW_ITEM} value_proposition importance_score:d sentiment source_system loaded_at", "rvp"),
    "review_problems": (
        f"{REVIEW_ITEM} problem severity_score:d problem_category source_system loaded_at", "rpr"),
    "review_barriers": (
        f"{REVIEW_ITEM} barrier impact_score:d barrier_type source_system loaded_at", "rba"),
    "ad_persona_attributes": (
        f"{AD_ITEM} core_persona persona_attribute persona_value confidence_score:d source_system "
        "loaded_at", "apa"),
    "ad_value_propositions": (
        f"{AD_ITEM} value_proposition strength_score:d clarity_score:d source_system loaded_at", "avp"),
    "ad_problems": (
        f"{AD_ITEM} problem relevance_score:d urgency_score:d source_system loaded_at", "apb"),
    "ad_barriers": (
        f"{AD_ITEM} barrier solution_strength:d addressability_score:d source_system loaded_at", "aba"),
    "ad_personas_from_review_analysis": (
        "ad_account_id:i review_creative_analysis_id:i ad_id:i persona_attribute persona_value "
        "confidence_score:d source_system loaded_at", "apr"),
    "unified_persona_attributes": (
        "ad_account_id:i persona_attribute persona_value confidence_score:d source_system "
        "mention_count:i entity_count:i avg_confidence_score:d latest_mention_date "
        "earliest_mention_date review_count:i ad_count:i review_variations:i ad_variations:i "
        "total_review_mentions:i total_ad_mentions:i avg_review_confidence:d avg_ad_confidence:d "
        "latest_review_mention latest_ad_mention coverage_type loaded_at", "unified_final"),
    "review_ranking": (
        "persona_name account_name ad_account_id:i review_count:i percentage:d "
        "total_unique_reviews:i volume_category review_rank:i", "review_ranking"),
    "ad_performance": (
        "persona_attribute ad_count:i total_ad_spend:d persona_mentions:i avg_confidence:d aov:d "
        "roas:d thumbstop_rate:d total_purchase_value:d total_purchases:d total_video_watches:d "
        "total_impressions:d", "ad_performance"),
    "opportunity_index": (
        "persona_attribute review_count:i review_percentage:d ad_count:i total_ad_spend:d "
        "raw_ratio:d opportunity_index:d opportunity_color", "opportunity_index"),
    "cross_account_mapping": (
        "cad_account_id:i cad_account_name review_account_id:i review_account_name "
        "persona_attribute cad_persona_mentions:i cad_ads_with_persona:i avg_cad_confidence:d "
        "review_persona_mentions:i review_count_with_persona:i avg_review_confidence:d "
        "latest_review_mention persona_coverage cross_system_alignment_score:d loaded_at", "xmap"),
    "scorecard_tiers": (
        "ad_account_id:i persona_attribute persona_value ad_count:i core_persona_count:i "
        "avg_roas:d median_roas:d max_roas:d min_roas:d avg_ctr:d median_ctr:d max_ctr:d "
        "avg_cpc:d median_cpc:d total_spend:d total_impressions:d total_reach:d total_clicks:d "
        "avg_thumbstop:d avg_retention:d avg_frequency:d avg_confidence_score:d latest_data_date "
        "roas_tier ctr_tier spend_tier performance_tier composite_performance_score:d",
        "sc_scoring"),
    "scorecard": (
        "ad_account_id:i persona_attribute persona_value ad_count:i core_persona_count:i "
        "avg_roas:d median_roas:d max_roas:d min_roas:d avg_ctr:d median_ctr:d max_ctr:d "
        "avg_cpc:d median_cpc:d total_spend:d total_impressions:d total_reach:d total_clicks:d "
        "avg_thumbstop:d avg_retention:d avg_frequency:d avg_confidence_score:d latest_data_date "
        "roas_tier ctr_tier spend_tier performance_tier composite_performance_score:d "
        "review_mention_count:i avg_review_confidence:d latest_review_date persona_coverage "
        "cross_system_alignment_score:d review_account_name review_account_id:i "
        "account_mapping_status gap_analysis_category opportunity_score:d loaded_at", "scorecard"),
    "gap_analysis": (
        "ad_account_id:i persona_attribute review_count:i total_mentions:i avg_confidence:d "
        "latest_review_date earliest_review_date persona_coverage cross_system_alignment_score:d "
        "review_account_name review_account_id cad_account_name ad_count:i performance_tier "
        "gap_analysis_category opportunity_score:d avg_roas:d avg_ctr:d total_spend:d "
        "composite_performance_score:d account_mapping_status gap_type priority_score:i "
        "opportunity_level days_since_last_review:i review_frequency:d gap_priority "
        "recommendation loaded_at ad_account_name account_industry account_description "
        "priority_rank:i", "gap_analysis"),
    "gap_analysis_simple": (
        "ad_account_id:i persona_attribute review_count:i total_mentions:i avg_confidence:d "
        "latest_review_date earliest_review_date ad_mention_count:i gap_type priority_score:i "
        "loaded_at ad_account_name gap_priority recommendation", "gap_simple"),
    "cross_system_analysis": (
        "cad_account_id:i cad_account_name cad_product review_account_name persona_attribute "
        "review_mentions:i avg_review_confidence:d latest_review_date ad_mentions:i "
        "avg_ad_confidence:d total_ad_spend:d account_aov:d account_roas:d "
        "account_thumbstop_rate:d total_ads:i raw_opportunity_ratio:d gap_status "
        "priority_score:d opportunity_rank:i", "cross_system"),
    "account_opportunities": (
        "cad_account_id:i cad_account_name mapping_status mapped_products:i total_ad_spend:d "
        "account_aov:d account_roas:d account_thumbstop_rate:d total_ads:i unique_ad_personas:i "
        "total_ad_persona_mentions:i review_personas_available:i total_review_mentions:i "
        "opportunity_score:i performance_tier priority_score:d", "account_opportunities"),
    "review_account_summary": (
        "review_account_id:i unique_personas:i total_persona_mentions:i avg_confidence:d "
        "latest_review_date sample_personas", "review_account_summary"),
}

MODEL_ATTR = {
    "review_persona_attributes": "review_persona_attributes",
    "review_value_propositions": "review_value_propositions",
    "review_problems": "review_problems",
    "review_barriers": "review_barriers",
    "ad_persona_attributes": "ad_persona_attributes",
    "ad_value_propositions": "ad_value_propositions",
    "ad_problems": "ad_problems",
    "ad_barriers": "ad_barriers",
    "ad_personas_from_review_analysis": "ad_personas_from_review_analysis",
    "unified_persona_attributes": "unified_persona_attributes",
    "review_ranking": "review_ranking",
    "ad_performance": "ad_performance",
    "opportunity_index": "opportunity_index",
    "cross_account_mapping": "cross_account_mapping",
    "scorecard_tiers": "scorecard_tiers",
    "scorecard": "scorecard",
    "gap_analysis": "gap_analysis",
    "gap_analysis_simple": "gap_analysis_simple",
    "cross_system_analysis": "cross_system_analysis",
    "account_opportunities": "account_opportunities",
    "review_account_summary": "review_account_summary",
}


def _staging_queries() -> dict[str, Query]:
    out = {}
    for name, spec in STAGING.items():
        cols = [e.rsplit(" as ", 1)[1].strip() for e in BINDINGS[name][1]]
        staged = [spec.renames.get(c, c) for c in cols]
        if spec.source_system is not None:
            staged.append("source_system")
        if spec.loaded_at:
            staged.append("loaded_at")

        def build(spark, sf_dir, _n=name):
            return _wh(spark, sf_dir).stg[f"stg_{_n}"]
        out[f"stage_{name}"] = Query(build, [(c, "s") for c in staged], f"stg_{name}")
    return out


def all_queries() -> dict[str, Query]:
    from personalens.plans import extra_queries
    qs: dict[str, Query] = {}
    qs.update(_staging_queries())
    for name, (spec, source) in SPECS.items():
        counts, _, expand = COUNTED.get(name, (None, None, None))
        qs[name] = Query(_model(MODEL_ATTR[name], name), _spec(spec), source, counts=counts, expand=expand)
    qs.update(extra_queries.queries())
    return qs
