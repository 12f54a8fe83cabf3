"""Gap reports: the primary gap analysis (GAP-1), the simple gap view
(GAP-2), the product-mapped cross-system analysis (GAP-3), account-level
opportunities (GAP-4) and the review-account summary (DEAD-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personalens.functions.numeric import NUMERIC, safe_ratio
from personalens.operators.expand import repeat_rows
from personalens.operators.ranking import global_row_number
from personalens.operators.reports import insight_totals_per_ad
from personalens.plans.staging import DEFAULT_AS_OF, run_timestamp

DEFAULT_AS_OF_DATE = DEFAULT_AS_OF[:10]


def review_persona_summary(rpa: DataFrame) -> DataFrame:
    return rpa.groupBy("ad_account_id", "persona_attribute").agg(
        F.countDistinct("review_id").alias("review_count"),
        F.count(F.lit(1)).alias("total_mentions"),
        F.avg("confidence_score").alias("avg_confidence"),
        F.max("review_date").alias("latest_review_date"),
        F.min("review_date").alias("earliest_review_date"))


# Recommendation texts of the primary gap analysis.
GAP_RECOMMENDATIONS = {
    "completely_unaddressed": "Create new ad campaigns targeting this persona",
    "underperforming": "Optimize existing ads or create new creative approaches",
    "moderate_opportunity": "Consider increasing budget or improving creative",
    "well_served": "Maintain current approach",
}
GAP_DEFAULT_RECOMMENDATION = "Further analysis needed"


def persona_gap_analysis(rpa: DataFrame, scorecard: DataFrame, ad_accounts: DataFrame,
                         as_of: str = DEFAULT_AS_OF, sort: bool = False) -> DataFrame:
    """GAP-1: review personas against ad performance, actionable gaps only.

    Review personas per (account, persona) meet the scorecard (whose grain
    also has the persona value, so a persona can match several rows), get a
    gap type, priority score, opportunity level, recency and frequency, and
    keep critical / high / medium gaps of accounts that exist.
    """
    rp = review_persona_summary(rpa)
    ap = scorecard.select(
        F.col("ad_account_id").alias("_ap_account"), F.col("persona_attribute").alias("_ap_persona"),
        "performance_tier", "gap_analysis_category", F.col("opportunity_score").alias("_ap_opp"),
        F.col("ad_count").alias("_ap_ads"), "avg_roas", "avg_ctr", "total_spend",
        "composite_performance_score", "persona_coverage",
        F.col("cross_system_alignment_score").alias("_ap_align"),
        F.col("account_mapping_status").alias("_ap_status"))
    j = rp.join(ap, (rp.ad_account_id == F.col("_ap_account")) &
                (rp.persona_attribute == F.col("_ap_persona")), "left")
    missing = F.col("_ap_persona").isNull()
    cat = F.col("gap_analysis_category")
    n = F.col("review_count")
    gap_type = (F.when(missing, "completely_unaddressed")
                .when(cat == "underperforming_persona", "underperforming")
                .when(cat == "opportunity_persona", "moderate_opportunity")
                .when(cat == "well_served_persona", "well_served")
                .otherwise("unknown"))
    priority = (F.when(missing, n * 20).when(cat == "underperforming_persona", n * 15)
                .when(cat == "opportunity_persona", n * 10)
                .when(cat == "well_served_persona", n * 2).otherwise(n * 1))
    level = (F.when(missing & (n >= 5), "high_opportunity")
             .when((cat == "underperforming_persona") & (n >= 3), "high_opportunity")
             .when(missing & (n >= 2), "medium_opportunity")
             .when(cat.isin("underperforming_persona", "opportunity_persona"), "medium_opportunity")
             .when(cat == "well_served_persona", "low_opportunity")
             .otherwise("unknown_opportunity"))
    latest, earliest = F.col("latest_review_date"), F.col("earliest_review_date")
    frequency = (F.when(latest != earliest,
                        F.col("total_mentions").cast("double") / (F.datediff(latest, earliest) + 1))
                 .otherwise(F.col("total_mentions").cast("double")))
    gaps = j.select(
        "ad_account_id", "persona_attribute", "review_count", "total_mentions", "avg_confidence",
        "latest_review_date", "earliest_review_date", "persona_coverage",
        F.coalesce(F.col("_ap_align"), F.lit(0.0)).alias("cross_system_alignment_score"),
        F.lit(None).cast("string").alias("review_account_name"),
        F.lit(None).cast("string").alias("review_account_id"),
        F.lit("Unknown").alias("cad_account_name"),
        F.coalesce(F.col("_ap_ads"), F.lit(0)).alias("ad_count"),
        "performance_tier", "gap_analysis_category",
        F.coalesce(F.col("_ap_opp"), F.lit(0.0)).alias("opportunity_score"),
        "avg_roas", "avg_ctr", "total_spend", "composite_performance_score",
        F.coalesce(F.col("_ap_status"), F.lit("unmapped_account")).alias("account_mapping_status"),
        gap_type.alias("gap_type"), priority.alias("priority_score"), level.alias("opportunity_level"),
        F.datediff(F.lit(as_of[:10]).cast("date"), latest).alias("days_since_last_review"),
        frequency.alias("review_frequency"))
    g, lv = F.col("gap_type"), F.col("opportunity_level")
    gap_priority = (F.when((g == "completely_unaddressed") & (lv == "high_opportunity"), "critical")
                    .when((g == "underperforming") & (lv == "high_opportunity"), "high")
                    .when((g == "completely_unaddressed") & (lv == "medium_opportunity"), "high")
                    .when((g == "underperforming") & (lv == "medium_opportunity"), "medium")
                    .when((g == "moderate_opportunity") &
                          lv.isin("high_opportunity", "medium_opportunity"), "medium")
                    .when(g == "well_served", "low")
                    .otherwise("unknown"))
    rec = None
    for k, text in GAP_RECOMMENDATIONS.items():
        rec = F.when(g == k, text) if rec is None else rec.when(g == k, text)
    tiers = gaps.select("*", gap_priority.alias("gap_priority"),
                        rec.otherwise(GAP_DEFAULT_RECOMMENDATION).alias("recommendation"),
                        run_timestamp(as_of).alias("loaded_at"))
    accounts = ad_accounts.select(F.col("ad_account_id").alias("_acct"), "ad_account_name",
                                  "account_industry", "account_description")
    p = F.col("gap_priority")
    out = (tiers.where(p.isin("critical", "high", "medium") & (F.col("review_count") >= 1))
           .join(accounts, F.col("ad_account_id") == F.col("_acct"))
           .drop("_acct")
           .withColumn("priority_rank",
                       F.when(p == "critical", 1).when(p == "high", 2).when(p == "medium", 3)
                       .otherwise(5)))
    if sort:
        out = out.orderBy(F.col("priority_rank").asc_nulls_last(),
                          F.col("priority_score").desc_nulls_first(),
                          F.col("review_count").desc_nulls_first())
    return out


# Recommendation texts of the simple gap view.
SIMPLE_RECOMMENDATIONS = {
    "completely_unaddressed": "Create ad campaigns targeting this persona",
    "has_coverage": "Review current ad performance for this persona",
    "ads_without_reviews": "Validate if this persona resonates with customers",
}


def persona_gap_analysis_simple(rpa: DataFrame, apa: DataFrame, ad_accounts: DataFrame,
                                as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """GAP-2: review personas full-outer ad personas per (account, persona)."""
    rp = review_persona_summary(rpa).select(
        F.col("ad_account_id").alias("_r_account"), F.col("persona_attribute").alias("_r_persona"),
        "review_count", "total_mentions", "avg_confidence", "latest_review_date",
        "earliest_review_date")
    ap = apa.groupBy(F.col("ad_account_id").alias("_a_account"),
                     F.col("persona_attribute").alias("_a_persona")).agg(
        F.count(F.lit(1)).alias("_ad_mentions"))
    j = rp.join(ap, (F.col("_r_account") == F.col("_a_account")) &
                (F.col("_r_persona") == F.col("_a_persona")), "full")
    r_in, a_in = F.col("_r_persona").isNotNull(), F.col("_a_persona").isNotNull()
    gap_type = (F.when(r_in & ~a_in, "completely_unaddressed").when(r_in & a_in, "has_coverage")
                .when(~r_in & a_in, "ads_without_reviews").otherwise("unknown"))
    score = (F.when(r_in & ~a_in, F.col("review_count") * 20)
             .when(r_in & a_in, F.col("review_count") * 5).otherwise(F.lit(0)))
    ga = j.select(
        F.coalesce("_r_account", "_a_account").alias("ad_account_id"),
        F.coalesce("_r_persona", "_a_persona").alias("persona_attribute"),
        F.coalesce(F.col("review_count"), F.lit(0)).alias("review_count"),
        F.coalesce(F.col("total_mentions"), F.lit(0)).alias("total_mentions"),
        "avg_confidence", "latest_review_date", "earliest_review_date",
        F.coalesce(F.col("_ad_mentions"), F.lit(0)).alias("ad_mention_count"),
        gap_type.alias("gap_type"), score.alias("priority_score"),
        run_timestamp(as_of).alias("loaded_at"))
    g, n = F.col("gap_type"), F.col("review_count")
    priority = (F.when((g == "completely_unaddressed") & (n >= 5), "critical")
                .when((g == "completely_unaddressed") & (n >= 2), "high")
                .when((g == "has_coverage") & (n >= 10), "medium").otherwise("low"))
    rec = None
    for k, text in SIMPLE_RECOMMENDATIONS.items():
        rec = F.when(g == k, text) if rec is None else rec.when(g == k, text)
    accounts = ad_accounts.select(F.col("ad_account_id").alias("_acct"), "ad_account_name")
    return (ga.where(g.isin("completely_unaddressed", "has_coverage") & (n >= 1))
            .join(accounts, F.col("ad_account_id") == F.col("_acct")).drop("_acct")
            .select("*", priority.alias("gap_priority"),
                    rec.otherwise("Monitor").alias("recommendation")))


def account_performance(insights: DataFrame, ads_meta: DataFrame, ads: DataFrame) -> DataFrame:
    """Spend and return per ad account: insights summed per ads_meta first,
    then through ads_meta -> ads to the account."""
    totals = insight_totals_per_ad(insights)
    ad_rows = (totals.join(ads_meta.select("ads_meta_id", "ad_id"), "ads_meta_id")
               .join(ads.select("ad_id", "ad_account_id"), "ad_id"))
    return ad_rows.groupBy("ad_account_id").agg(
        F.sum("amount_spent").alias("total_ad_spend"),
        F.sum("omni_purchase_value").alias("total_purchase_value"),
        F.sum("omni_purchase_purchases").alias("total_purchases"),
        F.sum("video_3_sec_watched_actions").alias("total_video_watches"),
        F.sum("impressions").alias("total_impressions"),
        F.countDistinct("ad_id").alias("total_ads"))


def _account_ratios() -> list[Column]:
    return [safe_ratio(F.col("total_purchase_value"), F.col("total_purchases")).alias("account_aov"),
            safe_ratio(F.col("total_purchase_value"), F.col("total_ad_spend")).alias("account_roas"),
            safe_ratio(F.col("total_video_watches"), F.col("total_impressions"))
            .alias("account_thumbstop_rate")]


CROSS_SYSTEM_ORDER = [
    ("priority_score", "desc"), ("review_mentions", "desc"), ("cad_account_id", "asc"),
    ("cad_product", "asc"), ("persona_attribute", "asc"), ("review_account_name", "asc"),
    ("ad_mentions", "desc"), ("avg_ad_confidence", "desc"),
]


def persona_cross_system_analysis(seed: DataFrame, rpa: DataFrame, apr: DataFrame,
                                  insights: DataFrame, ads_meta: DataFrame, ads: DataFrame,
                                  sort: bool = False) -> DataFrame:
    """GAP-3: review demand per mapped product against ad supply and account
    performance, with a global opportunity rank.

    The rank is a distributed row number (range partitioning + per-partition
    offsets), not a window over one partition. Ties in the priority score are
    broken by the other output columns so the order is total.
    """
    out = expand_cross_system(counted_cross_system(seed, rpa, apr, insights, ads_meta, ads))
    if sort:
        out = out.orderBy("opportunity_rank")
    return out


#: Column of :func:`counted_cross_system`: how many rows of the report a row stands for.
COPIES = "_products"


def expand_cross_system(counted: DataFrame) -> DataFrame:
    """The report's rows of :func:`counted_cross_system`: copies, numbered from the first one's rank."""
    rank = (F.col("opportunity_rank") + F.col("_copy")).alias("opportunity_rank")
    return repeat_rows(counted, COPIES, number="_copy").select(*[rank if c == "opportunity_rank" else c for c in counted.columns if c != COPIES])


def counted_cross_system(seed: DataFrame, rpa: DataFrame, apr: DataFrame,
                         insights: DataFrame, ads_meta: DataFrame, ads: DataFrame) -> DataFrame:
    """GAP-3 with equal rows counted in ``_products`` and the rank of the first of them.

    The report has an ad persona once for each product of its account, for each
    product: the square of the products. Sorting and numbering see each row once.
    """
    pm = seed.where(F.col("matched_review_product").isNotNull() &
                    F.col("review_account_id").isNotNull() & F.col("ad_account_id").isNotNull())
    rp = rpa.groupBy(F.col("ad_account_id").alias("review_account_id"), "persona_attribute").agg(
        F.count(F.lit(1)).alias("review_mentions"),
        F.avg("confidence_score").alias("avg_review_confidence"),
        F.max("review_date").alias("latest_review_date"))
    ap = apr.groupBy(F.col("ad_account_id").alias("_ap_account"),
                     F.col("persona_attribute").alias("_ap_persona")).agg(
        F.count(F.lit(1)).alias("ad_mentions"),
        F.avg("confidence_score").alias("avg_ad_confidence"))
    perf = account_performance(insights, ads_meta, ads)
    aps = perf.select(F.col("ad_account_id").alias("_perf_account"), "total_ad_spend",
                      *_account_ratios(), "total_ads")
    mrp = (pm.select(F.col("ad_account_id").alias("cad_account_id"),
                     F.col("ad_account_name").alias("cad_account_name"),
                     F.col("product").alias("cad_product"), "review_account_id",
                     "review_account_name")
           .join(rp, "review_account_id")
           .join(aps, F.col("cad_account_id") == F.col("_perf_account"), "left"))
    mrp = mrp.withColumn(
        "raw_opportunity_ratio",
        F.when(F.col("total_ad_spend") > 0,
               F.col("review_mentions").cast("double") / F.col("total_ad_spend").cast("double"))
        .otherwise(F.lit(999999.0)))
    # An ad persona stands once for each product of its account: the number is
    # carried along and the copies are made last, when the ranks are due.
    products = pm.groupBy(F.col("ad_account_id").alias("_map_account")).agg(F.count(F.lit(1)).alias("_products"))
    mapped_ads = (products.join(ap, F.col("_map_account") == F.col("_ap_account"))
                  .select("_map_account", "_products", F.lower(F.trim("_ap_persona")).alias("_map_key"),
                          "ad_mentions", "avg_ad_confidence"))
    pa = mrp.join(mapped_ads, (F.col("cad_account_id") == F.col("_map_account")) &
                  (F.lower(F.trim("persona_attribute")) == F.col("_map_key")), "left")
    addressed = F.col("ad_mentions") > 0
    status = (F.when(addressed, "addressed_in_ads")
              .when(F.col("review_mentions") > 0, "unaddressed_opportunity").otherwise("unknown"))
    priority = (F.col("review_mentions") * F.col("avg_review_confidence") *
                F.when(addressed, 0.5).otherwise(2.0) *
                F.when(F.col("account_roas") > 2, 1.5).otherwise(1.0))
    analysis = pa.select(
        "cad_account_id", "cad_account_name", "cad_product", "review_account_name",
        "persona_attribute", "review_mentions", "avg_review_confidence", "latest_review_date",
        F.coalesce(F.col("ad_mentions"), F.lit(0)).alias("ad_mentions"),
        F.coalesce(F.col("avg_ad_confidence"), F.lit(0).cast(NUMERIC)).alias("avg_ad_confidence"),
        "total_ad_spend", "account_aov", "account_roas", "account_thumbstop_rate", "total_ads",
        "raw_opportunity_ratio", status.alias("gap_status"),
        priority.cast("double").alias("priority_score"),
        F.coalesce(F.col("_products"), F.lit(1)).alias(COPIES))
    order = [F.col(c).desc_nulls_first() if d == "desc" else F.col(c).asc_nulls_last()
             for c, d in CROSS_SYSTEM_ORDER]
    return global_row_number(analysis, order, "opportunity_rank", copies=COPIES)


def account_level_opportunities(seed: DataFrame, rpa: DataFrame, apr: DataFrame,
                                insights: DataFrame, ads_meta: DataFrame, ads: DataFrame,
                                ad_accounts: DataFrame, sort: bool = False) -> DataFrame:
    """GAP-4: per ad account, performance against mapping and ad personas.

    The two account-independent review figures (distinct personas and
    mentions of all mapped review accounts) are scalar subqueries over one
    semi-joined aggregate.
    """
    mapped = seed.where(F.col("matched_review_product").isNotNull() &
                        F.col("review_account_id").isNotNull())
    mca = mapped.groupBy(F.col("ad_account_id").alias("_m_account"),
                         F.col("ad_account_name").alias("_m_name")).agg(
        F.count(F.lit(1)).alias("_mapped_products"))
    mra = mapped.select(F.col("review_account_id").alias("ad_account_id"))
    totals = insight_totals_per_ad(insights)
    cap_rows = (totals.join(ads_meta.select("ads_meta_id", "ad_id"), "ads_meta_id")
                .join(ads.select("ad_id", "ad_account_id"), "ad_id")
                .join(ad_accounts.select("ad_account_id", "ad_account_name"), "ad_account_id"))
    cap = cap_rows.groupBy("ad_account_id", "ad_account_name").agg(
        F.sum("amount_spent").alias("total_ad_spend"),
        F.sum("omni_purchase_value").alias("total_purchase_value"),
        F.sum("omni_purchase_purchases").alias("total_purchases"),
        F.sum("video_3_sec_watched_actions").alias("total_video_watches"),
        F.sum("impressions").alias("total_impressions"),
        F.countDistinct("ad_id").alias("total_ads"))
    cap = cap.select("ad_account_id", "ad_account_name", "total_ad_spend", "total_ads",
                     *_account_ratios())
    adp = apr.groupBy(F.col("ad_account_id").alias("_p_account")).agg(
        F.countDistinct("persona_attribute").alias("_unique_ad_personas"),
        F.count(F.lit(1)).alias("_ad_persona_mentions"))
    mapped_reviews = rpa.join(mra, "ad_account_id", "left_semi")
    personas_available = mapped_reviews.select(F.countDistinct("persona_attribute")).scalar()
    mentions_available = mapped_reviews.select(F.count(F.lit(1))).scalar()
    j = (cap.join(mca, cap.ad_account_id == F.col("_m_account"), "full")
         .join(adp, F.coalesce(cap.ad_account_id, F.col("_m_account")) == F.col("_p_account"),
               "left"))
    has_map = F.col("_m_account").isNotNull()
    spend = F.col("total_ad_spend")
    personas = F.coalesce(F.col("_unique_ad_personas"), F.lit(0))
    opportunity = (F.when(has_map & (spend > 0),
                          F.when(personas == 0, F.lit(100))
                          .otherwise(F.greatest(F.lit(0), 100 - F.col("_unique_ad_personas") * 10)))
                   .when(has_map, F.lit(90)).when(spend > 0, F.lit(20)).otherwise(F.lit(0)))
    tier = (F.when(F.col("account_roas") >= 3, "High Performer")
            .when(F.col("account_roas") >= 1.5, "Medium Performer")
            .when(F.col("account_roas") > 0, "Low Performer").otherwise("No Performance Data"))
    priority = (F.coalesce(F.col("_mapped_products"), F.lit(0)) * 10 +
                F.when(F.col("account_roas") >= 2, 50).otherwise(0) +
                F.least(spend.cast("double") / 1000, F.lit(50.0)) +
                F.when(personas == 0, 30).otherwise(0))
    out = j.select(
        F.coalesce(cap.ad_account_id, F.col("_m_account")).alias("cad_account_id"),
        F.coalesce(F.col("ad_account_name"), F.col("_m_name")).alias("cad_account_name"),
        F.when(has_map, "Has Review Mapping").otherwise("No Review Mapping").alias("mapping_status"),
        F.coalesce(F.col("_mapped_products"), F.lit(0)).alias("mapped_products"),
        F.coalesce(spend, F.lit(0)).alias("total_ad_spend"),
        F.coalesce(F.col("account_aov"), F.lit(0.0)).alias("account_aov"),
        F.coalesce(F.col("account_roas"), F.lit(0.0)).alias("account_roas"),
        F.coalesce(F.col("account_thumbstop_rate"), F.lit(0.0)).alias("account_thumbstop_rate"),
        F.coalesce(F.col("total_ads"), F.lit(0)).alias("total_ads"),
        personas.alias("unique_ad_personas"),
        F.coalesce(F.col("_ad_persona_mentions"), F.lit(0)).alias("total_ad_persona_mentions"),
        F.when(has_map, personas_available).otherwise(0).alias("review_personas_available"),
        F.when(has_map, mentions_available).otherwise(0).alias("total_review_mentions"),
        opportunity.alias("opportunity_score"), tier.alias("performance_tier"),
        priority.alias("priority_score"))
    if sort:
        out = out.orderBy(F.col("priority_score").desc_nulls_first(),
                          F.col("total_ad_spend").desc_nulls_first())
    return out


def review_account_summary(rpa: DataFrame) -> DataFrame:
    """DEAD-1: per review account, distinct personas, mentions, confidence,
    latest date and the sorted list of its distinct personas."""
    return rpa.groupBy(F.col("ad_account_id").alias("review_account_id")).agg(
        F.countDistinct("persona_attribute").alias("unique_personas"),
        F.count(F.lit(1)).alias("total_persona_mentions"),
        F.avg("confidence_score").alias("avg_confidence"),
        F.max("review_date").alias("latest_review_date"),
        F.array_join(F.sort_array(F.collect_set("persona_attribute")), ", ")
        .alias("sample_personas"))


def review_account_personas(rpa: DataFrame, part_rows: int = 1000) -> DataFrame:
    """DEAD-1's persona list for accounts of any size: one row for each part of at most ``part_rows`` personas.

    Distinct (account, persona) pairs are numbered in order across all tasks, and
    a part is a run of numbers, cut at account borders; so no task holds
    an account. An account's texts in the order of ``part``, joined by ', ', are
    the list of :func:`review_account_summary`.
    """
    pairs = (rpa.where(F.col("persona_attribute").isNotNull())
             .select(F.col("ad_account_id").alias("review_account_id"), "persona_attribute").distinct())
    numbered = global_row_number(pairs, [F.col("review_account_id").asc_nulls_first(), F.col("persona_attribute")], "_n")
    return (numbered.groupBy("review_account_id", F.floor((F.col("_n") - 1) / part_rows).alias("part"))
            .agg(F.count(F.lit(1)).alias("personas"),
                 F.array_join(F.sort_array(F.collect_list("persona_attribute")), ", ").alias("persona_list")))
