"""Persona reports: unified coverage (AGG-1), review ranking (AGG-2, Report 1),
ad performance (AGG-3, Report 2) and opportunity index (AGG-4, Report 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from personalens.functions.numeric import bucketize, safe_ratio
from personalens.plans.staging import DEFAULT_AS_OF, run_timestamp


def unified_persona_attributes(rpa: DataFrame, apa: DataFrame,
                               as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """AGG-1: review and ad personas side by side with a per-(account, persona)
    summary and a coverage type (both / review_only / ad_only)."""
    keys = ["ad_account_id", "persona_attribute", "persona_value", "confidence_score",
            "source_system"]
    reviews = rpa.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("mention_count"),
        F.countDistinct("review_id").alias("review_count"),
        F.avg("confidence_score").alias("avg_confidence_score"),
        F.max("review_date").cast("timestamp").alias("latest_mention_date"),
        F.min("review_date").cast("timestamp").alias("earliest_mention_date"))
    ads = apa.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("mention_count"),
        F.countDistinct("ads_meta_id").alias("ad_count"),
        F.avg("confidence_score").alias("avg_confidence_score"),
        F.max("loaded_at").alias("latest_mention_date"),
        F.min("loaded_at").alias("earliest_mention_date"))
    common = keys + ["mention_count"]
    tail = ["avg_confidence_score", "latest_mention_date", "earliest_mention_date"]
    unified = (reviews.select(*common, F.col("review_count").alias("entity_count"), *tail,
                              "review_count", F.lit(None).cast("long").alias("ad_count"))
               .unionByName(ads.select(*common, F.col("ad_count").alias("entity_count"), *tail,
                                       F.lit(None).cast("long").alias("review_count"),
                                       "ad_count")))
    is_rev = F.col("source_system") == "review"
    is_ad = F.col("source_system") == "cad"
    rev_mentions = F.sum(F.when(is_rev, F.col("mention_count")).otherwise(0))
    ad_mentions = F.sum(F.when(is_ad, F.col("mention_count")).otherwise(0))
    summary = unified.groupBy("ad_account_id", "persona_attribute").agg(
        F.countDistinct(F.when(is_rev, F.col("persona_value"))).alias("review_variations"),
        F.countDistinct(F.when(is_ad, F.col("persona_value"))).alias("ad_variations"),
        rev_mentions.alias("total_review_mentions"),
        ad_mentions.alias("total_ad_mentions"),
        F.avg(F.when(is_rev, F.col("avg_confidence_score"))).alias("avg_review_confidence"),
        F.avg(F.when(is_ad, F.col("avg_confidence_score"))).alias("avg_ad_confidence"),
        F.max(F.when(is_rev, F.col("latest_mention_date"))).alias("latest_review_mention"),
        F.max(F.when(is_ad, F.col("latest_mention_date"))).alias("latest_ad_mention"))
    summary = summary.withColumn(
        "coverage_type",
        F.when((F.col("total_review_mentions") > 0) & (F.col("total_ad_mentions") > 0), "both")
        .when(F.col("total_review_mentions") > 0, "review_only")
        .otherwise("ad_only"))
    return (unified.join(summary, ["ad_account_id", "persona_attribute"])
            .withColumn("loaded_at", run_timestamp(as_of)))


# Share-of-reviews thresholds of the review ranking report.
VOLUME_TIERS = [(5.0, "High Volume"), (2.0, "Medium Volume"), (1.0, "Low Volume")]


def review_ranking(rpa: DataFrame, ad_accounts: DataFrame, sort: bool = False) -> DataFrame:
    """AGG-2 (Report 1): personas per account ranked by mention count.

    ``total_unique_reviews`` is the account's mention count (the name is kept
    from the report). Account names come from a left join on the platform id
    cast to a number, which may match several accounts; the rank is over the
    joined rows. It is taken from the number of personas per (account, review
    count): no window or task holds an account's personas.
    """
    counts = (rpa.where(F.col("ad_account_id").isNotNull())
              .groupBy("persona_attribute", "ad_account_id")
              .agg(F.count(F.lit(1)).alias("review_count")))
    names = ad_accounts.select(
        F.col("meta_ad_account_id").try_cast("long").alias("_platform_id"), "ad_account_name")
    matches = names.where(F.col("_platform_id").isNotNull()).groupBy("_platform_id").agg(F.count(F.lit(1)).alias("_names"))
    levels = counts.groupBy("ad_account_id", "review_count").agg(F.count(F.lit(1)).alias("_personas"))
    levels = levels.join(matches, F.col("ad_account_id") == F.col("_platform_id"), "left").drop("_platform_id")
    account = Window.partitionBy("ad_account_id")
    above = account.orderBy(F.col("review_count").desc()).rowsBetween(Window.unboundedPreceding, -1)
    levels = levels.select(
        "ad_account_id", "review_count",
        F.sum(F.col("_personas") * F.col("review_count")).over(account).alias("total_unique_reviews"),
        (1 + F.coalesce(F.col("_names"), F.lit(1)) * F.coalesce(F.sum("_personas").over(above), F.lit(0)))
        .alias("review_rank"))
    ranked = counts.join(levels, ["ad_account_id", "review_count"])
    pct = F.col("review_count") * 100.0 / F.col("total_unique_reviews")
    out = (ranked.join(names, F.col("ad_account_id") == F.col("_platform_id"), "left")
           .select(F.col("persona_attribute").alias("persona_name"),
                   F.col("ad_account_name").alias("account_name"), "ad_account_id",
                   "review_count", pct.cast("double").alias("percentage"),
                   "total_unique_reviews",
                   bucketize(pct, VOLUME_TIERS, "Minimal Volume").alias("volume_category"),
                   "review_rank"))
    if sort:
        out = out.orderBy(F.col("ad_account_id").asc_nulls_last(),
                          F.col("review_count").desc_nulls_first(),
                          F.col("persona_name").asc_nulls_last())
    return out


INSIGHT_SUMS = {
    "amount_spent": "total_ad_spend",
    "omni_purchase_value": "total_purchase_value",
    "omni_purchase_purchases": "total_purchases",
    "video_3_sec_watched_actions": "total_video_watches",
    "impressions": "total_impressions",
}


def insight_totals_per_ad(insights: DataFrame) -> DataFrame:
    """Sum the daily insight rows of each ads_meta once, before any join.

    Insights are by far the largest table; collapsing them to one row per
    ads_meta_id (a partial + final hash aggregate) shrinks every later join.
    ``insight_rows`` keeps the row count so fan-out sums stay exact.
    """
    return insights.groupBy("ads_meta_id").agg(
        F.count(F.lit(1)).alias("insight_rows"),
        *[F.sum(c).alias(c) for c in INSIGHT_SUMS])


def persona_ad_performance(apr: DataFrame, ads_meta: DataFrame, insights: DataFrame,
                           sort: bool = False) -> DataFrame:
    """AGG-3 (Report 2): spend and return per persona of the analysed ads.

    Same result as joining every persona row to every insight row of its ad
    and aggregating, computed without building that product: personas are
    counted per (ad, persona), insights summed per ads_meta, and each joined
    pair contributes ``mentions x ad totals``.
    """
    per_ad = apr.groupBy("ad_id", "persona_attribute").agg(
        F.count(F.lit(1)).alias("_m"),
        F.sum("confidence_score").alias("_conf_sum"),
        F.count("confidence_score").alias("_conf_n"))
    totals = insight_totals_per_ad(insights)
    joined = (per_ad.join(ads_meta.select("ad_id", "ads_meta_id"), "ad_id")
              .join(totals, "ads_meta_id"))
    m = F.col("_m")
    n = F.col("insight_rows")
    agg = joined.groupBy("persona_attribute").agg(
        F.countDistinct("ads_meta_id").alias("ad_count"),
        *[F.sum(m * F.col(c)).alias(out) for c, out in INSIGHT_SUMS.items()],
        (F.sum(F.col("_conf_sum") * n) / F.sum(F.col("_conf_n") * n)).alias("avg_confidence"),
        F.sum(m * n).alias("persona_mentions"))
    out = agg.select(
        "persona_attribute", "ad_count", "total_ad_spend", "persona_mentions", "avg_confidence",
        safe_ratio(F.col("total_purchase_value"), F.col("total_purchases")).alias("aov"),
        safe_ratio(F.col("total_purchase_value"), F.col("total_ad_spend")).alias("roas"),
        safe_ratio(F.col("total_video_watches"), F.col("total_impressions")).alias("thumbstop_rate"),
        "total_purchase_value", "total_purchases", "total_video_watches", "total_impressions")
    if sort:
        out = out.orderBy(F.col("total_ad_spend").desc_nulls_first())
    return out


UNSERVED_RATIO = 999999.0

# Opportunity index colour scale (lower bound, colour).
OPPORTUNITY_COLOURS = [
    (90, "#059669"), (80, "#10b981"), (70, "#34d399"), (60, "#86efac"), (50, "#bef264"),
    (40, "#facc15"), (30, "#fb923c"), (20, "#f97316"), (10, "#ef4444"), (5, "#dc2626"),
]
LOWEST_COLOUR = "#991b1b"


def opportunity_index(rpa: DataFrame, ad_performance: DataFrame, sort: bool = False) -> DataFrame:
    """AGG-4 (Report 3): review mentions per unit of ad spend, scaled to 0-100.

    Review counts per persona meet ad spend per persona in a full outer join
    on lower(trim(persona)). The grand total and the min / max of finite
    positive ratios are scalar subqueries (one-row aggregates Spark runs once
    and inlines), not windows over a single partition.
    """
    reviews = rpa.groupBy("persona_attribute").agg(F.count(F.lit(1)).alias("review_count"))
    grand_total = reviews.select(F.sum("review_count")).scalar()
    reviews = reviews.select(
        F.col("persona_attribute").alias("_rp"), "review_count",
        (F.col("review_count") * 100.0 / grand_total).cast("double").alias("review_percentage"),
        F.lower(F.trim("persona_attribute")).alias("_rkey"))
    ads = ad_performance.select(
        F.col("persona_attribute").alias("_ap"), "ad_count", "total_ad_spend",
        F.lower(F.trim("persona_attribute")).alias("_akey"))
    combined = reviews.join(ads, F.col("_rkey") == F.col("_akey"), "full").select(
        F.coalesce("_rp", "_ap").alias("persona_attribute"),
        F.coalesce("review_count", F.lit(0)).alias("review_count"),
        F.coalesce("review_percentage", F.lit(0.0)).alias("review_percentage"),
        F.coalesce("ad_count", F.lit(0)).alias("ad_count"),
        F.coalesce(F.col("total_ad_spend"), F.lit(0)).alias("total_ad_spend"))
    spend = F.col("total_ad_spend")
    ratios = combined.withColumn(
        "raw_ratio",
        F.when(spend > 0, F.col("review_count").cast("double") / spend.cast("double"))
        .when(F.col("review_count") > 0, F.lit(UNSERVED_RATIO))
        .otherwise(F.lit(0.0)))
    finite = ratios.where((F.col("raw_ratio") > 0) & (F.col("raw_ratio") < UNSERVED_RATIO))
    lo = finite.select(F.min("raw_ratio")).scalar()
    hi = finite.select(F.max("raw_ratio")).scalar()
    r = F.col("raw_ratio")
    index = (F.when(r >= UNSERVED_RATIO, F.lit(100.0))
             .when(hi > lo, (r - lo) / (hi - lo) * 99)
             .otherwise(F.lit(50.0)))
    out = (ratios.withColumn("opportunity_index", index)
           .withColumn("opportunity_color",
                       bucketize(F.col("opportunity_index"), OPPORTUNITY_COLOURS, LOWEST_COLOUR)))
    if sort:
        out = out.orderBy(F.col("opportunity_index").desc_nulls_first(),
                          F.col("review_count").desc_nulls_first())
    return out
