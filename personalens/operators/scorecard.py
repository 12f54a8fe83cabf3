"""Persona performance scorecard (SCORE-1)."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from personalens.functions.numeric import bucketize
from personalens.plans.staging import DEFAULT_AS_OF, run_timestamp

# Tier thresholds and labels of the scorecard.
ROAS_TIERS = [(3.0, "high_performer"), (1.5, "medium_performer"), (0.5, "low_performer")]
CTR_TIERS = [(2.0, "high_engagement"), (1.0, "medium_engagement"), (0.5, "low_engagement")]
SPEND_TIERS = [(10000, "high_spend"), (5000, "medium_spend"), (1000, "low_spend")]
# composite = 0.4 roas + 0.3 * (10 ctr) + 0.2 thumbstop + 0.1 retention
COMPOSITE_WEIGHTS = (0.4, 0.3, 0.2, 0.1)
CTR_SCALE = 10


_AVG_METRICS = ["roas", "ctr", "cpc", "thumbstop", "retention", "frequency"]
_SUM_METRICS = {"amount_spent": "total_spend", "impressions": "total_impressions",
                "reach": "total_reach", "click": "total_clicks"}
_MEDIAN_METRICS = ["roas", "ctr", "cpc"]
_GROUP = ["ad_account_id", "persona_attribute", "persona_value"]


def persona_performance_metrics(apa: DataFrame, insights: DataFrame) -> DataFrame:
    """Per (ad account, persona, value): counts, ROAS / CTR / CPC statistics,
    volume sums, engagement averages, confidence and latest load.

    The report's grain is every ad persona row joined to every insight row
    (with a ROAS) of its ads_meta. That product is never stored or shuffled:

    * insights are summed per ads_meta (sums, non-NULL counts, max / min),
      persona rows counted per (group, ads_meta, core persona), and each
      joined pair contributes ``multiplicity x ad totals``;
    * medians are selected in two passes over the insights (:func:`group_medians`).

    Only hash aggregates on pre-reduced rows remain; a hot account or persona
    is split across map-side partial aggregates. Groups with a NULL value or
    account keep their medians (their number counts NULL as a value).
    """
    ins = insights.where(F.col("roas").isNotNull())
    per_ad = ins.groupBy("ads_meta_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(m).alias(f"_s_{m}") for m in _AVG_METRICS],
        *[F.count(m).alias(f"_c_{m}") for m in _AVG_METRICS],
        *[F.sum(m).alias(f"_s_{m}") for m in _SUM_METRICS],
        F.max("roas").alias("max_roas"), F.min("roas").alias("min_roas"),
        F.max("ctr").alias("max_ctr"))
    persona_ads = apa.groupBy(*_GROUP, "ads_meta_id", "core_persona").agg(
        F.count(F.lit(1)).alias("_m"),
        F.sum("confidence_score").alias("_conf_s"),
        F.count("confidence_score").alias("_conf_c"),
        F.max("loaded_at").alias("_latest"))
    j = persona_ads.join(per_ad, "ads_meta_id")
    m = F.col("_m")
    metrics = j.groupBy(*_GROUP).agg(
        F.countDistinct("ads_meta_id").alias("ad_count"),
        F.countDistinct("core_persona").alias("core_persona_count"),
        *[(F.sum(m * F.col(f"_s_{x}")).cast("double") / F.sum(m * F.col(f"_c_{x}")))
          .alias(f"avg_{x}") for x in _AVG_METRICS],
        *[F.sum(m * F.col(f"_s_{x}")).alias(out) for x, out in _SUM_METRICS.items()],
        F.max("max_roas").alias("max_roas"), F.min("min_roas").alias("min_roas"),
        F.max("max_ctr").alias("max_ctr"),
        (F.sum(F.col("_conf_s") * F.col("_rows")).cast("double") /
         F.sum(F.col("_conf_c") * F.col("_rows"))).alias("avg_confidence_score"),
        F.max("_latest").alias("latest_data_date"))

    multiplicity = persona_ads.groupBy(*_GROUP, "ads_meta_id").agg(F.sum("_m").alias("_m"))
    medians = group_medians(multiplicity, ins)
    out = metrics.select("*", *group_number()).join(medians, ["_group_a", "_group_b"], "left")
    return out.select(
        *_GROUP, "ad_count", "core_persona_count", "avg_roas", "median_roas", "max_roas",
        "min_roas", "avg_ctr", "median_ctr", "max_ctr", "avg_cpc", "median_cpc", "total_spend",
        "total_impressions", "total_reach", "total_clicks", "avg_thumbstop", "avg_retention",
        "avg_frequency", "avg_confidence_score", "latest_data_date")


#: Bins of a doubling of a metric's value in the first pass of the median selection.
BINS_PER_DOUBLING = 8


def group_medians(multiplicity: DataFrame, ins: DataFrame) -> DataFrame:
    """Exact medians per group, ``_group_*`` (see :func:`group_number`) and ``median_*``.

    A group's number of persona rows of an ad weighs each insight of the ad; equal persona rows
    are never repeated. Pass 1 weighs bins of the values per group; a fold over a
    group's bins finds those that hold its two middle values. Pass 2 keeps only
    the values in those bins and selects by cumulative weight. Both
    passes join insights to ads as they stream, from one shuffle of the insights by ad, and aggregate
    before anything else is shuffled. Bins are fixed by the value
    itself, so nothing runs while the plan is built; a group has as many bins as
    its values have magnitudes, and pass 2 spills as a sort.
    """
    ads = multiplicity.select(*group_number(), "ads_meta_id", "_m")
    # Both passes compute bins above the join, so that they need the same columns below it.
    metrics = range(len(_MEDIAN_METRICS))
    values = ins.select("ads_meta_id", *[F.col(m).cast("double").alias(f"_x{i}") for i, m in enumerate(_MEDIAN_METRICS)])
    group = ["_group_a", "_group_b", "metric"]
    weight = F.sum("_m").alias("_w")
    stacked = ads.join(values, "ads_meta_id").select("_group_a", "_group_b", "_m", F.posexplode(F.array(*[f"_x{i}" for i in metrics])).alias("metric", "x"))
    per_bin = stacked.where(F.col("x").isNotNull()).groupBy(*group, _bin(F.col("x")).alias("bin")).agg(weight)
    per_group = per_bin.groupBy(*group).agg(F.sum("_w").alias("_n"), F.sort_array(F.collect_list(F.struct("bin", "_w"))).alias("_bins"))
    low, high = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)  # ranks of the two middle values, from 0
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.array().cast("array<struct<bin:int,before:bigint>>").alias("held"))

    def step(state: Column, entry: Column) -> Column:
        after = state["seen"] + entry["_w"]
        holds = functools.reduce(Column.__or__, [(r >= state["seen"]) & (r < after) for r in (low, high)])
        held = F.array(F.struct(entry["bin"].alias("bin"), state["seen"].alias("before")))
        return F.struct(after.alias("seen"), F.when(holds, F.concat(state["held"], held)).otherwise(state["held"]).alias("held"))

    middle = F.aggregate("_bins", start, step, lambda state: state["held"])
    wanted = per_group.select(*group, "_n", F.inline(middle))
    # A group's one or two bins of each metric, side by side.
    sought = wanted.groupBy("_group_a", "_group_b").agg(*[
        f(F.when(F.col("metric") == i, F.col("bin"))).alias(f"_{n}{i}") for i in metrics for n, f in (("low", F.min), ("high", F.max))])
    hit = [F.when((bin := _bin(F.col(f"_x{i}"))).isin(F.col(f"_low{i}"), F.col(f"_high{i}")), F.struct(F.col(f"_x{i}").alias("x"), bin.alias("bin")))
           for i in metrics]
    hits = (ads.join(sought, ["_group_a", "_group_b"]).join(values, "ads_meta_id")
            .select("_group_a", "_group_b", "_m", F.posexplode(F.array(*hit)).alias("metric", "_hit"))
            .where(F.col("_hit").isNotNull()))
    weighed = hits.groupBy(*group, "_hit.bin", "_hit.x").agg(weight).join(wanted, [*group, "bin"])
    inside = Window.partitionBy(*group, "bin").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    weighed = weighed.withColumn("_from", F.col("before") + F.coalesce(F.sum("_w").over(inside), F.lit(0)))
    here = [(r >= F.col("_from")) & (r < F.col("_from") + F.col("_w")) for r in (low, high)]
    medians = weighed.groupBy(*group).agg(functools.reduce(Column.__add__, [F.max(F.when(h, F.col("x"))) for h in here]).alias("_twice"))
    return medians.groupBy("_group_a", "_group_b").agg(*[
        F.max(F.when(F.col("metric") == i, F.col("_twice") / 2)).alias(f"median_{x}") for i, x in enumerate(_MEDIAN_METRICS)])


def group_number() -> list[Column]:
    """A group's 128-bit number, from two hashes of its keys; NULL keys count as values of their own."""
    keys = [x for c in _GROUP for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(*keys).alias("_group_a"), F.xxhash64(F.lit(1), *keys).alias("_group_b")]


def _bin(x: Column) -> Column:
    """A whole number that grows with x: its sign and its magnitude in steps of 1 / BINS_PER_DOUBLING doublings."""
    size = F.floor(F.ln(F.abs(x)) * (BINS_PER_DOUBLING / math.log(2))) + 1100 * BINS_PER_DOUBLING  # above 0 for the smallest double
    return F.when(x > 0, size).when(x < 0, -size).otherwise(F.lit(0)).cast("int")


def persona_performance_metrics_direct(apa: DataFrame, insights: DataFrame) -> DataFrame:
    """The same metrics over the explicit persona x insight product (for tests)."""
    ins = insights.where(F.col("roas").isNotNull()).select(
        "ads_meta_id", "roas", "ctr", "cpc", "amount_spent", "impressions", "reach", "click",
        "thumbstop", "retention", "frequency")
    rows = apa.select(*_GROUP, "confidence_score", "ads_meta_id", "core_persona",
                      "loaded_at").join(ins, "ads_meta_id")
    med = {x: F.percentile(F.col(x).cast("double"), F.lit(0.5)) for x in _MEDIAN_METRICS}
    return rows.groupBy(*_GROUP).agg(
        F.countDistinct("ads_meta_id").alias("ad_count"),
        F.countDistinct("core_persona").alias("core_persona_count"),
        F.avg("roas").alias("avg_roas"), med["roas"].alias("median_roas"),
        F.max("roas").alias("max_roas"), F.min("roas").alias("min_roas"),
        F.avg("ctr").alias("avg_ctr"), med["ctr"].alias("median_ctr"),
        F.max("ctr").alias("max_ctr"),
        F.avg("cpc").alias("avg_cpc"), med["cpc"].alias("median_cpc"),
        *[F.sum(x).alias(out) for x, out in _SUM_METRICS.items()],
        F.avg("thumbstop").alias("avg_thumbstop"), F.avg("retention").alias("avg_retention"),
        F.avg("frequency").alias("avg_frequency"),
        F.avg("confidence_score").alias("avg_confidence_score"),
        F.max("loaded_at").alias("latest_data_date"))


def add_performance_tiers(metrics: DataFrame) -> DataFrame:
    """ROAS, CTR and spend tiers, the combined tier and the composite score.

    NULL metrics fall to the lowest tier; a NULL input makes the composite NULL.
    """
    roas_tier = bucketize(F.col("avg_roas"), ROAS_TIERS, "poor_performer")
    ctr_tier = bucketize(F.col("avg_ctr"), CTR_TIERS, "poor_engagement")
    spend_tier = bucketize(F.col("total_spend"), SPEND_TIERS, "minimal_spend")
    out = metrics.select("*", roas_tier.alias("roas_tier"), ctr_tier.alias("ctr_tier"),
                         spend_tier.alias("spend_tier"))
    r, c = F.col("roas_tier"), F.col("ctr_tier")
    overall = (F.when((r == "high_performer") & c.isin("high_engagement", "medium_engagement"),
                      "top_performer")
               .when((r == "high_performer") | ((r == "medium_performer") & (c == "high_engagement")),
                     "strong_performer")
               .when(r == "medium_performer", "moderate_performer")
               .when(r == "low_performer", "weak_performer")
               .otherwise("poor_performer"))
    w_roas, w_ctr, w_thumb, w_ret = COMPOSITE_WEIGHTS
    composite = (F.col("avg_roas") * w_roas + F.col("avg_ctr") * CTR_SCALE * w_ctr +
                 F.col("avg_thumbstop") * w_thumb + F.col("avg_retention") * w_ret)
    return out.select("*", overall.alias("performance_tier"),
                      composite.cast("double").alias("composite_performance_score"))


def direct_review_context(rpa: DataFrame) -> DataFrame:
    return rpa.groupBy("ad_account_id", "persona_attribute").agg(
        F.countDistinct("review_id").alias("_drc_mentions"),
        F.avg("confidence_score").alias("_drc_conf"),
        F.max("review_date").alias("_drc_date"))


def persona_performance_scorecard(apa: DataFrame, insights: DataFrame, mapping: DataFrame,
                                  rpa: DataFrame, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """SCORE-1: metrics and tiers per (account, persona, value), with review
    context from the cross-account mapping, or from the account's own reviews
    when the mapping has nothing for that (account, persona)."""
    ps = add_performance_tiers(persona_performance_metrics(apa, insights))
    carc = mapping.select(
        F.col("cad_account_id").alias("_carc_account"),
        F.col("persona_attribute").alias("_carc_persona"),
        "review_persona_mentions", "avg_review_confidence", "latest_review_mention",
        "persona_coverage", "cross_system_alignment_score", "review_account_name",
        "review_account_id")
    drc = direct_review_context(rpa).select(
        F.col("ad_account_id").alias("_drc_account"),
        F.col("persona_attribute").alias("_drc_persona"), "_drc_mentions", "_drc_conf",
        "_drc_date")
    joined = (ps.join(carc, (ps.ad_account_id == F.col("_carc_account")) &
                      (ps.persona_attribute == F.col("_carc_persona")), "left")
              .join(drc, (F.col("ad_account_id") == F.col("_drc_account")) &
                    (F.col("persona_attribute") == F.col("_drc_persona")) &
                    F.col("_carc_account").isNull(), "left"))
    mentions = F.coalesce(F.col("review_persona_mentions"), F.col("_drc_mentions"), F.lit(0))
    tier = F.col("performance_tier")
    poor = tier.isin("poor_performer", "weak_performer")
    good = tier.isin("top_performer", "strong_performer")
    moderate = tier == "moderate_performer"
    no_ads = F.col("ad_count") == 0
    has = mentions > 0
    aligned = F.col("cross_system_alignment_score") > 0
    category = (F.when(has & poor, "underperforming_persona")
                .when(has & good, "well_served_persona")
                .when(has & moderate, "opportunity_persona")
                .when(has & no_ads, "unaddressed_persona")
                .otherwise("unknown_persona"))
    score = (F.when(has & poor, mentions * 10 * F.when(aligned, 1.5).otherwise(1.0))
             .when(has & moderate, mentions * 5 * F.when(aligned, 1.3).otherwise(1.0))
             .when(has & no_ads, mentions * 15 * F.when(aligned, 2.0).otherwise(1.0))
             .otherwise(0.0))
    return joined.select(
        *[F.col(c) for c in ps.columns],
        mentions.alias("review_mention_count"),
        F.coalesce(F.col("avg_review_confidence").cast("double"),
                   F.col("_drc_conf").cast("double")).alias("avg_review_confidence"),
        F.coalesce(F.col("latest_review_mention"), F.col("_drc_date")).alias("latest_review_date"),
        "persona_coverage", "cross_system_alignment_score", "review_account_name",
        "review_account_id",
        F.when(F.col("_carc_account").isNotNull(), "mapped_account")
        .otherwise("unmapped_account").alias("account_mapping_status"),
        category.alias("gap_analysis_category"),
        score.cast("double").alias("opportunity_score"),
        run_timestamp(as_of).alias("loaded_at"))
