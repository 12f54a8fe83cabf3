"""Documented report queries that are more than a filter on one model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def untargeted_review_personas(rpa: DataFrame, apa: DataFrame, insights: DataFrame,
                               min_roas: float = 2.0) -> DataFrame:
    """QRY-4: review personas that no ad with ROAS above ``min_roas`` targets.

    ``NOT IN (subquery)`` semantics: a persona is kept when it differs from
    every targeted persona; a NULL targeted persona makes the result empty,
    and a NULL review persona is kept only when nothing is targeted. Both
    sides are reduced before the joins (distinct ads, counts per persona),
    so no raw rows meet on a possibly hot key.
    """
    strong_ads = insights.where(F.col("roas") > min_roas).select("ads_meta_id").distinct()
    targeted = (apa.join(strong_ads, "ads_meta_id", "left_semi")
                .select("persona_attribute").distinct())
    no_null = targeted.select(F.count_if(F.col("persona_attribute").isNull()) == 0).scalar()
    nothing = targeted.select(F.count(F.lit(1)) == 0).scalar()
    counts = rpa.groupBy("persona_attribute").agg(F.count("review_id").alias("review_count"))
    return (counts.join(targeted, "persona_attribute", "left_anti")
            .where(nothing | (no_null & F.col("persona_attribute").isNotNull())))
