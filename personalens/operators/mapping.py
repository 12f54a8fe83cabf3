"""Cross-account persona mapping (MAP-1).

Ad accounts and review accounts are numbered independently; the product
mapping table links them. Ad personas meet the mapping on the ad account,
review personas on the review account, and the two sides meet on
(ad account, persona).

The report counts mentions *after* joining to the mapping rows, so counts are
multiplied by the number of mapping rows (and, for summed review counts, by
that number twice). :func:`cross_account_persona_mapping` reproduces those
numbers exactly from per-key counts instead of windows over the fanned-out
rows: with n = mentions of a key, m_a = mapping rows of ad account a, m_r =
mapping rows of review account r and m_ra = mapping rows linking both,

  cad_persona_mentions    = n_c(a, p) * m_a
  review_persona_mentions = sum over r of n_r(r, p) * m_ra * n_r(r, p) * m_r.

Only the review-only branch emits one row per mention and mapping row, as the
report does. :func:`cross_account_persona_mapping_windows` is the direct form,
kept to check the fast one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from personalens.functions.numeric import NUMERIC
from personalens.operators.expand import repeat_rows
from personalens.plans.staging import DEFAULT_AS_OF, run_timestamp

OUTPUT_COLUMNS = [
    "cad_account_id", "cad_account_name", "review_account_id", "review_account_name",
    "persona_attribute", "cad_persona_mentions", "cad_ads_with_persona", "avg_cad_confidence",
    "review_persona_mentions", "review_count_with_persona", "avg_review_confidence",
    "latest_review_mention", "persona_coverage", "cross_system_alignment_score", "loaded_at",
]


def mapped_accounts(seed: DataFrame) -> DataFrame:
    """Mapping rows that name a review account."""
    return (seed.where(F.col("review_account_id").isNotNull())
            .select(F.col("ad_account_id").alias("cad_account_id"),
                    F.col("ad_account_name").alias("cad_account_name"),
                    "review_account_name", "review_account_id"))


def _score_both(cad_m, rev_m, cad_c, rev_c):
    return ((cad_m + F.coalesce(rev_m, F.lit(0))) *
            (F.coalesce(cad_c.cast("double"), F.lit(0.0)) + F.coalesce(rev_c.cast("double"), F.lit(0.0))) / 2)


def _finish(cad_rows: DataFrame, review_only: DataFrame, as_of: str, extra: tuple[str, ...] = ()) -> DataFrame:
    return (cad_rows.unionByName(review_only)
            .withColumn("loaded_at", run_timestamp(as_of))
            .select(*OUTPUT_COLUMNS, *extra))


def _cad_rows(cad: DataFrame, review_side: DataFrame) -> DataFrame:
    """Attach the per-(ad account, persona) review summary and score."""
    matched = F.col("_matched").isNotNull()
    score = F.when(matched, _score_both(F.col("cad_persona_mentions"),
                                        F.col("_rev_mentions"), F.col("avg_cad_confidence"),
                                        F.col("avg_review_confidence")))
    score = score.otherwise(F.col("cad_persona_mentions") *
                            F.coalesce(F.col("avg_cad_confidence").cast("double"), F.lit(0.0)) * 0.5)
    return (cad.join(review_side, ["cad_account_id", "persona_attribute"], "left")
            .select("cad_account_id", "cad_account_name", "review_account_id",
                    "review_account_name", "persona_attribute",
                    F.col("cad_persona_mentions").cast("long").alias("cad_persona_mentions"),
                    F.col("cad_ads_with_persona").cast("long").alias("cad_ads_with_persona"),
                    F.col("avg_cad_confidence").cast(NUMERIC).alias("avg_cad_confidence"),
                    F.coalesce("_rev_mentions", F.lit(0)).cast("long").alias("review_persona_mentions"),
                    F.coalesce("_rev_count", F.lit(0)).cast("long").alias("review_count_with_persona"),
                    F.col("avg_review_confidence").cast("double").alias("avg_review_confidence"),
                    F.col("_rev_date").cast("date").alias("latest_review_mention"),
                    F.when(matched, "found_in_both").otherwise("cad_only").alias("persona_coverage"),
                    score.cast("double").alias("cross_system_alignment_score")))


def _review_only_rows(rows: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """rows: of review mentions and mapping rows, with n/nn already multiplied."""
    return rows.select(
        "cad_account_id", "cad_account_name", "review_account_id", "review_account_name",
        "persona_attribute", F.lit(0).cast("long").alias("cad_persona_mentions"),
        F.lit(0).cast("long").alias("cad_ads_with_persona"),
        F.lit(None).cast(NUMERIC).alias("avg_cad_confidence"),
        F.col("review_persona_mentions").cast("long").alias("review_persona_mentions"),
        F.col("review_count_with_persona").cast("long").alias("review_count_with_persona"),
        F.col("confidence_score").cast("double").alias("avg_review_confidence"),
        F.col("review_date").cast("date").alias("latest_review_mention"),
        F.lit("review_only").alias("persona_coverage"),
        (F.col("review_persona_mentions") * F.col("confidence_score").cast("double") * 0.3)
        .cast("double").alias("cross_system_alignment_score"), *extra)


#: Column of :func:`counted_mapping`: how often the report has a row.
COPIES = "_copies"


def cross_account_persona_mapping(apa: DataFrame, rpa: DataFrame, seed: DataFrame,
                                  as_of: str = DEFAULT_AS_OF, review_only: bool = True) -> DataFrame:
    """MAP-1 from per-key counts (no window over the fan-out).

    Without ``review_only`` the rows of personas that have no ads are left out:
    readers that start from ads can't match them, and need not expand them.
    """
    counted = counted_mapping(apa, rpa, seed, as_of, review_only)
    return expand_mapping(counted) if review_only else counted.drop(COPIES)


def expand_mapping(counted: DataFrame) -> DataFrame:
    """The report's rows of :func:`counted_mapping`: each as often as it counts."""
    return repeat_rows(counted, COPIES)


def counted_mapping(apa: DataFrame, rpa: DataFrame, seed: DataFrame,
                    as_of: str = DEFAULT_AS_OF, review_only: bool = True) -> DataFrame:
    """MAP-1 with equal rows counted in ``_copies``.

    The report has a review-only row for each pair of a mention and a mapping row, which
    grows with the product of the two; this form grows with the different ones.
    """
    mt = mapped_accounts(seed)
    m_a = mt.groupBy("cad_account_id").agg(F.count(F.lit(1)).alias("m_a"))
    m_r = mt.groupBy("review_account_id").agg(F.count(F.lit(1)).alias("m_r"))
    m_ra = mt.groupBy("review_account_id", "cad_account_id").agg(F.count(F.lit(1)).alias("m_ra"))
    seed_attrs = mt.select("cad_account_id", "cad_account_name", "review_account_id",
                           "review_account_name").distinct()

    # --- ad side: (a, p) counts, distinct confidences, mapping attributes
    cad_counts = (apa.groupBy(F.col("ad_account_id").alias("cad_account_id"), "persona_attribute")
                  .agg(F.count(F.lit(1)).alias("_n"), F.count("ads_meta_id").alias("_nn"))
                  .join(m_a, "cad_account_id"))
    cad_conf = (apa.select(F.col("ad_account_id").alias("cad_account_id"), "persona_attribute",
                           F.col("confidence_score").alias("avg_cad_confidence")).distinct())
    cad = (cad_counts.join(cad_conf, ["cad_account_id", "persona_attribute"])
           .join(seed_attrs, "cad_account_id")
           .select("cad_account_id", "cad_account_name", "review_account_id",
                   "review_account_name", "persona_attribute", "avg_cad_confidence",
                   (F.col("_n") * F.col("m_a")).alias("cad_persona_mentions"),
                   (F.col("_nn") * F.col("m_a")).alias("cad_ads_with_persona")))

    # --- review side: (r, p) counts, then per (a, p) through the mapping
    rev_counts = rpa.groupBy(F.col("ad_account_id").alias("review_account_id"),
                             "persona_attribute").agg(
        F.count(F.lit(1)).alias("_n"), F.count("review_id").alias("_nn"),
        F.sum("confidence_score").alias("_cs"), F.count("confidence_score").alias("_cn"),
        F.max("review_date").alias("_md"))
    rev_counts = rev_counts.join(m_r, "review_account_id")
    per_a = rev_counts.join(m_ra, "review_account_id")
    w = F.col("_n") * F.col("m_ra")
    review_side = per_a.groupBy("cad_account_id", "persona_attribute").agg(
        F.sum(w * F.col("_n") * F.col("m_r")).alias("_rev_mentions"),
        F.sum(w * F.col("_nn") * F.col("m_r")).alias("_rev_count"),
        (F.sum(F.col("_cs") * F.col("m_ra")) / F.sum(F.col("_cn") * F.col("m_ra")))
        .alias("avg_review_confidence"),
        F.max("_md").alias("_rev_date"),
        F.lit(1).alias("_matched"))
    # rows are unique per (a, mapping attributes, p, confidence): no distinct needed
    cad_rows = _cad_rows(cad, review_side)
    if not review_only:
        return cad_rows.withColumn("loaded_at", run_timestamp(as_of)).select(*OUTPUT_COLUMNS, F.lit(1).cast("long").alias(COPIES))

    # --- review-only rows: every (mention, mapping row) whose (a, p) has no ads.
    # The rows carry no review id and no product, so mentions equal in (r, p, confidence, date)
    # and mapping rows equal in accounts and names are counted first; every join below runs on aggregates, and
    # the copies are emitted at the end in bounded chunks (a hot key is spread, not joined).
    cad_keys = cad_counts.select("cad_account_id", "persona_attribute")
    same_rows = rpa.groupBy(F.col("ad_account_id").alias("review_account_id"),
                            "persona_attribute", "confidence_score", "review_date").agg(
        F.count(F.lit(1)).alias("_mentions"))
    links = mt.groupBy(*mt.columns).agg(F.count(F.lit(1)).alias("_links"))
    only = (same_rows
            .join(rev_counts.select("review_account_id", "persona_attribute",
                                    (F.col("_n") * F.col("m_r")).alias("review_persona_mentions"),
                                    (F.col("_nn") * F.col("m_r")).alias("review_count_with_persona")),
                  ["review_account_id", "persona_attribute"])
            .join(links, "review_account_id")
            .join(cad_keys, ["cad_account_id", "persona_attribute"], "left_anti")
            .withColumn(COPIES, F.col("_mentions") * F.col("_links")))
    return _finish(cad_rows.withColumn(COPIES, F.lit(1).cast("long")), _review_only_rows(only, (COPIES,)), as_of, (COPIES,))


def cross_account_persona_mapping_windows(apa: DataFrame, rpa: DataFrame, seed: DataFrame,
                                          as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """MAP-1 written as the report states it: windows over the joined rows.

    Quadratic in mapping rows and one task per (account, persona) window;
    used only to check :func:`cross_account_persona_mapping` on small data.
    """
    mt = mapped_accounts(seed)
    by_ad = Window.partitionBy("cad_account_id", "persona_attribute")
    cad = (apa.join(mt, F.col("ad_account_id") == F.col("cad_account_id"))
           .select("cad_account_id", "cad_account_name", "review_account_id",
                   "review_account_name", "persona_attribute",
                   F.col("confidence_score").alias("avg_cad_confidence"),
                   F.count(F.lit(1)).over(by_ad).alias("cad_persona_mentions"),
                   F.count("ads_meta_id").over(by_ad).alias("cad_ads_with_persona")))
    by_rev = Window.partitionBy("ad_account_id", "persona_attribute")
    rev = (rpa.join(mt, F.col("ad_account_id") == mt.review_account_id)
           .select(F.col("ad_account_id").alias("_orig"), "persona_attribute",
                   "confidence_score", "review_date", "cad_account_id", "cad_account_name",
                   "review_account_name",
                   F.count(F.lit(1)).over(by_rev).alias("review_persona_mentions"),
                   F.count("review_id").over(by_rev).alias("review_count_with_persona")))
    review_side = rev.groupBy("cad_account_id", "persona_attribute").agg(
        F.sum("review_persona_mentions").alias("_rev_mentions"),
        F.sum("review_count_with_persona").alias("_rev_count"),
        F.avg("confidence_score").alias("avg_review_confidence"),
        F.max("review_date").alias("_rev_date"),
        F.lit(1).alias("_matched"))
    cad_rows = _cad_rows(cad, review_side).distinct()
    only = (rev.join(cad.select("cad_account_id", "persona_attribute"),
                     ["cad_account_id", "persona_attribute"], "left_anti")
            .withColumnRenamed("_orig", "review_account_id"))
    return _finish(cad_rows, _review_only_rows(only), as_of)
