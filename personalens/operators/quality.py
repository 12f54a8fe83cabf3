"""Data-quality checks (DQ-1..4) and run-result summaries (DQ-5, DQ-6).

Each check returns offending rows or one row per tested column, never a
Python-side loop over data: the not-null check computes every column's NULL
count in one aggregate pass per model.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

# The schema tests of the model contracts, as (model, column).
UNIQUE_TESTS = [
    ("stg_cad_ad_accounts", "ad_account_id"), ("stg_cad_campaigns_meta", "campaign_id"),
    ("stg_cad_ad_set_meta", "ad_set_id"), ("stg_cad_ads", "ad_id"),
    ("stg_cad_ads_meta", "ads_meta_id"), ("stg_cad_ads_creatives_meta", "ad_creative_id"),
    ("stg_cad_ads_analysis", "ad_analysis_id"),
    ("stg_cad_creative_analysis", "cad_creative_analysis_id"),
    ("stg_cad_ads_insights_meta", "ad_insights_id"), ("stg_cad_unique_tags", "cad_unique_tag_id"),
    ("stg_cad_ad_tags", "cad_ad_tag_id"), ("stg_cad_tag_clusters", "cad_tag_cluster_id"),
    ("stg_cad_algorithm_tag_assign", "cad_algorithm_tag_assign_id"),
    ("stg_review_reviews", "review_id"),
    ("stg_review_ad_creative_analysis", "review_creative_analysis_id"),
    ("stg_review_unique_tags", "review_unique_tag_id"), ("stg_review_ad_tags", "review_ad_tag_id"),
    ("stg_review_tag_clusters", "review_tag_cluster_id"),
    ("stg_review_algorithm_tag_assign", "review_algorithm_tag_assign_id"),
]

NOT_NULL_TESTS = [(m, c) for m, c in UNIQUE_TESTS] + [
    ("stg_cad_campaigns_meta", "ad_account_id"),
    ("review_persona_attributes", "review_id"), ("review_persona_attributes", "ad_account_id"),
    ("review_persona_attributes", "persona_attribute"),
    ("review_value_propositions", "review_id"), ("review_value_propositions", "value_proposition"),
    ("review_problems", "review_id"), ("review_problems", "problem"),
    ("review_barriers", "review_id"), ("review_barriers", "barrier"),
    ("ad_persona_attributes", "ad_analysis_id"), ("ad_persona_attributes", "ads_meta_id"),
    ("ad_persona_attributes", "ad_account_id"), ("ad_persona_attributes", "persona_attribute"),
    ("ad_value_propositions", "ad_analysis_id"), ("ad_value_propositions", "value_proposition"),
    ("ad_problems", "ad_analysis_id"), ("ad_problems", "problem"),
    ("ad_barriers", "ad_analysis_id"), ("ad_barriers", "barrier"),
    ("unified_persona_attributes", "ad_account_id"),
    ("unified_persona_attributes", "persona_attribute"),
    ("unified_persona_attributes", "source_system"), ("unified_persona_attributes", "coverage_type"),
    ("cross_account_mapping", "cad_account_id"), ("cross_account_mapping", "persona_attribute"),
    ("cross_account_mapping", "persona_coverage"),
    ("scorecard", "ad_account_id"), ("scorecard", "persona_attribute"),
    ("scorecard", "performance_tier"),
    ("gap_analysis", "cad_account_id"), ("gap_analysis", "persona_attribute"),
    ("gap_analysis", "gap_priority"), ("gap_analysis", "gap_type"),
    ("gap_analysis", "recommendation"),
    ("review_ranking", "persona_name"), ("ad_performance", "persona_attribute"),
    ("opportunity_index", "persona_attribute"), ("opportunity_index", "opportunity_index"),
]

ACCEPTED_VALUES_TESTS = [
    ("unified_persona_attributes", "coverage_type", ["both", "review_only", "ad_only"]),
    ("gap_analysis", "gap_priority", ["critical", "high", "medium", "validation_needed", "low"]),
]


def unique_violations(df: DataFrame, column: str, model: str) -> DataFrame:
    """DQ-1: keys that occur more than once (NULL keys are not tested)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1)
            .select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                    F.col(column).cast("string").alias("value"), "n_rows"))


def _rows_where(condition: Column, copies: str | None) -> Column:
    """How many rows meet a condition, where a row counts as often as the column ``copies`` says."""
    return F.coalesce(F.sum(F.when(condition, F.col(copies))), F.lit(0)) if copies else F.count_if(condition)


def not_null_counts(df: DataFrame, columns: list[str], model: str, copies: str | None = None) -> DataFrame:
    """DQ-2: one row per tested column with its NULL count, from one pass.

    A tested column the model does not have is reported as
    ``missing_column`` (the contract check of DQ-4) instead of failing.
    """
    present = [c for c in columns if c in df.columns]
    missing = [c for c in columns if c not in df.columns]
    parts = []
    if present:
        counts = df.agg(*[_rows_where(F.col(c).isNull(), copies).alias(c) for c in present])
        parts.append(counts.unpivot([], present, "column_name", "null_rows")
                     .select(F.lit(model).alias("model"), "column_name",
                             F.col("null_rows").cast("long").alias("null_rows")))
    spark = df.sparkSession
    if missing:
        parts.append(spark.createDataFrame(
            [(model, c, None) for c in missing], "model string, column_name string, null_rows long"))
    out = reduce(DataFrame.unionByName, parts)
    status = (F.when(F.col("null_rows").isNull(), "missing_column")
              .when(F.col("null_rows") == 0, "pass").otherwise("fail"))
    return out.withColumn("status", status)


def not_null_status(null_rows: int | None) -> str:
    return "missing_column" if null_rows is None else "fail" if null_rows else "pass"


def write_observed(df: DataFrame, model: str, path: str) -> dict:
    """Write a model and return its row count and the figures of its schema tests (DQ-2, DQ-3), taken in the same pass.

    {"rows": n, "null_rows": {column: n, or None if the column is missing},
    "accepted": {column: [checked, failing]}}. Observed figures of a task that ran twice
    (a lost executor) may count rows twice: where the observed number of
    rows is not that of the files, the figures are taken from the files.
    """
    tested = [c for m, c in NOT_NULL_TESTS if m == model]
    accepted = [(c, v) for m, c, v in ACCEPTED_VALUES_TESTS if m == model and c in df.columns]
    present = [c for c in tested if c in df.columns]
    metrics = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in present]]
    for c, values in accepted:
        metrics += [F.count(F.col(c)).alias(f"checked {c}"),
                    F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(values)).alias(f"failing {c}")]
    seen = Observation(f"tests of {model}")
    df.observe(seen, *metrics).write.mode("overwrite").parquet(path)
    figures, written = seen.get, df.sparkSession.read.parquet(path)
    if figures["rows"] != written.count():
        figures = written.agg(*metrics).first().asDict()
    return {"rows": figures["rows"], "null_rows": {c: figures.get(f"null {c}") for c in tested},
            "accepted": {c: [figures[f"checked {c}"], figures[f"failing {c}"]] for c, _ in accepted}}


def accepted_values_violations(df: DataFrame, column: str, values: list[str],
                               model: str) -> DataFrame:
    """DQ-3: values outside the accepted list, with counts (NULL passes)."""
    return (df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                    F.col(column).cast("string").alias("value"), "n_rows"))


def accepted_values_counts(df: DataFrame, column: str, values: list[str], model: str) -> DataFrame:
    """DQ-3 as one row: how many values were looked at and how many fail (never an empty result)."""
    bad = F.col(column).isNotNull() & ~F.col(column).isin(values)
    return df.agg(F.count(column).alias("checked_rows"), F.count_if(bad).alias("failing_rows")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), "checked_rows", "failing_rows",
        F.when(F.col("failing_rows") == 0, "pass").otherwise("fail").alias("status"))


# The documented columns of each model.
DOCUMENTED_COLUMNS = {
    "review_persona_attributes": "review_id ad_account_id persona_attribute confidence_score source_system",
    "review_value_propositions": "review_id value_proposition importance_score sentiment",
    "review_problems": "review_id problem severity_score problem_category",
    "review_barriers": "review_id barrier impact_score barrier_type",
    "ad_persona_attributes": "ad_analysis_id ads_meta_id ad_account_id persona_attribute core_persona source_system",
    "ad_value_propositions": "ad_analysis_id value_proposition strength_score clarity_score",
    "ad_problems": "ad_analysis_id problem relevance_score urgency_score",
    "ad_barriers": "ad_analysis_id barrier solution_strength addressability_score",
    "unified_persona_attributes": "ad_account_id persona_attribute source_system coverage_type total_review_mentions total_ad_mentions",
    "cross_account_mapping": "cad_account_id review_account_id persona_attribute persona_coverage cad_persona_mentions "
                             "review_persona_mentions cross_system_alignment_score cad_account_name review_account_name",
    "scorecard": "ad_account_id persona_attribute performance_tier avg_roas avg_ctr total_spend composite_performance_score "
                 "gap_analysis_category opportunity_score review_mention_count persona_coverage cross_system_alignment_score "
                 "account_mapping_status review_account_name review_account_id",
    "gap_analysis": "cad_account_id persona_attribute gap_priority gap_type recommendation priority_score opportunity_level "
                    "review_count ad_count ad_account_name persona_coverage cross_system_alignment_score account_mapping_status "
                    "review_account_name review_account_id cross_system_account_summary priority_rank",
    "review_ranking": "persona_name account_name ad_account_id review_count percentage total_unique_reviews volume_category review_rank",
    "ad_performance": "persona_attribute ad_count total_ad_spend persona_mentions avg_confidence aov roas thumbstop_rate "
                      "total_purchase_value total_purchases total_video_watches total_impressions",
    "opportunity_index": "persona_attribute review_count review_percentage ad_count total_ad_spend raw_ratio opportunity_index "
                         "opportunity_color",
}
DOCUMENTED_COLUMNS = {m: c.split() for m, c in DOCUMENTED_COLUMNS.items()}


def contract_counts(df: DataFrame, documented: list[str] | None, model: str, copies: str | None = None) -> DataFrame:
    """DQ-4 with figures: one row per documented or produced column, its status and how many rows fill it, from one pass.

    present, missing (documented, not produced), undocumented (produced, not
    documented), or no_contract for every column of a model that has none.
    """
    produced = [c for c in df.columns if c != copies]
    counts = df.agg(*[_rows_where(F.col(c).isNotNull(), copies).alias(c) for c in produced]).unpivot([], produced, "column_name", "filled_rows")
    known = F.col("column_name").isin(documented or [])
    status = F.lit("no_contract") if documented is None else F.when(known, "present").otherwise("undocumented")
    out = counts.select(F.lit(model).alias("model"), "column_name", status.alias("status"), F.col("filled_rows").cast("long").alias("filled_rows"))
    missing = [(model, c, "missing", None) for c in documented or [] if c not in produced]
    if missing:
        out = out.unionByName(df.sparkSession.createDataFrame(
            missing, "model string, column_name string, status string, filled_rows long"))
    return out


def column_contract(spark: SparkSession, df: DataFrame, documented: list[str],
                    model: str) -> DataFrame:
    """DQ-4: documented columns the model lacks and produced columns the
    contract does not list (schema metadata only, no data is read)."""
    rows = ([(model, c, "missing") for c in documented if c not in df.columns] +
            [(model, c, "undocumented") for c in df.columns if c not in documented])
    return spark.createDataFrame(rows, "model string, column_name string, status string")


# ------------------------------------------------------------ run results

RESULT_SCHEMA = ("metadata struct<generated_at:string, invocation_id:string>, "
                 "results array<struct<unique_id:string, status:string, execution_time:double, "
                 "message:string, failures:long>>")


def read_run_documents(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Run-result documents as (run_id, results, bad_text): one a file, or one a line with ``lines``.

    A document that is no JSON or doesn't have the declared types keeps its
    text in bad_text and has no results; it never stops the others.
    """
    docs = spark.read.schema(f"{RESULT_SCHEMA}, _bad string").option("multiLine", not lines).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", "_bad").json(path)
    good = F.col("_bad").isNull()
    run = F.coalesce(F.col("metadata.invocation_id"), F.col("metadata.generated_at"))
    return docs.select(F.when(good, run).alias("run_id"), F.when(good, F.col("results")).alias("results"), F.col("_bad").alias("bad_text"))


def read_run_results(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per result of the readable documents."""
    docs = read_run_documents(spark, path, lines).where(F.col("bad_text").isNull())
    return docs.select("run_id", F.explode("results").alias("r")).select("run_id", "r.*")


def document_counts(documents: DataFrame) -> DataFrame:
    """Per run the readable documents and their results; unreadable documents have no run and are counted under NULL."""
    return documents.groupBy("run_id").agg(
        F.count_if(F.col("bad_text").isNull()).alias("good_documents"), F.count_if(F.col("bad_text").isNotNull()).alias("bad_documents"),
        F.sum(F.coalesce(F.size("results"), F.lit(0))).alias("total_models"),
        F.sum(F.coalesce(F.size(F.filter("results", lambda r: r["status"] == "error")), F.lit(0))).alias("failed"))


def run_summary(results: DataFrame) -> DataFrame:
    """DQ-5: per run, total / successful / failed counts and a status line."""
    s = F.col("status")
    out = results.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_models"),
        F.count_if(s == "success").alias("successful"),
        F.count_if(s == "error").alias("failed"),
        F.sum(F.coalesce(F.col("failures"), F.lit(0))).alias("test_failures"),
        F.sum("execution_time").alias("total_execution_time"))
    return out.select(
        "*", (F.col("successful") / F.col("total_models")).alias("success_rate"),
        F.when(F.col("failed") == 0, "all models succeeded")
        .otherwise(F.concat(F.col("failed").cast("string"), F.lit(" model(s) failed")))
        .alias("run_status"))


def failed_models(results: DataFrame) -> DataFrame:
    """The failed results of each run, as rows."""
    return results.where(F.col("status") == "error").select("run_id", "unique_id", "message")


def slowest_models(results: DataFrame, k: int = 5) -> DataFrame:
    """DQ-6: the k slowest models of each run (a per-run top-k; Spark limits
    each run's candidates on the map side before the shuffle)."""
    w = Window.partitionBy("run_id").orderBy(F.col("execution_time").desc_nulls_last(),
                                             F.col("unique_id").asc_nulls_last())
    return (results.select("run_id", "unique_id", "status", "execution_time",
                           F.row_number().over(w).alias("slow_rank"))
            .where(F.col("slow_rank") <= k))
