"""Staging: rename keys, add the source tag and the load time (STG-1..19).

Each staging model selects every raw column in order, renames primary and
foreign keys, and may append a constant ``source_system`` and ``loaded_at``.
One generic :func:`stage` driven by :data:`STAGING` replaces nineteen copies.
``loaded_at`` is a single run timestamp passed in by the caller, so every
model of one run agrees on it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StageSpec:
    renames: dict = field(default_factory=dict)
    source_system: str | None = None
    loaded_at: bool = True


# Raw column -> staged column name, per staging model.
STAGING: dict[str, StageSpec] = {
    "cad_ad_accounts": StageSpec(
        {"id": "ad_account_id", "ad_account_id": "meta_ad_account_id"}, loaded_at=False),
    "cad_campaigns_meta": StageSpec(
        {"id": "campaign_id", "campaign_meta_id": "meta_campaign_id",
         "ad_accounts_id": "ad_account_id"}),
    "cad_ad_set_meta": StageSpec(
        {"id": "ad_set_id", "campaigns_meta_id": "campaign_id",
         "ad_accounts_id": "ad_account_id"}),
    "cad_ads": StageSpec(
        {"id": "ad_id", "ad_meta_id": "meta_ad_id", "ad_accounts_id": "ad_account_id",
         "ad_set_meta_id": "ad_set_id"}),
    "cad_ads_meta": StageSpec({"id": "ads_meta_id"}),
    "cad_ads_creatives_meta": StageSpec(
        {"id": "ad_creative_id", "ad_creative_meta_id": "meta_ad_creative_id"}),
    "cad_ads_analysis": StageSpec(
        {"id": "ad_analysis_id", "ad_creative_meta_id": "ad_creative_id"}),
    "cad_creative_analysis": StageSpec({"id": "cad_creative_analysis_id"}),
    "cad_ads_insights_meta": StageSpec({"id": "ad_insights_id"}),
    "cad_unique_tags": StageSpec(
        {"id": "cad_unique_tag_id", "ad_accounts_id": "ad_account_id"}, "cad"),
    "cad_ad_tags": StageSpec(
        {"id": "cad_ad_tag_id", "unique_tags_id": "cad_unique_tag_id"}, "cad"),
    "cad_tag_clusters": StageSpec({"id": "cad_tag_cluster_id"}, "cad"),
    "cad_algorithm_tag_assign": StageSpec(
        {"id": "cad_algorithm_tag_assign_id", "unique_tags_id": "cad_unique_tag_id",
         "cluster_id": "cad_tag_cluster_id"}, "cad"),
    "review_reviews": StageSpec({"id": "review_id", "account_id": "ad_account_id"}),
    "review_ad_creative_analysis": StageSpec(
        {"id": "review_creative_analysis_id", "account_id": "ad_account_id"}),
    "review_unique_tags": StageSpec(
        {"id": "review_unique_tag_id", "account_id": "ad_account_id"}, "review"),
    "review_ad_tags": StageSpec(
        {"id": "review_ad_tag_id", "account_id": "ad_account_id",
         "tag_id": "review_unique_tag_id"}, "review"),
    "review_tag_clusters": StageSpec(
        {"id": "review_tag_cluster_id", "account_id": "ad_account_id"}, "review"),
    "review_algorithm_tag_assign": StageSpec(
        {"id": "review_algorithm_tag_assign_id", "account_id": "ad_account_id",
         "tag_id": "review_unique_tag_id", "cluster_id": "review_tag_cluster_id"}, "review"),
}

DEFAULT_AS_OF = "2025-01-01 00:00:00"


def run_timestamp(as_of: str = DEFAULT_AS_OF) -> Column:
    """The load time of one run, as a literal every model shares."""
    return F.lit(as_of).cast("timestamp")


def stage(df: DataFrame, spec: StageSpec, as_of: str = DEFAULT_AS_OF,
          keep: list[str] | None = None) -> DataFrame:
    """Project a raw table into its staging shape (a lazy view, no shuffle).

    ``keep`` names the raw columns that a model has; others an ingestion tool may add are left out.
    """
    cols = [F.col(c).alias(spec.renames.get(c, c)) for c in keep or df.columns]
    if spec.source_system is not None:
        cols.append(F.lit(spec.source_system).alias("source_system"))
    if spec.loaded_at:
        cols.append(run_timestamp(as_of).alias("loaded_at"))
    return df.select(*cols)

