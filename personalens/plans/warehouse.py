"""All models of one run, built lazily over a set of raw tables.

``Warehouse`` wires staging and every model together (the reference's
``ref()`` graph) as plain attribute access. Catalyst plans each report as one
query over the raw scans. Models named in ``materialize`` are written when
they are first used, and the global rank of GAP-3 writes its ranges;
everything else runs with the action. ``build_all`` is the full rebuild.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from personalens.operators import gaps, mapping, normalize, quality, reports, scorecard
from personalens.plans.staging import DEFAULT_AS_OF, STAGING, stage
from personalens.session import checkpoint_dir
from personalens.sources.store import Folder, VersionedTables
from personalens.sources.tpch_binding import DriverTables, LazyTables, raw_columns


class Warehouse:
    """Models over one set of raw tables.

    ``materialize`` names models that a job reads more than once: each is
    written as parquet under the shared checkpoint folder the first time it
    is used and read back from there, so the JSON parsing and joins behind it
    run once instead of once per use, and a lost executor re-reads files
    instead of recomputing lineage.
    """

    def __init__(self, raw: dict[str, DataFrame], as_of: str = DEFAULT_AS_OF,
                 materialize: tuple[str, ...] = ()):
        self.raw = raw
        self.as_of = as_of
        self.materialize = set(materialize)
        self._run = uuid.uuid4().hex
        self.stg = LazyTables(
            lambda name: stage(raw[name[4:]], STAGING[name[4:]], as_of, raw_columns(name[4:])),
            [f"stg_{n}" for n in STAGING])

    @property
    def seed(self) -> DataFrame:
        return self.raw["seed_mapping"]

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF,
                           materialize: tuple[str, ...] = ()) -> "Warehouse":
        return cls(DriverTables(spark, sf_dir).raw_tables(), as_of, materialize)

    def _m(self, name: str, df: DataFrame) -> DataFrame:
        if name not in self.materialize:
            return df
        spark = df.sparkSession
        path = f"{self._scratch(spark)}/{name}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    def _scratch(self, spark: SparkSession) -> str:
        return f"{checkpoint_dir(spark).rstrip('/')}/models/{self._run}"

    def _s(self, name: str) -> DataFrame:
        return self.stg[f"stg_{name}"]

    # ---------------------------------------------------------- staged
    @property
    def ad_accounts(self):
        return self._s("cad_ad_accounts")

    @property
    def ads(self):
        return self._s("cad_ads")

    @property
    def ads_meta(self):
        return self._s("cad_ads_meta")

    @property
    def ads_analysis(self):
        return self._s("cad_ads_analysis")

    @property
    def creative_analysis(self):
        return self._s("cad_creative_analysis")

    @property
    def insights(self):
        return self._s("cad_ads_insights_meta")

    @property
    def reviews(self):
        return self._s("review_reviews")

    @property
    def review_analysis(self):
        return self._s("review_ad_creative_analysis")

    def _ad_inputs(self):
        return self.creative_analysis, self.ads_analysis, self.ads_meta, self.ads

    # ---------------------------------------------------------- normalized
    @cached_property
    def review_persona_attributes(self) -> DataFrame:
        return self._m("review_persona_attributes", normalize.review_persona_attributes(self.reviews, self.review_analysis))

    @cached_property
    def review_value_propositions(self) -> DataFrame:
        return self._m("review_value_propositions", normalize.review_value_propositions(self.reviews))

    @cached_property
    def review_problems(self) -> DataFrame:
        return self._m("review_problems", normalize.review_problems(self.reviews))

    @cached_property
    def review_barriers(self) -> DataFrame:
        return self._m("review_barriers", normalize.review_barriers(self.reviews))

    @cached_property
    def ad_persona_attributes(self) -> DataFrame:
        return self._m("ad_persona_attributes", normalize.ad_persona_attributes(*self._ad_inputs()))

    @cached_property
    def ad_value_propositions(self) -> DataFrame:
        return self._m("ad_value_propositions", normalize.ad_value_propositions(*self._ad_inputs()))

    @cached_property
    def ad_problems(self) -> DataFrame:
        return self._m("ad_problems", normalize.ad_problems(*self._ad_inputs()))

    @cached_property
    def ad_barriers(self) -> DataFrame:
        return self._m("ad_barriers", normalize.ad_barriers(*self._ad_inputs()))

    @cached_property
    def ad_personas_from_review_analysis(self) -> DataFrame:
        return self._m("ad_personas_from_review_analysis", normalize.ad_persona_attributes_from_review_analysis(self.review_analysis))

    # ---------------------------------------------------------- reports
    @cached_property
    def unified_persona_attributes(self) -> DataFrame:
        return self._m("unified_persona_attributes", reports.unified_persona_attributes(
            self.review_persona_attributes, self.ad_persona_attributes, self.as_of))

    @cached_property
    def review_ranking(self) -> DataFrame:
        return self._m("review_ranking", reports.review_ranking(self.review_persona_attributes, self.ad_accounts))

    @cached_property
    def ad_performance(self) -> DataFrame:
        return self._m("ad_performance", reports.persona_ad_performance(
            self.ad_personas_from_review_analysis, self.ads_meta, self.insights))

    @cached_property
    def opportunity_index(self) -> DataFrame:
        return self._m("opportunity_index", reports.opportunity_index(self.review_persona_attributes, self.ad_performance))

    @cached_property
    def cross_account_mapping(self) -> DataFrame:
        return self._m("cross_account_mapping", mapping.cross_account_persona_mapping(
            self.ad_persona_attributes, self.review_persona_attributes, self.seed, self.as_of))

    def counted_mapping(self) -> DataFrame:
        """The cross-account mapping with equal rows counted (see mapping.counted_mapping)."""
        return mapping.counted_mapping(self.ad_persona_attributes, self.review_persona_attributes, self.seed, self.as_of)

    @cached_property
    def scorecard_tiers(self) -> DataFrame:
        return scorecard.add_performance_tiers(scorecard.persona_performance_metrics(
            self.ad_persona_attributes, self.insights))

    @cached_property
    def scorecard(self) -> DataFrame:
        return self._m("scorecard", scorecard.persona_performance_scorecard(
            self.ad_persona_attributes, self.insights, self._mapped_ads(),
            self.review_persona_attributes, self.as_of))

    def _mapped_ads(self) -> DataFrame:
        """The ad side of the cross-account mapping, which is all a reader of ads can match."""
        return mapping.cross_account_persona_mapping(
            self.ad_persona_attributes, self.review_persona_attributes, self.seed, self.as_of, review_only=False)

    @cached_property
    def gap_analysis(self) -> DataFrame:
        return self._m("gap_analysis", gaps.persona_gap_analysis(
            self.review_persona_attributes, self.scorecard, self.ad_accounts, self.as_of))

    @cached_property
    def gap_analysis_simple(self) -> DataFrame:
        return self._m("gap_analysis_simple", gaps.persona_gap_analysis_simple(
            self.review_persona_attributes, self.ad_persona_attributes, self.ad_accounts,
            self.as_of))

    @cached_property
    def cross_system_analysis(self) -> DataFrame:
        return self._m("cross_system_analysis", gaps.persona_cross_system_analysis(
            self.seed, self.review_persona_attributes, self.ad_personas_from_review_analysis,
            self.insights, self.ads_meta, self.ads))

    def counted_cross_system(self) -> DataFrame:
        """The cross-system analysis with equal rows counted (see gaps.counted_cross_system)."""
        return gaps.counted_cross_system(
            self.seed, self.review_persona_attributes, self.ad_personas_from_review_analysis,
            self.insights, self.ads_meta, self.ads)

    @cached_property
    def account_opportunities(self) -> DataFrame:
        return self._m("account_opportunities", gaps.account_level_opportunities(
            self.seed, self.review_persona_attributes, self.ad_personas_from_review_analysis,
            self.insights, self.ads_meta, self.ads, self.ad_accounts))

    @cached_property
    def review_account_summary(self) -> DataFrame:
        return self._m("review_account_summary", gaps.review_account_summary(self.review_persona_attributes))

    # ---------------------------------------------------------- sinks
    # Dependency order of the intermediate layer (each model after its inputs).
    BUILD_ORDER = (
        "review_persona_attributes", "review_value_propositions", "review_problems",
        "review_barriers", "ad_persona_attributes", "ad_value_propositions", "ad_problems",
        "ad_barriers", "ad_personas_from_review_analysis", "unified_persona_attributes",
        "review_ranking", "ad_performance", "opportunity_index", "cross_account_mapping",
        "scorecard", "gap_analysis", "gap_analysis_simple", "cross_system_analysis",
        "account_opportunities",
    )

    def persist(self, name: str, path: str | None = None) -> DataFrame:
        """Write one model as parquet (to ``path`` or below the checkpoint
        folder) and use the written copy from then on."""
        df = getattr(self, name)
        path = path or f"{self._scratch(df.sparkSession)}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.use(name, df.sparkSession.read.parquet(path))

    def use(self, name: str, df: DataFrame) -> DataFrame:
        """Let later models read df as the model ``name``."""
        self.__dict__[name] = df
        return df

    def build_all(self, target: str, models: tuple[str, ...] | None = None, version: str | None = None,
                  keep: int = 1) -> "BuildReport":
        """Full rebuild of the intermediate layer (the reference's run) that may fail at any point without harm.

        Every model is written to a folder of its own version in dependency
        order, later models read the written ones, and readers are switched to the
        version when all are there (see sources/store.py). Building a version
        again reuses the models that were finished, so a version's name stands
        for its inputs; names sort by age. Without a name the newest version
        that was begun after the current one is taken up, else a new one is
        named by the clock. Null and accepted-value counts are observed while
        a model is written. ``keep`` older versions stay, all others are
        removed after the switch.
        """
        names = list(models or self.BUILD_ORDER)
        spark = self._spark()
        tables = VersionedTables(spark, target)
        version = version or tables.unfinished() or f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}"
        done, reused = tables.done(version), []
        for name in names:
            path = tables.path(version, name)
            if name in done:
                reused.append(name)
                self.use(name, spark.read.parquet(path))
                continue
            notes = quality.write_observed(getattr(self, name), name, path)
            tables.finish(version, name, notes)
            self.use(name, spark.read.parquet(path))
        tables.switch(version, names)
        removed = tables.remove_superseded(keep)
        notes = tables.done(version)
        return BuildReport(version, {n: tables.path(version, n) for n in names}, reused, removed,
                           {n: notes[n] for n in names})

    def _spark(self) -> SparkSession:
        return self.seed.sparkSession

    def close(self) -> None:
        """Remove what this warehouse wrote below the checkpoint folder; its materialized models can't be read any more."""
        spark = self._spark()
        folder = Folder(spark, self._scratch(spark))
        if folder.exists(""):
            folder.remove("")


@dataclass
class BuildReport:
    """What a rebuild did: paths by model, models taken over from an earlier attempt, removed versions, observed figures."""

    version: str
    paths: dict[str, str]
    reused: list[str]
    removed: list[str]
    observed: dict[str, dict]

    def not_null(self) -> list[tuple]:
        """(model, column_name, null_rows, status) as dq_not_null gives them for these models."""
        return [(m, c, n, quality.not_null_status(n)) for m, x in self.observed.items() for c, n in x["null_rows"].items()]

    def accepted_values(self) -> list[tuple]:
        """(model, column_name, checked_rows, failing_rows, status) as dq_accepted_values gives them."""
        return [(m, c, n, bad, "fail" if bad else "pass") for m, x in self.observed.items() for c, (n, bad) in x["accepted"].items()]
