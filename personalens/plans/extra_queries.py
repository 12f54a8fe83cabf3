"""Queries beyond the model tables: documented reports (QRY-1..4),
data-quality checks (DQ-1..3), run summaries (DQ-5, DQ-6), change-tracking
snapshots (SCD-1) and the CSV mapping-table load (SRC-3).

Each has a Spark builder over the driver tables and an independent SQL check.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from personalens.operators import documented, gaps, quality, snapshots
from personalens.plans import duck_checks as D
from personalens.plans.staging import STAGING
from personalens.plans.warehouse import Warehouse
from personalens.session import checkpoint_dir
from personalens.sources import io
from personalens.sources.tpch_binding import BINDINGS, DriverTables


def _wh(spark, sf_dir, query: str = ""):
    from personalens.plans.warehouse import Warehouse
    return Warehouse.from_driver_tables(spark, sf_dir,
                                        materialize=_registry().REUSE.get(query, ()))


def _registry():
    from personalens.plans import registry
    return registry


def _model(wh, name: str) -> DataFrame:
    if name.startswith("stg_"):
        return wh.stg[name]
    return getattr(wh, _registry().MODEL_ATTR[name])


def _counted_model(wh, name: str) -> tuple[DataFrame, str | None]:
    """A model, or its counted form and the column that counts equal rows."""
    column, counted, _ = _registry().COUNTED.get(name, (None, None, None))
    return (counted(wh), column) if column else (_model(wh, name), None)


def _one_by_one(spark, figures) -> DataFrame:
    """Rows of many small results. Each is worked out by a job of its own and written
    to the shared folder: a single plan of all models takes the driver's memory."""
    path, schema = f"{checkpoint_dir(spark).rstrip('/')}/figures/{uuid.uuid4().hex}", None
    for df in figures:
        df.coalesce(1).write.mode("append").parquet(path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path)


def _model_columns(name: str) -> list[str]:
    if name.startswith("stg_"):
        raw = name[4:]
        spec = STAGING[raw]
        cols = [spec.renames.get(e.rsplit(" as ", 1)[1].strip(), e.rsplit(" as ", 1)[1].strip())
                for e in BINDINGS[raw][1]]
        return cols + (["source_system"] if spec.source_system else []) + \
            (["loaded_at"] if spec.loaded_at else [])
    return [c for c, _ in _registry()._spec(_registry().SPECS[name][0])]


def _model_cte(name: str) -> str:
    return name if name.startswith("stg_") else _registry().SPECS[name][1]


def _q(build, spec_text, sql_body=None):
    reg = _registry()
    spec = reg._spec(spec_text)
    if sql_body is None:
        return reg.Query(build, spec)
    return _SqlQuery(build, spec, sql_body)


class _SqlQuery:
    """A query whose check is a custom SELECT over the shared CTEs."""

    def __init__(self, build, spec, body):
        self.build, self.spec, self.body = build, spec, body

    def run(self, spark, sf_dir):
        return _registry().conform(self.build(spark, sf_dir), self.spec)

    def sql(self):
        return D.select_sql(f"({self.body}) q", self.spec)


# ------------------------------------------------------------ documented reports

def critical_gaps(spark, sf_dir):
    """QRY-1: critical persona gaps, highest priority first."""
    g = _wh(spark, sf_dir, "critical_gaps").gap_analysis
    return (g.where(F.col("gap_priority") == "critical")
            .select("ad_account_name", "persona_attribute", "gap_type", "review_count",
                    "recommendation", "priority_score")
            .orderBy(F.col("priority_score").desc_nulls_first()))


def top_opportunities(spark, sf_dir):
    """QRY-2: critical / high gaps with a high opportunity level."""
    g = _wh(spark, sf_dir, "top_opportunities").gap_analysis
    return (g.where(F.col("gap_priority").isin("critical", "high") &
                    (F.col("opportunity_level") == "high_opportunity"))
            .orderBy(F.col("priority_score").desc_nulls_first())
            .select("persona_attribute", "gap_type", "review_count", "ad_count", "avg_roas",
                    "opportunity_level", "recommendation"))


def review_only_personas(spark, sf_dir):
    """QRY-3: personas only reviews mention, at least three times."""
    u = _wh(spark, sf_dir).unified_persona_attributes
    return (u.where((F.col("coverage_type") == "review_only") &
                    (F.col("total_review_mentions") >= 3))
            .select("persona_attribute", "coverage_type", "total_review_mentions",
                    "total_ad_mentions", "avg_review_confidence", "avg_ad_confidence")
            .orderBy(F.col("total_review_mentions").desc_nulls_first()))


def untargeted_review_personas(spark, sf_dir, min_roas: float = 2.0):
    """QRY-4: review personas not targeted by any ad with ROAS above ``min_roas``."""
    wh = _wh(spark, sf_dir)
    return (documented.untargeted_review_personas(
        wh.review_persona_attributes, wh.ad_persona_attributes, wh.insights, min_roas)
        .orderBy(F.col("review_count").desc_nulls_first()))


# ------------------------------------------------------------ data quality

def dq_unique(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    parts = [quality.unique_violations(_model(wh, m), c, m) for m, c in quality.UNIQUE_TESTS]
    return reduce(DataFrame.unionByName, parts)


def dq_not_null(spark, sf_dir):
    wh = _wh(spark, sf_dir, "dq_not_null")
    by_model: dict[str, list[str]] = {}
    for m, c in quality.NOT_NULL_TESTS:
        by_model.setdefault(m, []).append(c)
    counted = ((m, cols, *_counted_model(wh, m)) for m, cols in by_model.items())
    return _one_by_one(spark, (quality.not_null_counts(df, cols, m, copies) for m, cols, df, copies in counted))


def dq_accepted_values(spark, sf_dir):
    wh = _wh(spark, sf_dir, "dq_accepted_values")
    parts = [quality.accepted_values_counts(_model(wh, m), c, v, m)
             for m, c, v in quality.ACCEPTED_VALUES_TESTS]
    return reduce(DataFrame.unionByName, parts)


#: Models without documented columns (quirk Q-18).
NO_CONTRACT = ("ad_personas_from_review_analysis", "gap_analysis_simple", "cross_system_analysis", "account_opportunities")


def dq_column_contract(spark, sf_dir):
    wh = _wh(spark, sf_dir, "dq_not_null")
    counted = ((m, *_counted_model(wh, m)) for m in (*quality.DOCUMENTED_COLUMNS, *NO_CONTRACT))
    return _one_by_one(spark, (quality.contract_counts(df, quality.DOCUMENTED_COLUMNS.get(m), m, copies) for m, df, copies in counted))


def _contract_sql() -> str:
    parts = []
    for m in (*quality.DOCUMENTED_COLUMNS, *NO_CONTRACT):
        documented, produced = quality.DOCUMENTED_COLUMNS.get(m), _model_columns(m)
        for c in produced:
            status = "no_contract" if documented is None else "present" if c in documented else "undocumented"
            parts.append(f"SELECT '{m}' AS model, '{c}' AS column_name, '{status}' AS status, count({c}) AS filled_rows FROM {_model_cte(m)}")
        parts += [f"SELECT '{m}', '{c}', 'missing', CAST(NULL AS BIGINT)" for c in documented or [] if c not in produced]
    return " UNION ALL ".join(parts)


def dq_observed(spark, sf_dir):
    """DQ-2 and DQ-3 as they are observed while a rebuild writes its models: the whole intermediate layer."""
    target = f"{checkpoint_dir(spark).rstrip('/')}/rebuild/{uuid.uuid4().hex}"
    report = Warehouse.from_driver_tables(spark, sf_dir).build_all(target)
    rows = [(m, c, "not_null", x, s) for m, c, x, s in report.not_null()]
    rows += [(m, c, "accepted_values", bad, s) for m, c, _, bad, s in report.accepted_values()]
    return spark.createDataFrame(rows, "model string, column_name string, test string, failing_rows long, status string")


def _dq_observed_sql() -> str:
    models = ", ".join(f"'{m}'" for m in Warehouse.BUILD_ORDER)
    return (f"SELECT model, column_name, 'not_null' AS test, null_rows AS failing_rows, status FROM ({_dq_not_null_sql()}) n WHERE model IN ({models}) "
            f"UNION ALL SELECT model, column_name, 'accepted_values', failing_rows, status FROM ({_dq_accepted_sql()}) a WHERE model IN ({models})")


def _dq_unique_sql() -> str:
    parts = [f"SELECT '{m}' AS model, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, "
             f"count(*) AS n_rows FROM {_model_cte(m)} WHERE {c} IS NOT NULL GROUP BY {c} "
             f"HAVING count(*) > 1" for m, c in quality.UNIQUE_TESTS]
    return " UNION ALL ".join(parts)


def _dq_not_null_sql() -> str:
    parts = []
    for m, c in quality.NOT_NULL_TESTS:
        if c in _model_columns(m):
            parts.append(f"SELECT '{m}' AS model, '{c}' AS column_name, "
                         f"count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM {_model_cte(m)}")
        else:
            parts.append(f"SELECT '{m}' AS model, '{c}' AS column_name, "
                         "CAST(NULL AS BIGINT) AS null_rows")
    body = " UNION ALL ".join(parts)
    return (f"SELECT *, CASE WHEN null_rows IS NULL THEN 'missing_column' WHEN null_rows = 0 "
            f"THEN 'pass' ELSE 'fail' END AS status FROM ({body}) t")


def _dq_accepted_sql() -> str:
    parts = []
    for m, c, values in quality.ACCEPTED_VALUES_TESTS:
        vals = ", ".join(f"'{v}'" for v in values)
        parts.append(f"SELECT '{m}' AS model, '{c}' AS column_name, count({c}) AS checked_rows, "
                     f"count(*) FILTER (WHERE {c} NOT IN ({vals})) AS failing_rows FROM {_model_cte(m)}")
    body = " UNION ALL ".join(parts)
    return f"SELECT *, CASE WHEN failing_rows = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({body}) t"


# ------------------------------------------------------------ run results

# One daily run per event date; each event is one model result.
RUN_RESULTS = [
    "cast(cast(ts as date) as string) as run_id",
    "'model.' || event_type || '_' || cast(user_id % 20 as string) as unique_id",
    "case when event_type = 'error' then 'error' when value < 1 then 'skipped' "
    "else 'success' end as status",
    "value as execution_time",
    "event_type as message",
    "case when event_type = 'error' then cast(1 as bigint) else cast(0 as bigint) end as failures",
]
_RUN_RESULTS_SQL = f"SELECT {', '.join(RUN_RESULTS)} FROM events"


def _run_results(spark, sf_dir) -> DataFrame:
    return DriverTables(spark, sf_dir).table("events").selectExpr(*RUN_RESULTS)


def run_summary(spark, sf_dir):
    return quality.run_summary(_run_results(spark, sf_dir))


def failed_models(spark, sf_dir):
    return quality.failed_models(_run_results(spark, sf_dir))


def slow_models(spark, sf_dir):
    return quality.slowest_models(_run_results(spark, sf_dir), 5)


#: Results a run-result document holds at most; every seventh document is cut off in the middle.
DOCUMENT_RESULTS, CUT_EVERY = 200, 7


def run_result_files(spark, sf_dir):
    """DQ-5 over files: run-result documents written as JSON, some of them cut off, then read by their reader."""
    events = DriverTables(spark, sf_dir).table("events")
    part = F.floor(F.col("event_id") / DOCUMENT_RESULTS).alias("part")
    results = events.selectExpr("event_id", *RUN_RESULTS).withColumn("part", part)
    docs = results.groupBy("run_id", "part").agg(F.collect_list(F.struct("unique_id", "status", "execution_time", "message", "failures")).alias("results"))
    text = F.to_json(F.struct(F.struct(F.lit("t").alias("generated_at"), F.col("run_id").alias("invocation_id")).alias("metadata"), "results"))
    cut = F.when(F.col("part") % CUT_EVERY == 3, F.expr("substring(value, 1, length(value) - 20)")).otherwise(F.col("value"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/run_results/{uuid.uuid4().hex}"
    docs.select("part", text.alias("value")).select(cut.alias("value")).write.text(path)
    return quality.document_counts(quality.read_run_documents(spark, path, lines=True))


_RUN_FILES_SQL = f"""
SELECT CASE WHEN part % {CUT_EVERY} = 3 THEN NULL ELSE run_id END AS run_id, count(*) FILTER (WHERE part % {CUT_EVERY} <> 3) AS good_documents,
       count(*) FILTER (WHERE part % {CUT_EVERY} = 3) AS bad_documents,
       sum(CASE WHEN part % {CUT_EVERY} = 3 THEN 0 ELSE n END) AS total_models, sum(CASE WHEN part % {CUT_EVERY} = 3 THEN 0 ELSE bad END) AS failed
FROM (SELECT run_id, event_id // {DOCUMENT_RESULTS} AS part, count(*) AS n, count(*) FILTER (WHERE status = 'error') AS bad
      FROM (SELECT event_id, {', '.join(RUN_RESULTS)} FROM events) r GROUP BY ALL) d GROUP BY 1"""

_RUN_SUMMARY_SQL = f"""
SELECT *, CAST(successful AS DOUBLE) / total_models AS success_rate,
       CASE WHEN failed = 0 THEN 'all models succeeded'
            ELSE CAST(failed AS VARCHAR) || ' model(s) failed' END AS run_status
FROM (SELECT run_id, count(*) AS total_models,
             count(*) FILTER (WHERE status = 'success') AS successful,
             count(*) FILTER (WHERE status = 'error') AS failed,
             sum(coalesce(failures, 0)) AS test_failures,
             sum(execution_time) AS total_execution_time
      FROM ({_RUN_RESULTS_SQL}) r GROUP BY run_id) s"""

_SLOW_SQL = f"""
SELECT * FROM (
  SELECT run_id, unique_id, status, execution_time,
         row_number() OVER (PARTITION BY run_id ORDER BY execution_time DESC NULLS LAST,
                            unique_id ASC NULLS LAST) AS slow_rank
  FROM ({_RUN_RESULTS_SQL}) r) t WHERE slow_rank <= 5"""


# ------------------------------------------------------------ snapshots

SCD_AS_OF = "2025-01-01"
SCD_START = "2024-01-01"
_SCD_PREVIOUS = ("c_custkey as customer_key", "c_mktsegment as segment",
                 "cast(c_nationkey as bigint) as nation_key")
_SCD_OPEN_ORDERS = "o_orderstatus = 'O'"


def _scd_states(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Customers as of the start, and a later state in which customers
    without open orders are gone, negative balances are re-segmented and
    suppliers appear as new keys."""
    t = DriverTables(spark, sf_dir)
    customer = t.table("customer")
    open_custs = t.table("orders").where(_SCD_OPEN_ORDERS).select(
        F.col("o_custkey").alias("c_custkey"))
    still = (customer.join(open_custs, "c_custkey", "left_semi")
             .selectExpr("c_custkey as customer_key",
                         "case when c_acctbal < 0 then 'DELINQUENT' else c_mktsegment end as segment",
                         "cast(c_nationkey as bigint) as nation_key"))
    new = t.table("supplier").selectExpr("s_suppkey + 1000000 as customer_key",
                                         "'SUPPLIER' as segment",
                                         "cast(s_nationkey as bigint) as nation_key")
    return customer.selectExpr(*_SCD_PREVIOUS), still.unionByName(new)


def scd_versions(spark, sf_dir):
    """SCD-1: the start's versions merged with the later state."""
    start, later = _scd_states(spark, sf_dir)
    previous = snapshots.first_versions(start, "customer_key", ["segment", "nation_key"], SCD_START)
    return snapshots.scd2_merge(previous, later, "customer_key", ["segment", "nation_key"], SCD_AS_OF)


def scd_incremental(spark, sf_dir):
    """SCD-1 kept in a store: each merge reads and writes the current part only."""
    target = f"{checkpoint_dir(spark).rstrip('/')}/versions/{uuid.uuid4().hex}"
    store = snapshots.VersionStore(spark, target, "customer_key", ["segment", "nation_key"])
    for state, day in zip(_scd_states(spark, sf_dir), (SCD_START, SCD_AS_OF), strict=True):
        store.merge(state, day)
    return store.versions()


_SCD_SQL = f"""
WITH prev AS (
  SELECT {', '.join(_SCD_PREVIOUS)}, DATE '{SCD_START}' AS valid_from,
         CAST(NULL AS DATE) AS valid_to, true AS is_current FROM customer),
snap AS (
  SELECT c_custkey AS customer_key,
         CASE WHEN c_acctbal < 0 THEN 'DELINQUENT' ELSE c_mktsegment END AS segment,
         CAST(c_nationkey AS BIGINT) AS nation_key
  FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE {_SCD_OPEN_ORDERS})
  UNION ALL
  SELECT s_suppkey + 1000000, 'SUPPLIER', CAST(s_nationkey AS BIGINT) FROM supplier),
j AS (
  SELECT p.customer_key AS pk, p.segment AS pseg, p.nation_key AS pnat, p.valid_from AS pfrom,
         p.valid_to AS pto, p.is_current AS pcur, s.customer_key AS sk, s.segment AS sseg,
         s.nation_key AS snat,
         (p.customer_key IS NOT NULL AND s.customer_key IS NOT NULL
          AND p.segment IS NOT DISTINCT FROM s.segment
          AND p.nation_key IS NOT DISTINCT FROM s.nation_key) AS same
  FROM prev p FULL OUTER JOIN snap s ON p.customer_key = s.customer_key)
SELECT pk AS customer_key, pseg AS segment, pnat AS nation_key, pfrom AS valid_from,
       pto AS valid_to, pcur AS is_current FROM j WHERE same
UNION ALL
SELECT pk, pseg, pnat, pfrom, DATE '{SCD_AS_OF}', false FROM j WHERE pk IS NOT NULL AND NOT same
UNION ALL
SELECT sk, sseg, snat, DATE '{SCD_AS_OF}', CAST(NULL AS DATE), true FROM j
WHERE sk IS NOT NULL AND NOT same"""


# ------------------------------------------------------------ CSV mapping table

def seed_csv_roundtrip(spark, sf_dir):
    """SRC-3: the mapping table written as CSV (quoted JSON text, doubled
    quotes, a literal backslash escape) and read back with declared types."""
    seed = DriverTables(spark, sf_dir).raw("seed_mapping")
    path = f"{checkpoint_dir(spark).rstrip('/')}/seed_csv/{uuid.uuid4().hex}"
    io.write_seed_csv(seed, path)
    return io.read_seed_csv(spark, path)


# ------------------------------------------------------------ view, table, namespace

def table_round_trip(spark, sf_dir):
    """SNK-1..3: a model written as a table in a namespace and read through a view of it."""
    namespace, name = "personalens_models", f"review_ranking_{uuid.uuid4().hex}"
    io.ensure_namespace(spark, namespace)
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}"
    io.write_table(Warehouse.from_driver_tables(spark, sf_dir).review_ranking, f"{namespace}.{name}", path=path)
    return io.as_view(spark.table(f"{namespace}.{name}"), name)


PART_ROWS = 100


def review_account_personas(spark, sf_dir):
    """DEAD-1: the accounts' sorted persona lists in parts of bounded size."""
    return gaps.review_account_personas(_wh(spark, sf_dir).review_persona_attributes, PART_ROWS)


_PARTS_SQL = f"""
SELECT ad_account_id AS review_account_id, (n - 1) // {PART_ROWS} AS part, count(*) AS personas,
       string_agg(persona_attribute, ', ' ORDER BY persona_attribute) AS persona_list
FROM (SELECT *, row_number() OVER (ORDER BY ad_account_id NULLS FIRST, persona_attribute) AS n
      FROM (SELECT DISTINCT ad_account_id, persona_attribute FROM rpa WHERE persona_attribute IS NOT NULL))
GROUP BY 1, 2"""

SEED_SPEC = ("ad_account_id:i ad_account_name product matched_review_product "
             "review_account_name review_account_id:i")


def queries() -> dict:
    return {
        "critical_gaps": _q(critical_gaps,
                            "ad_account_name persona_attribute gap_type review_count:i "
                            "recommendation priority_score:i",
                            "SELECT * FROM gap_analysis WHERE gap_priority = 'critical'"),
        "top_opportunities": _q(top_opportunities,
                                "persona_attribute gap_type review_count:i ad_count:i avg_roas:d "
                                "opportunity_level recommendation",
                                "SELECT * FROM gap_analysis WHERE gap_priority IN "
                                "('critical', 'high') AND opportunity_level = 'high_opportunity'"),
        "review_only_personas": _q(review_only_personas,
                                   "persona_attribute coverage_type total_review_mentions:i "
                                   "total_ad_mentions:i avg_review_confidence:d avg_ad_confidence:d",
                                   "SELECT * FROM unified_final WHERE coverage_type = 'review_only' "
                                   "AND total_review_mentions >= 3"),
        "untargeted_review_personas": _q(
            untargeted_review_personas, "persona_attribute review_count:i",
            "SELECT persona_attribute, count(review_id) AS review_count FROM rpa "
            "WHERE persona_attribute NOT IN (SELECT DISTINCT apa.persona_attribute FROM apa "
            "JOIN stg_cad_ads_insights_meta ai ON apa.ads_meta_id = ai.ads_meta_id "
            "WHERE ai.roas > 2.0) GROUP BY persona_attribute"),
        "dq_unique": _q(dq_unique, "model column_name value n_rows:i", _dq_unique_sql()),
        "dq_not_null": _q(dq_not_null, "model column_name null_rows:i status", _dq_not_null_sql()),
        "dq_accepted_values": _q(dq_accepted_values, "model column_name checked_rows:i failing_rows:i status",
                                 _dq_accepted_sql()),
        "run_summary": _q(run_summary,
                          "run_id total_models:i successful:i failed:i test_failures:i "
                          "total_execution_time:d success_rate:d run_status", _RUN_SUMMARY_SQL),
        "failed_models": _q(failed_models, "run_id unique_id message",
                            f"SELECT run_id, unique_id, message FROM ({_RUN_RESULTS_SQL}) r WHERE status = 'error'"),
        "table_round_trip": _q(table_round_trip, "persona_name account_name ad_account_id:i review_count:i "
                               "percentage:d total_unique_reviews:i volume_category review_rank:i",
                               "SELECT * FROM review_ranking"),
        "slow_models": _q(slow_models, "run_id unique_id status execution_time:d slow_rank:i",
                          _SLOW_SQL),
        "scd_versions": _q(scd_versions,
                           "customer_key:i segment nation_key:i valid_from valid_to is_current:b",
                           _SCD_SQL),
        "scd_incremental": _q(scd_incremental,
                              "customer_key:i segment nation_key:i valid_from valid_to is_current:b",
                              _SCD_SQL),
        "dq_column_contract": _q(dq_column_contract, "model column_name status filled_rows:i", _contract_sql()),
        "dq_observed": _q(dq_observed, "model column_name test failing_rows:i status", _dq_observed_sql()),
        "run_result_files": _q(run_result_files, "run_id good_documents:i bad_documents:i total_models:i failed:i", _RUN_FILES_SQL),
        "review_account_personas": _q(review_account_personas, "review_account_id:i part:i personas:i persona_list", _PARTS_SQL),
        "seed_csv_roundtrip": _q(seed_csv_roundtrip, SEED_SPEC,
                                 "SELECT * FROM raw_seed_mapping"),
    }
