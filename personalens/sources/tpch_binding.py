"""Raw ad / review tables projected from the driver's TPC-H-style tables.

The library runs on ad-performance and review data. The test tables are
TPC-H shaped, so every raw table is a projection of them: parts become ads and
their creative analysis, line items become daily ad insights, orders become
reviews, per-order line-item aggregates become the review tool's analysis of
ads, and suppliers become rows of the product mapping table.

Each projection is written once as SQL expressions. Spark applies them with
``selectExpr`` on DataFrames it reads and joins itself; the DuckDB checks in
``personalens.plans.duck_checks`` splice the same expressions into their own
SQL, so both engines start from identical inputs. Every table grows with the
driver tables it comes from.

Planted edge cases (NULL JSON, non-arrays, empty arrays, blank and 'null'
elements, double-encoded arrays, bad numbers, mixed element kinds) are chosen
by the row key so that each appears at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Common word pieces of a part name ("small ring" -> adjective, noun).
_ADJ = "split_part(p_name, ' ', 1)"
_NOUN = "split_part(p_name, ' ', 2)"
_Q = "chr(92) || '\"'"  # an escaped quote inside a JSON string


def _s(expr: str) -> str:
    return f"cast({expr} as string)"


def _dec(expr: str) -> str:
    return f"cast({expr} as decimal(18,6))"


def _double_encoded(json_sql: str) -> str:
    """A JSON *string* whose content is the given JSON text."""
    return f"'\"' || replace({json_sql}, '\"', {_Q}) || '\"'"


# ---------------------------------------------------------------- CAD side

AD_ACCOUNTS = [
    "cast(n_nationkey as bigint) as id",
    "cast(n_regionkey as bigint) as company_id",
    # nations 23 and 24 share one platform id
    f"{_s('least(n_nationkey, 23) + 10')} as ad_account_id",
    "'acct ' || n_name as ad_account_name",
    "n_name as account_name",
    "lower(n_name) || '@example.test' as account_email",
    f"'industry ' || {_s('n_regionkey')} as account_industry",
    "'synthetic account ' || n_name as account_description",
]

CAMPAIGNS_META = [
    "s_suppkey as id",
    f"'cmp' || {_s('s_suppkey')} as campaign_meta_id",
    "cast(s_nationkey as bigint) as ad_accounts_id",
    "s_name as campaign_name",
    "cast(null as string) as special_ad_category",
    "'ACTIVE' as status",
    "case when s_suppkey % 3 = 0 then 'PAUSED' else 'ACTIVE' end as effective_status",
    "cast(null as timestamp) as start_time",
]

AD_SET_META = [
    "s_suppkey as id",
    f"'set' || {_s('s_suppkey')} as meta_ad_set_id",
    "s_suppkey as campaigns_meta_id",
    "cast(s_nationkey as bigint) as ad_accounts_id",
    "s_name || ' set' as ad_set_name",
    "'ACTIVE' as status",
    "'ACTIVE' as effective_status",
    "'IMPRESSIONS' as billing_event",
    "cast(null as string) as source_adset",
    f"'{{\"nation\":' || {_s('s_nationkey')} || '}}' as targeting",
    "cast(null as timestamp) as start_time",
]

ADS = [
    "p_partkey as id",
    f"'m' || {_s('p_partkey')} as ad_meta_id",
    "p_partkey % 25 as ad_accounts_id",
    "p_partkey % 100 as ad_set_meta_id",
    "p_name as ad_name",
]

ADS_META = [
    "p_partkey as id",
    # every eleventh ads_meta row has no ad: the ad hierarchy joins drop it
    "case when p_partkey % 11 = 0 then cast(null as bigint) else p_partkey end as ad_id",
    "cast(null as string) as link_ad_settings",
    "cast(null as string) as ad_format_asset",
    "cast(null as string) as action_video_type",
    "cast(null as string) as delivery",
    f"{_s('p_partkey')} as product_id",
    "cast(null as string) as video_asset",
    "cast(null as string) as placement",
    "cast(null as string) as objectives",
    "p_type as status",
    "p_brand as effective_status",
    "cast(null as date) as reporting_starts",
    "cast(null as date) as reporting_ends",
]

ADS_CREATIVES_META = [
    "p_partkey as id",
    f"'cr' || {_s('p_partkey')} as ad_creative_meta_id",
    "p_partkey as ads_meta_id",
    "cast(null as string) as page_id",
    "p_name as body",
    "p_brand as headline",
    "p_type as title",
    "cast(null as string) as video_id",
    f"{_s('p_size')} as duration",
    "'video' as ad_creative_type",
    "p_size % 2 = 0 as is_asset",
] + [f"cast(null as string) as {c}" for c in (
    "s3_image_url", "s3_video_url", "meta_image_url", "meta_video_url",
    "website_url", "thumbnail_url", "image_hash", "adcreative")]

ADS_ANALYSIS = [
    "p_partkey as id",
    "p_partkey as ads_meta_id",
    "p_partkey as ad_creative_meta_id",
    "p_name as audio_transcription",
    "cast(null as string) as visual_transcription",
    "'9:16' as aspect_ratio",
    "lower(p_type) as production_type",
    f"{_ADJ} as concept",
    f"'[\"' || p_brand || '\"]' as product",
    "cast(null as string) as video_keyframes",
]

_CONF_TEXT = ("case p_partkey % 7 when 0 then '-1' when 1 then '1e3' when 2 then '.5' "
              "when 3 then 'high' when 4 then '12.' when 5 then '0.1234567' else '0.9' end")

_CAD_PERSONAS_ARRAY = (
    f"'[{{\"attribute\":\"' || upper({_NOUN}) || '\",\"value\":\"' || p_brand || "
    f"'\",\"confidence\":\"' || {_CONF_TEXT} || '\"}},"
    f"{{\"attribute\":\" ' || {_ADJ} || ' \",\"value\":\"' || lower(p_type) || "
    f"'\",\"confidence\":0.75}},"
    f"{{\"attribute\":\"' || {_NOUN} || '\",\"confidence\":0.5}}]'")

_CAD_PERSONAS_PLAIN = (
    f"'[{{\"attribute\":\"' || {_NOUN} || '\",\"value\":\"' || p_brand || "
    f"'\",\"confidence\":\"0.6\"}}]'")

CAD_PERSONA_JSON = (
    "case p_partkey % 13 "
    "when 0 then cast(null as string) "
    f"when 1 then {_double_encoded(_CAD_PERSONAS_PLAIN)} "
    f"when 2 then '{{\"attribute\":\"' || {_NOUN} || '\"}}' "
    "when 3 then '[]' "
    "when 4 then '[{\"value\":\"x\"},{\"attribute\":null},\"s\",4,{\"attribute\":\"  \"}]' "
    f"else {_CAD_PERSONAS_ARRAY} end")

CAD_VALUE_PROP_JSON = (
    "case p_partkey % 11 "
    "when 0 then cast(null as string) "
    "when 1 then '\"not an array\"' "
    f"else '[{{\"proposition\":\"' || {_ADJ} || ' ' || {_NOUN} || '\",\"strength\":\"' || "
    f"{_s('p_size % 10')} || '\",\"clarity\":\"' || "
    f"(case when p_size % 3 = 0 then 'clear' else {_s('p_size % 5')} || '.5' end) || '\"}},"
    "{\"proposition\":\"null\",\"strength\":\"1\"},"
    "{\"proposition\":\"' || p_brand || '\",\"strength\":2,\"clarity\":null}]' end")

CAD_PROBLEM_JSON = (
    "case p_partkey % 9 "
    "when 0 then cast(null as string) "
    f"else '[{{\"problem\":\" ' || upper({_NOUN}) || ' breaks \",\"relevance\":\"' || "
    f"{_s('p_size % 4')} || '\",\"urgency\":\"' || {_s('p_size % 6')} || '.\"}},"
    "{\"problem\":\"\"}]' end")

_BARRIER_PLAIN = "'[{\"barrier\":\"price\",\"solution_strength\":\"2\"}]'"

CAD_BARRIER_JSON = (
    "case p_partkey % 8 "
    "when 0 then cast(null as string) "
    f"when 1 then {_double_encoded(_BARRIER_PLAIN)} "
    "else '[{\"barrier\":\"' || lower(p_type) || ' cost\",\"solution_strength\":\"' || "
    f"{_s('p_size % 5')} || '\",\"addressability\":\"' || "
    f"(case when p_size % 4 = 0 then '+1' else {_s('p_size % 3')} end) || '\"}}]' end")

CREATIVE_ANALYSIS = [
    "p_partkey as id",
    "p_partkey as ad_analysis_id",
    f"{CAD_PERSONA_JSON} as persona_attributes",
    f"{CAD_VALUE_PROP_JSON} as value_propositions",
    f"{CAD_PROBLEM_JSON} as problems",
    f"{CAD_BARRIER_JSON} as barriers",
    "case when p_partkey % 17 = 0 then cast(null as string) else lower(p_type) end as core_persona",
] + [f"cast(null as string) as {c}" for c in (
    "hook_persona_attributes", "awareness_level", "talent_demographics", "concept_summary",
    "strengths", "weaknesses", "interesting_details", "concept_types", "structure",
    "hook_types", "hook_visual_types", "hook_visual_description", "situation",
    "visual_transcript_segments", "audio_transcript_segments", "visual_elements",
    "production_type", "hook_audio_transcript_text", "hook_visual_transcript_text",
    "hook_visual_elements", "music", "sound_design", "voiceover")]

INSIGHT_METRICS = [
    "reach", "impressions", "click", "amount_spent", "results", "cpc", "cpm", "cpp",
    "cost_per_result", "ctr", "frequency", "thumbstop", "retention", "roas",
    "omni_purchase_roas_1d_click", "omni_purchase_roas_7d_click", "omni_purchase_roas_1d_view",
    "omni_purchase_value", "omni_purchase_value_1d_click", "omni_purchase_value_7d_click",
    "omni_purchase_value_1d_view", "omni_purchase_purchases", "omni_purchase_purchases_1d_click",
    "omni_purchase_purchases_7d_click", "omni_purchase_purchases_1d_view",
    "video_30_sec_watched_actions", "video_3_sec_watched_actions",
    "hit_rate_x", "hit_rate_y", "hit_rate_z", "hit_rate",
]

# Metrics from integer arithmetic (exact and cheap in both engines): whole
# quantities, and prices / rates as whole cents or hundredths first.
_QTY = "cast(floor(l_quantity + 0.5) as bigint)"
_CENTS = "cast(floor(l_extendedprice * 100 + 0.5) as bigint)"
_DISC = "cast(floor(l_discount * 100 + 0.5) as bigint)"
_TAX = "cast(floor(l_tax * 100 + 0.5) as bigint)"

_INSIGHT_VALUES = {
    "reach": f"{_QTY} * 800",
    "impressions": f"{_QTY} * 1000",
    "click": f"{_QTY} * 12",
    "amount_spent": f"{_QTY} * 10",
    "cpc": f"{_DISC} * 0.1 + 0.5 + (l_orderkey % 89) * 0.01",
    "ctr": f"{_TAX} * 0.4 + (l_orderkey % 101) * 0.001",
    "frequency": "l_linenumber",
    "thumbstop": f"{_TAX}",
    "retention": f"{_DISC}",
    "omni_purchase_value": f"{_CENTS} * 0.0001",
    "omni_purchase_purchases": f"{_QTY} % 4",
    "video_3_sec_watched_actions": f"{_QTY} * 150",
}


def _insight_expr(name: str) -> str:
    if name == "roas":
        return ("case when l_linenumber = 3 then cast(null as decimal(18,6)) "
                f"else {_dec(f'{_DISC} * 0.4 + (l_orderkey % 997) * 0.001')} end as roas")
    if name in _INSIGHT_VALUES:
        return f"{_dec(_INSIGHT_VALUES[name])} as {name}"
    return f"cast(null as decimal(18,6)) as {name}"


ADS_INSIGHTS_META = (
    ["l_orderkey * 10 + l_linenumber as id", "l_partkey as ads_meta_id"]
    + [_insight_expr(m) for m in INSIGHT_METRICS]
    + ["l_returnflag as objective"])

CAD_UNIQUE_TAGS = [
    "c_custkey as id",
    "cast(c_nationkey as bigint) as ad_accounts_id",
    "lower(c_mktsegment) as text_tag",
    "'segment' as tag_type",
]

CAD_AD_TAGS = [
    "o_orderkey as id",
    "o_custkey as unique_tags_id",
    "o_custkey as ads_meta_id",
]

CAD_TAG_CLUSTERS = [
    "cast(r_regionkey as bigint) as id",
    f"'C' || {_s('r_regionkey')} as cluster_code",
    "cast(r_regionkey as bigint) as cluster_history_id",
    "r_name as cluster_name",
    "cast(null as string) as cluster_description",
    "1 as cluster_version",
    "cast(null as timestamp) as created_at",
    "'builder' as created_by",
]

CAD_ALGORITHM_TAG_ASSIGN = [
    "c_custkey as id",
    "c_custkey as unique_tags_id",
    "cast(c_nationkey % 5 as bigint) as cluster_id",
    "cast(null as bigint) as tag_history_id",
    "c_acctbal as probability",
    "cast(null as timestamp) as assigned_at",
    "'rule' as assigned_by",
]

# ------------------------------------------------------------- review side

REVIEW_PERSONA_JSON = (
    "case o_orderkey % 10 "
    "when 0 then cast(null as string) "
    f"when 1 then '{{\"persona\":\"' || {_NOUN} || '\"}}' "
    "when 2 then '[\"\", \"  \", null, \"null\", \":x\"]' "
    f"when 3 then '[\"NULL\", \"' || upper({_NOUN}) || ': ' || {_ADJ} || ':extra\"]' "
    f"else '[\"' || {_NOUN} || ': ' || lower(p_type) || '\", \"' || {_ADJ} || "
    f"'\", \" ' || upper({_NOUN}) || ' : ' || p_brand || ' \"]' end")

REVIEWS = [
    "o_orderkey as id",
    "o_custkey % 30 as account_id",
    "o_orderpriority as review_content",
    f"'author ' || {_s('o_custkey % 97')} as review_author",
    "cast(o_orderdate as date) as review_date",
    f"{REVIEW_PERSONA_JSON} as r_persona_attributes",
    ("case o_orderkey % 7 when 0 then cast(null as string) "
     f"else '[\"' || {_ADJ} || ' ' || {_NOUN} || '\", \"\", \"' || p_brand || '\"]' end "
     "as r_value_propositions"),
    ("case o_orderkey % 6 when 0 then cast(null as string) when 1 then '\"just text\"' "
     "else '[\"' || lower(p_type) || ' issue\", \"null\", null, \" Late delivery \"]' end "
     "as r_problems"),
    ("case o_orderkey % 5 when 0 then cast(null as string) "
     f"else '[\"price\", \"' || {_ADJ} || '\", 42]' end as r_barriers"),
    "o_orderdate as created",
]

REVIEW_AD_PERSONA_JSON = (
    "case l_orderkey % 9 "
    "when 0 then cast(null as string) "
    f"when 1 then '[{{\"persona\":\"' || upper({_NOUN}) || '\",\"value\":\"' || p_brand || "
    f"'\",\"confidence\":\"0.7\"}}, \"' || {_NOUN} || '\", null, \"null\", "
    f"{{\"description\":\"d\",\"name\":\"' || {_ADJ} || '\"}}]' "
    f"when 2 then '{{\"persona\":\"' || {_NOUN} || '\"}}' "
    f"when 3 then '[{{\"description\":\"only ' || {_ADJ} || '\", \"tags\":{{\"zz\":1,\"b\":[1.50,2]}},\"rank\":0.90}}]' "
    "when 4 then '[4, true, \"  Spaced  \", \"\"]' "
    f"when 5 then '[{{\"attribute\":\"' || {_NOUN} || '\",\"confidence\":\"high\"}}]' "
    f"else '[{{\"attribute\":\"' || {_NOUN} || '\",\"value\":\"' || lower(p_type) || "
    f"'\",\"confidence\":0.9}}, \"' || {_ADJ} || '\"]' end")

REVIEW_AD_CREATIVE_ANALYSIS = [
    "l_orderkey as id",
    "top_supp % 30 as account_id",
    "first_part as ad_id",
    "p_name as product_name",
    f"{REVIEW_AD_PERSONA_JSON} as persona_attributes",
    ("case l_orderkey % 5 when 0 then cast(null as string) "
     f"else '[\"' || {_NOUN} || '\", \"' || {_ADJ} || ' ' || {_NOUN} || '\", \"\", \"null\"]' end "
     "as hook_persona_attributes"),
    "'[\"' || p_brand || '\"]' as value_propositions",
    "last_ship as created_at",
    "'9:16' as aspect_ratio",
    f"{_s('n_lines')} as video_duration",
] + [f"cast(null as string) as {c}" for c in (
    "audio_transcript_text", "visual_transcript_text", "audio_transcript_segments",
    "visual_transcript_segments", "visual_elements", "concept_types", "production_type",
    "hook_audio_transcript_text", "hook_visual_transcript_text", "hook_visual_elements",
    "hook_types", "hook_visual_types", "awareness_level", "sound_design", "audio_profile",
    "rh_image_url", "rh_video_url", "iconik_url")]

REVIEW_UNIQUE_TAGS = [
    "event_id as id",
    "user_id % 30 as account_id",
    "event_type as text_tag",
    "'event' as tag_type",
]

REVIEW_AD_TAGS = [
    "event_id as id",
    "user_id % 30 as account_id",
    "user_id as ad_id",
    "event_id as tag_id",
    "event_type as text_tag",
    "'event' as tag_type",
]

REVIEW_TAG_CLUSTERS = [
    "cast(r_regionkey as bigint) as id",
    "cast(r_regionkey as bigint) as account_id",
    f"'R' || {_s('r_regionkey')} as cluster_code",
    "r_name as cluster_name",
    "'event' as tag_type",
    "1 as cluster_version",
    "true as is_active",
    "cast(null as timestamp) as created_at",
    "'builder' as created_by",
]

REVIEW_ALGORITHM_TAG_ASSIGN = [
    "event_id as id",
    "user_id % 30 as account_id",
    "event_id as tag_id",
    "event_id % 5 as cluster_id",
    "'event' as tag_type",
    "value as probability",
    "ts as assigned_at",
    "'rule' as assigned_by",
    "event_type <> 'error' as is_active",
]

# ----------------------------------------------------------- mapping table

SEED = [
    "case when s_suppkey % 11 = 10 then cast(null as bigint) "
    "else cast(s_nationkey as bigint) end as ad_account_id",
    "'brand ' || n_name as ad_account_name",
    # JSON-encoded text as in the mapping file: quotes and a literal escape
    ("'\"' || lower(s_name) || case when s_suppkey % 5 = 2 then ' caf' || chr(92) || 'u00e9' "
     "else '' end || ' kit\"' as product"),
    "case when s_suppkey % 7 = 3 then cast(null as string) else lower(s_name) end "
    "as matched_review_product",
    f"'store ' || {_s('(s_suppkey * 7) % 30')} as review_account_name",
    "case when s_suppkey % 4 = 0 then cast((s_suppkey * 7) % 30 as bigint) "
    "else cast(null as bigint) end as review_account_id",
]

# table name -> (driver source, projection). Sources: a driver table name, or
# one of the derived inputs "orders_part", "order_lines_part", "supplier_nation".
BINDINGS: dict[str, tuple[str, list[str]]] = {
    "cad_ad_accounts": ("nation", AD_ACCOUNTS),
    "cad_campaigns_meta": ("supplier", CAMPAIGNS_META),
    "cad_ad_set_meta": ("supplier", AD_SET_META),
    "cad_ads": ("part", ADS),
    "cad_ads_meta": ("part", ADS_META),
    "cad_ads_creatives_meta": ("part", ADS_CREATIVES_META),
    "cad_ads_analysis": ("part", ADS_ANALYSIS),
    "cad_creative_analysis": ("part", CREATIVE_ANALYSIS),
    "cad_ads_insights_meta": ("lineitem", ADS_INSIGHTS_META),
    "cad_unique_tags": ("customer", CAD_UNIQUE_TAGS),
    "cad_ad_tags": ("orders", CAD_AD_TAGS),
    "cad_tag_clusters": ("region", CAD_TAG_CLUSTERS),
    "cad_algorithm_tag_assign": ("customer", CAD_ALGORITHM_TAG_ASSIGN),
    "review_reviews": ("orders_part", REVIEWS),
    "review_ad_creative_analysis": ("order_lines_part", REVIEW_AD_CREATIVE_ANALYSIS),
    "review_unique_tags": ("events", REVIEW_UNIQUE_TAGS),
    "review_ad_tags": ("events", REVIEW_AD_TAGS),
    "review_tag_clusters": ("region", REVIEW_TAG_CLUSTERS),
    "review_algorithm_tag_assign": ("events", REVIEW_ALGORITHM_TAG_ASSIGN),
    "seed_mapping": ("supplier_nation", SEED),
}

# SQL text of the derived inputs, for the DuckDB side.
DERIVED_SQL = {
    "orders_part": "select * from orders join part on p_partkey = o_custkey",
    "order_lines_part": (
        "select * from (select l_orderkey, min(l_partkey) as first_part, "
        "max(l_suppkey) as top_supp, max(l_shipdate) as last_ship, count(*) as n_lines "
        "from lineitem group by l_orderkey) ol join part on p_partkey = first_part"),
    "supplier_nation": "select * from supplier join nation on n_nationkey = s_nationkey",
}


def binding_sql(name: str) -> str:
    """DuckDB/ANSI text of one raw table, over the driver's table names."""
    source, exprs = BINDINGS[name]
    src = DERIVED_SQL.get(source, source)
    if source in DERIVED_SQL:
        src = f"({src}) src"
    return f"select {', '.join(exprs)} from {src}"


# Declared schemas of the driver's tables: read without a schema-inference job.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                 "c_mktsegment string"),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "events": ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
               "value double, props string"),
}


class DriverTables:
    """Lazy reader of the driver's parquet tables in one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            reader = self.spark.read
            if name in DRIVER_SCHEMAS:
                reader = reader.schema(DRIVER_SCHEMAS[name])
            self._cache[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def _source(self, source: str) -> DataFrame:
        if source == "orders_part":
            return self.table("orders").join(
                self.table("part"), F.col("p_partkey") == F.col("o_custkey"))
        if source == "order_lines_part":
            lines = (self.table("lineitem").groupBy("l_orderkey")
                     .agg(F.min("l_partkey").alias("first_part"),
                          F.max("l_suppkey").alias("top_supp"),
                          F.max("l_shipdate").alias("last_ship"),
                          F.count(F.lit(1)).alias("n_lines")))
            return lines.join(self.table("part"), F.col("p_partkey") == F.col("first_part"))
        if source == "supplier_nation":
            return self.table("supplier").join(
                self.table("nation"), F.col("n_nationkey") == F.col("s_nationkey"))
        return self.table(source)

    def raw(self, name: str) -> DataFrame:
        """One raw ad/review table projected from the driver tables."""
        source, exprs = BINDINGS[name]
        return self._source(source).selectExpr(*exprs)

    def raw_tables(self) -> "LazyTables":
        return LazyTables(self.raw, list(BINDINGS))


class LazyTables(dict):
    """A name -> DataFrame mapping that builds each entry on first use."""

    def __init__(self, build, names):
        super().__init__()
        self._build = build
        self._names = list(names)

    def __missing__(self, key):
        if key not in self._names:
            raise KeyError(key)
        value = self._build(key)
        self[key] = value
        return value

    def __contains__(self, key):
        return key in self._names

    def keys(self):
        return list(self._names)

    def __iter__(self):
        return iter(self._names)


class EmptyTables(DriverTables):
    """The driver's tables without rows or files: for the types of what is projected from them."""

    def table(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], DRIVER_SCHEMAS[name])


def raw_schema(spark: SparkSession, name: str) -> str:
    """Declared columns and types of a raw table."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in EmptyTables(spark, "").raw(name).schema)


def raw_columns(name: str) -> list[str]:
    """Names of a raw table's columns, in order."""
    return [e.rsplit(" as ", 1)[1].strip() for e in BINDINGS[name][1]]
