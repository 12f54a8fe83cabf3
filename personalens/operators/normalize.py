"""JSON normalization: one row per persona attribute, value proposition,
problem or barrier (NORM-1..9).

Common rule: rows whose JSON is NULL are dropped, values that are not arrays
yield no rows, every surviving array element becomes one row (``explode`` is
an inner generator, so empty arrays vanish), and text keys are lower-cased and
trimmed. All of it is narrow: explode runs inside the scan's stage, filters
are pushed below it, and only the ad-hierarchy joins shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personalens.functions import json as J
from personalens.functions.numeric import NUMERIC, guarded_number, loose_number
from personalens.operators.expand import spread

DEFAULT_REVIEW_CONFIDENCE = 0.8


def _num(value) -> Column:
    return F.lit(value).cast(NUMERIC)


def _keep_text(t: Column) -> Column:
    """Element text survives when it is not NULL, blank or the word 'null'."""
    return t.isNotNull() & (F.trim(t) != "") & (F.trim(t) != "null")


def _clean(c: Column) -> Column:
    return F.lower(F.trim(c))


# ------------------------------------------------------------------ reviews

def review_persona_attributes(reviews: DataFrame, review_analysis: DataFrame,
                              review_key: str = "review_id",
                              analysis_key: str = "review_creative_analysis_id",
                              confidence: float = DEFAULT_REVIEW_CONFIDENCE) -> DataFrame:
    """NORM-1: review x persona element.

    Reviews join the review tool's creative analysis on ``review_key =
    analysis_key`` (the keys are parameters; by default the review id meets
    the analysis id) and take the account from the analysis row. An element
    with ':' splits into attribute (part 1) and value (part 2); otherwise both
    are the whole text.
    """
    analysis = review_analysis.select(
        F.col(analysis_key).alias("_akey"), F.col("ad_account_id"))
    base = (reviews.where(F.col("r_persona_attributes").isNotNull())
            .select(review_key, "review_date", "review_author", "r_persona_attributes", "loaded_at")
            .join(analysis, F.col(review_key) == F.col("_akey")))
    t = F.col("_t")
    exploded = (base.select("*", F.explode(J.text_elements("r_persona_attributes")).alias("_t"))
                .where(_keep_text(t)))
    has_colon = t.contains(":")
    attr = F.when(has_colon, F.trim(F.split_part(t, F.lit(":"), F.lit(1)))).otherwise(t)
    value = F.when(has_colon, F.trim(F.split_part(t, F.lit(":"), F.lit(2)))).otherwise(t)
    return (exploded
            .select(F.col(review_key).alias("review_id"), "ad_account_id", "review_date",
                    "review_author", attr.alias("_attr"), value.alias("persona_value"), "loaded_at")
            # the 'null' test runs on the attribute before lower(): 'NULL' stays
            .where(F.col("_attr").isNotNull() & (F.col("_attr") != "") & (F.col("_attr") != "null"))
            .select("review_id", "ad_account_id", "review_date", "review_author",
                    _clean(F.col("_attr")).alias("persona_attribute"), "persona_value",
                    _num(confidence).alias("confidence_score"),
                    F.lit("review").alias("source_system"), "loaded_at"))


def _review_text_items(reviews: DataFrame, json_col: str, out: str,
                       constants: list[tuple[str, Column]]) -> DataFrame:
    t = F.col("_t")
    return (reviews.where(F.col(json_col).isNotNull())
            .select("review_id", "ad_account_id", "review_date", "review_author", "loaded_at",
                    F.explode(J.text_elements(json_col)).alias("_t"))
            .where(_keep_text(t))
            .select("review_id", "ad_account_id", "review_date", "review_author",
                    _clean(t).alias(out), *[c.alias(n) for n, c in constants],
                    F.lit("review").alias("source_system"), "loaded_at"))


def review_value_propositions(reviews: DataFrame, importance: int = 3,
                              sentiment: str = "positive") -> DataFrame:
    """NORM-2: review x value proposition, constant importance and sentiment."""
    return _review_text_items(reviews, "r_value_propositions", "value_proposition", [
        ("importance_score", _num(importance)), ("sentiment", F.lit(sentiment))])


def review_problems(reviews: DataFrame, severity: int = 3, category: str = "general") -> DataFrame:
    """NORM-3: review x problem, constant severity and category."""
    return _review_text_items(reviews, "r_problems", "problem", [
        ("severity_score", guarded_number(F.lit(str(severity)))),
        ("problem_category", F.lit(category))])


def review_barriers(reviews: DataFrame, impact: int = 3, barrier_type: str = "general") -> DataFrame:
    """NORM-4: review x barrier, constant impact and type."""
    return _review_text_items(reviews, "r_barriers", "barrier", [
        ("impact_score", guarded_number(F.lit(str(impact)))),
        ("barrier_type", F.lit(barrier_type))])


# ----------------------------------------------------------------- CAD ads

# JSON key -> output column for each kind of ad analysis element.
AD_ELEMENT_KINDS = {
    "persona_attributes": ("attribute", "persona_attribute",
                           [("value", "persona_value", "text"),
                            ("confidence", "confidence_score", "number")]),
    "value_propositions": ("proposition", "value_proposition",
                           [("strength", "strength_score", "number"),
                            ("clarity", "clarity_score", "number")]),
    "problems": ("problem", "problem",
                 [("relevance", "relevance_score", "number"),
                  ("urgency", "urgency_score", "number")]),
    "barriers": ("barrier", "barrier",
                 [("solution_strength", "solution_strength", "number"),
                  ("addressability", "addressability_score", "number")]),
}


def ads_with_account(creative_analysis: DataFrame, ads_analysis: DataFrame,
                     ads_meta: DataFrame, ads: DataFrame, json_col: str,
                     extra: tuple[str, ...] = ()) -> DataFrame:
    """Creative analysis rows with their ads_meta, creative and ad account.

    creative_analysis -> ads_analysis -> ads_meta -> ads, all inner equi joins
    on single keys. Only the needed columns travel through the shuffles.
    """
    ca = (creative_analysis.where(F.col(json_col).isNotNull())
          .select("cad_creative_analysis_id", "ad_analysis_id", json_col, *extra, "loaded_at"))
    aa = ads_analysis.select("ad_analysis_id", "ads_meta_id", "ad_creative_id")
    am = ads_meta.select("ads_meta_id", "ad_id")
    a = ads.select("ad_id", "ad_account_id")
    return (ca.join(aa, "ad_analysis_id")
            .join(am, "ads_meta_id")
            .join(a, "ad_id")
            .drop("ad_id"))


def explode_ad_elements(with_account: DataFrame, json_col: str,
                        extra: tuple[str, ...] = ()) -> DataFrame:
    """NORM-5..8 core: explode an array of objects and read its fields.

    The key field must be present, not blank and not the word 'null'; numeric
    fields pass through :func:`guarded_number`. A JSON string holding an array
    is unescaped and parsed too. Rows are dealt round to the tasks first:
    they come in as few tasks as their (small) files have splits, and reading the JSON is most of the work.
    """
    key, out_key, fields = AD_ELEMENT_KINDS[json_col]
    e = F.col("_e")
    keys = [key, *[f for f, _, _ in fields]]
    texts = F.transform(J.variant_elements(json_col, double_encoded=True), lambda x: J.field_texts(x, keys))
    exploded = spread(J.keep_last_of_repeated_keys(with_account)).select("*", F.explode(texts).alias("_e"))
    projected = exploded.select(
        "cad_creative_analysis_id", "ad_analysis_id", "ads_meta_id", "ad_creative_id",
        "ad_account_id", *extra, F.trim(e[0]).alias("_k"),
        *[F.trim(e[i]).alias(f"_{out}") for i, (_, out, _) in enumerate(fields, 1)], "loaded_at")
    k = F.col("_k")
    outs = []
    for _, out, kind in fields:
        raw = F.col(f"_{out}")
        outs.append((guarded_number(raw) if kind == "number" else raw).alias(out))
    return (projected.where(k.isNotNull() & (k != "") & (k != "null"))
            .select("cad_creative_analysis_id", "ad_analysis_id", "ads_meta_id",
                    "ad_creative_id", "ad_account_id", *extra, _clean(k).alias(out_key),
                    *outs, F.lit("cad").alias("source_system"), "loaded_at"))


def ad_persona_attributes(creative_analysis, ads_analysis, ads_meta, ads) -> DataFrame:
    """NORM-5: ad analysis x persona object (attribute, value, confidence)."""
    w = ads_with_account(creative_analysis, ads_analysis, ads_meta, ads,
                         "persona_attributes", ("core_persona",))
    return explode_ad_elements(w, "persona_attributes", ("core_persona",))


def ad_value_propositions(creative_analysis, ads_analysis, ads_meta, ads) -> DataFrame:
    """NORM-6: ad analysis x value proposition object."""
    w = ads_with_account(creative_analysis, ads_analysis, ads_meta, ads, "value_propositions")
    return explode_ad_elements(w, "value_propositions")


def ad_problems(creative_analysis, ads_analysis, ads_meta, ads) -> DataFrame:
    """NORM-7: ad analysis x problem object."""
    w = ads_with_account(creative_analysis, ads_analysis, ads_meta, ads, "problems")
    return explode_ad_elements(w, "problems")


def ad_barriers(creative_analysis, ads_analysis, ads_meta, ads) -> DataFrame:
    """NORM-8: ad analysis x barrier object."""
    w = ads_with_account(creative_analysis, ads_analysis, ads_meta, ads, "barriers")
    return explode_ad_elements(w, "barriers")


# -------------------------------------------- review tool's analysis of ads

def _persona_element(e: Column) -> Column:
    """Name, value and confidence of an object; its JSON text where one of the first two is missing, or the element is no object."""
    f = J.field_texts(e, ["persona", "attribute", "name", "value", "description", "confidence"])
    read = F.transform(F.array(f), lambda t: F.struct(
        F.coalesce(t[0], t[1], t[2]).alias("name"), F.coalesce(t[3], t[4]).alias("value"), t[5].alias("confidence"),
        F.when(F.coalesce(t[0], t[1], t[2]).isNull() | F.coalesce(t[3], t[4]).isNull(), J.element_json(e)).alias("text"),
        J.is_object(e).alias("is_object")))
    return F.element_at(read, 1)


def ad_persona_attributes_from_review_analysis(
        review_analysis: DataFrame, confidence: float = DEFAULT_REVIEW_CONFIDENCE) -> DataFrame:
    """NORM-9 (APR): persona elements of the review tool's ad analysis.

    Object elements give persona = first of persona / attribute / name /
    the element's JSON text, value = first of value / description / JSON
    text, confidence = the 'confidence' field as a number or the default.
    Other elements give their JSON text (strings keep their quotes) and the
    default confidence. Text elements of ``hook_persona_attributes`` are
    added (union all), then rows are made distinct: those of one analysis row
    within its array, and only those of analysis ids that several rows share
    by a shuffle. So what a task holds of all others is their ids, not their elements.
    """
    base = (J.keep_last_of_repeated_keys(review_analysis).where(F.col("persona_attributes").isNotNull())
            .select("review_creative_analysis_id", "ad_account_id", "ad_id",
                    "persona_attributes", "hook_persona_attributes", "loaded_at"))
    key = "review_creative_analysis_id"
    # Dealt out, the (few) shared ids are a stage of their own: adaptive execution sees their size before it joins them.
    shared = spread(base.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
                    .where(F.col("_rows") > 1).select(key))
    known = spread(base.where(F.col(key).isNotNull()), key)
    alone = known.join(shared, key, "left_anti")
    others = known.join(shared, key, "left_semi").unionByName(base.where(F.col(key).isNull()))
    return _distinct_personas(alone, confidence).unionByName(_distinct_personas(others, confidence).distinct())


def _distinct_personas(base: DataFrame, confidence: float) -> DataFrame:
    """The different persona elements of each row."""
    default = _num(confidence)

    def persona(attribute: Column, value: Column, conf: Column) -> Column:
        return F.struct(attribute.alias("persona_attribute"), value.alias("persona_value"), conf.alias("confidence_score"))

    def named(e: Column) -> Column:
        stripped = F.btrim(e["text"], F.lit('"'))
        return e["is_object"] | ((stripped != "") & (stripped != "null"))

    def from_element(e: Column) -> Column:
        conf = F.when(e["is_object"], F.coalesce(loose_number(e["confidence"]), default)).otherwise(default)
        return persona(F.coalesce(e["name"], e["text"]), F.coalesce(e["value"], e["text"]), conf)

    objects = F.transform(F.filter(F.transform(J.variant_elements("persona_attributes"), _persona_element), named), from_element)
    hooks = F.transform(F.filter(J.text_elements("hook_persona_attributes"), _keep_text), lambda t: persona(t, t, default))
    none = F.array().cast("array<struct<persona_attribute:string,persona_value:string,confidence_score:" + NUMERIC + ">>")
    both = F.filter(F.concat(F.coalesce(objects, none), F.coalesce(hooks, none)),
                    lambda p: p["persona_attribute"].isNotNull() & (F.trim(p["persona_attribute"]) != ""))
    cleaned = F.array_distinct(F.transform(both, lambda p: persona(_clean(p["persona_attribute"]), p["persona_value"], p["confidence_score"])))
    ids = ["ad_account_id", "review_creative_analysis_id", "ad_id"]
    return (base.select(*ids, "loaded_at", F.explode(cleaned).alias("_p"))
            .select(*ids, "_p.*", F.lit("review_analysis_of_ads").alias("source_system"), "loaded_at"))
