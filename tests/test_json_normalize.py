"""NORM-1..9 edge cases on hand-built rows (one per planted JSON shape)."""

import datetime as dt
import json
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from core_help import rows
from personalens.functions import json as J
from personalens.operators import normalize

TS = dt.datetime(2025, 1, 1)
D = dt.date(2024, 5, 1)


def _reviews(spark, items):
    data = [(i, 7, f"a{i}", D, j, j, j, j, TS) for i, j in enumerate(items)]
    return spark.createDataFrame(data, "review_id long, ad_account_id long, review_author string, "
                                 "review_date date, r_persona_attributes string, "
                                 "r_value_propositions string, r_problems string, "
                                 "r_barriers string, loaded_at timestamp")


def _analysis(spark, n, account=42):
    return spark.createDataFrame([(i, account) for i in range(n)],
                                 "review_creative_analysis_id long, ad_account_id long")


def test_review_personas_split_and_drop(spark):
    items = ['["Age: 25-34", "hiker", "a:b:c"]', '["", "  ", null, "null", ":x"]', '["NULL"]',
             '{"persona":"x"}', '"text"', None, '[]', '[" Spaced ", 42]']
    out = normalize.review_persona_attributes(_reviews(spark, items), _analysis(spark, len(items)))
    got = rows(out, "review_id", "ad_account_id", "persona_attribute", "persona_value")
    assert got == sorted([
        (0, 42, "age", "25-34"), (0, 42, "hiker", "hiker"), (0, 42, "a", "b"),
        (2, 42, "null", "NULL"), (7, 42, "spaced", " Spaced "), (7, 42, "42", "42"),
    ], key=repr)
    assert {r.confidence_score for r in out.collect()} == {Decimal("0.800000")}


def test_review_personas_join_drops_unanalysed_reviews(spark):
    out = normalize.review_persona_attributes(
        _reviews(spark, ['["a"]', '["b"]']), _analysis(spark, 1))
    assert rows(out, "review_id") == [(0,)]


def test_review_text_items_constants(spark):
    r = _reviews(spark, ['["Price", " null ", "ok"]'])
    vp = normalize.review_value_propositions(r)
    assert rows(vp, "value_proposition", "importance_score", "sentiment") == [
        ("ok", Decimal("3.000000"), "positive"), ("price", Decimal("3.000000"), "positive")]
    pr = normalize.review_problems(r)
    assert rows(pr, "problem", "severity_score", "problem_category")[0][1:] == (
        Decimal("3.000000"), "general")
    ba = normalize.review_barriers(r)
    assert rows(ba, "barrier", "impact_score", "barrier_type")[0][1:] == (
        Decimal("3.000000"), "general")


def _ad_tables(spark, values):
    ca = spark.createDataFrame(
        [(i, i, v, v, v, v, "core", TS) for i, v in enumerate(values)],
        "cad_creative_analysis_id long, ad_analysis_id long, persona_attributes string, "
        "value_propositions string, problems string, barriers string, core_persona string, "
        "loaded_at timestamp")
    aa = spark.createDataFrame([(i, i + 100, i + 200) for i in range(len(values))],
                               "ad_analysis_id long, ads_meta_id long, ad_creative_id long")
    am = spark.createDataFrame([(i + 100, i + 300) for i in range(len(values))],
                               "ads_meta_id long, ad_id long")
    ads = spark.createDataFrame([(i + 300, 9) for i in range(len(values))],
                                "ad_id long, ad_account_id long")
    return ca, aa, am, ads


def test_ad_persona_objects(spark):
    values = [
        '[{"attribute":"Parent","value":"New","confidence":"0.9"}]',
        '[{"attribute":"a","confidence":"-1"},{"attribute":"b","confidence":"1e3"},'
        '{"attribute":"c","confidence":".5"},{"attribute":"d","confidence":"high"},'
        '{"attribute":"e","confidence":"12."},{"attribute":"f","confidence":"3"},'
        '{"attribute":"g","confidence":0.75}]',
        '[{"value":"x"}, {"attribute":null}, "s", 4, {"attribute":"  "}, {"attribute":"null"}]',
        '{"attribute":"x"}', '"text"', '42', None, '[]',
        '"[{\\"attribute\\":\\"Dbl\\",\\"confidence\\":\\"2\\"}]"',
    ]
    out = normalize.ad_persona_attributes(*_ad_tables(spark, values))
    got = rows(out, "persona_attribute", "persona_value", "confidence_score")
    assert got == sorted([
        ("parent", "New", Decimal("0.900000")), ("a", None, None), ("b", None, None),
        ("c", None, None), ("d", None, None), ("e", None, Decimal("12.000000")),
        ("f", None, Decimal("3.000000")), ("g", None, Decimal("0.750000")),
        ("dbl", None, Decimal("2.000000")),
    ], key=repr)
    assert rows(out, "ad_account_id", "source_system")[0] == (9, "cad")


def test_ad_value_propositions_problems_barriers(spark):
    v = ('[{"proposition":" Fast ","strength":"4","clarity":"clear"},'
         '{"problem":"Slow","relevance":"2","urgency":"3."},'
         '{"barrier":"Price","solution_strength":"1","addressability":"+1"}]')
    t = _ad_tables(spark, [v])
    assert rows(normalize.ad_value_propositions(*t), "value_proposition", "strength_score",
                "clarity_score") == [("fast", Decimal("4.000000"), None)]
    assert rows(normalize.ad_problems(*t), "problem", "relevance_score", "urgency_score") == [
        ("slow", Decimal("2.000000"), Decimal("3.000000"))]
    assert rows(normalize.ad_barriers(*t), "barrier", "solution_strength",
                "addressability_score") == [("price", Decimal("1.000000"), None)]


def test_ad_personas_from_review_analysis_mixed(spark):
    df = spark.createDataFrame([
        (1, 5, 10, '[{"persona":"A","confidence":"0.7"},{"name":"B","description":"d"},"C",'
                   'null,"null",{"description":"only","rank":2},4]', '["C", "", "null"]', TS),
        (2, 5, 11, None, '["D"]', TS),
    ], "review_creative_analysis_id long, ad_account_id long, ad_id long, "
       "persona_attributes string, hook_persona_attributes string, loaded_at timestamp")
    out = normalize.ad_persona_attributes_from_review_analysis(df)
    got = rows(out, "persona_attribute", "persona_value", "confidence_score")
    assert got == sorted([
        ("a", '{"persona": "A", "confidence": "0.7"}', Decimal("0.700000")),
        ("b", "d", Decimal("0.800000")),
        ('"c"', '"C"', Decimal("0.800000")),
        ('{"rank": 2, "description": "only"}', "only", Decimal("0.800000")),
        ("4", "4", Decimal("0.800000")),
        ("c", "C", Decimal("0.800000")),
    ], key=repr)


def test_apr_distinct(spark):
    df = spark.createDataFrame([(1, 5, 10, '["x", "x"]', '["x"]', TS)],
                               "review_creative_analysis_id long, ad_account_id long, ad_id long, "
                               "persona_attributes string, hook_persona_attributes string, "
                               "loaded_at timestamp")
    out = normalize.ad_persona_attributes_from_review_analysis(df)
    assert out.count() == 2  # '"x"' (element text keeps quotes) and 'x' (hook text)
    assert out.where(F.col("persona_attribute") == "x").count() == 1


# JSON value, the text the reports' JSON type prints for it (written by hand)
ELEMENT_TEXTS = [
    ('{"b": 0.90, "aa":"x\\u00e9\\n\\"q\\/ 5, 6", "a":{"z":[1]}, "a":{"y":true,"zz":0.10}}',
     '{"a": {"y": true, "zz": 0.10}, "b": 0.90, "aa": "x\u00e9\\n\\"q/ 5, 6"}'),
    ('{"\u00e9":1,"zz":2,"b":[ ],"c":{ }}', '{"b": [], "c": {}, "zz": 2, "\u00e9": 1}'),
    ('{"a":{"a":{"a":{"b":[[[1.0]]],"a":null}}}}', '{"a": {"a": {"a": {"a": null, "b": [[[1.0]]]}}}}'),
    ('"s\\t\\u0001\\u001F\\\\u001F"', '"s\\t\\u0001\\u001f\\\\u001F"'),
    ("0.90", "0.90"), ("1E2", "100"), ("-1.25e-3", "-0.00125"), ("12.5E+1", "125"), ("1.10E-2", "0.0110"), ("-0.0", "0.0"),
    ("-0", "0"), ("1.50e1", "15.0"), ("0e5", "0"), ("1e99999", "1e99999"), ("-7", "-7"),
    ("123456789012345678901234567890.12345678901234567890", "123456789012345678901234567890.12345678901234567890"),
    ('"7"', '"7"'), ("true", "true"), ('"true"', '"true"'), ("[]", "[]"), ("{}", "{}"), ('"\\\\\\"9, 8"', '"\\\\\\"9, 8"'),
]


def test_element_texts_of_the_json_type(spark):
    text = "[" + ", ".join(j for j, _ in ELEMENT_TEXTS) + "]"
    df = J.keep_last_of_repeated_keys(spark.createDataFrame([(text,), ("[null]",)], "j string"))
    got = [r.t for r in df.select(F.explode(J.variant_elements("j")).alias("e")).select(J.element_json(F.col("e")).alias("t")).collect()]
    assert got == [t for _, t in ELEMENT_TEXTS] + ["null"]
    # As text, strings lose their quotes and escapes.
    want = [json.loads(t) if t.startswith('"') else t for _, t in ELEMENT_TEXTS] + [None]
    assert [r.t for r in df.select(F.explode(J.text_elements("j")).alias("t")).collect()] == want
    fields = df.select(F.explode(J.variant_elements("j")).alias("e")).select(*[J.field_text(F.col("e"), k).alias(k) for k in ("a", "b", "aa")])
    assert [tuple(r) for r in fields.collect()][:3] == [
        ('{"y": true, "zz": 0.10}', "0.90", 'x\u00e9\n"q/ 5, 6'), (None, "[]", None), ('{"a": {"a": {"a": null, "b": [[[1.0]]]}}}', None, None)]


def test_malformed_json_stays_malformed(spark):
    bad = ["[01]", "{1:2}", "[{1:2}]", "[1 2]", "[1.]", "[.5]", "[+1]", "[1-2]", '["a"1]', "[1", "[\x01]", '["\x02"]', "[-]", "[1e]", "5", "", None]
    df = spark.createDataFrame([(b,) for b in bad], "j string")
    out = df.select(J.text_elements("j").alias("t"), J.variant_elements("j").alias("v")).collect()
    assert all(r.t is None and r.v is None for r in out)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.recursive(st.none() | st.booleans() | st.integers(-10**30, 10**30) | st.text(alphabet="ab\"\\,:[]{}1\n\u001f\u00e9 ", max_size=6),
                             lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(alphabet="ab1\"\\", max_size=3), x, max_size=3),
                             max_leaves=12), max_size=20))
def test_element_texts_on_random_json(spark, values):
    def text(v):
        if isinstance(v, dict):
            keys = sorted(v, key=lambda k: (len(k.encode()), k.encode()))
            return "{" + ", ".join(f"{text(k)}: {text(v[k])}" for k in keys) + "}"
        if isinstance(v, list):
            return "[" + ", ".join(map(text, v)) + "]"
        return json.dumps(v, ensure_ascii=False)

    df = spark.createDataFrame([(json.dumps(values),)], "j string")
    got = df.select(F.explode(J.variant_elements("j")).alias("e")).select(J.element_json(F.col("e")).alias("t")).collect()
    assert [r.t for r in got] == [text(v) for v in values]
