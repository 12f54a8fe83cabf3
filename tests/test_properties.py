"""Property test: review persona normalization equals a plain statement of the
rules on random arrays (explode count = surviving elements, split on ':',
blank / 'null' dropped, the 'null' test before lower-casing)."""

import datetime as dt
import json

from hypothesis import given, settings
from hypothesis import strategies as st

from personalens.operators import normalize

TS = dt.datetime(2025, 1, 1)
PIECES = ["", " ", "null", "NULL", "Age", "25-34", ":", "a:b", " x ", "Hiker", "b:c:d", "\t"]

element = st.one_of(st.none(), st.lists(st.sampled_from(PIECES), min_size=1, max_size=3)
                    .map("".join), st.integers(-5, 5))
array = st.one_of(st.none(), st.lists(element, max_size=5).map(json.dumps),
                  st.just('{"k": 1}'), st.just('"text"'))


def expected(arrays):
    out = []
    for rid, text in enumerate(arrays):
        if text is None:
            continue
        value = json.loads(text)
        if not isinstance(value, list):
            continue
        for e in value:
            if e is None:
                continue
            t = e if isinstance(e, str) else json.dumps(e)
            if t.strip(" ") in ("", "null"):
                continue
            if ":" in t:
                attr, val = t.split(":")[0].strip(" "), t.split(":")[1].strip(" ")
            else:
                attr, val = t, t
            if attr in ("", "null"):
                continue
            out.append((rid, attr.strip(" ").lower(), val))
    return sorted(out)


@settings(max_examples=3, deadline=None)
@given(st.lists(array, min_size=20, max_size=60))
def test_review_persona_rules(spark, arrays):
    reviews = spark.createDataFrame(
        [(i, 1, "a", dt.date(2024, 1, 1), j, TS) for i, j in enumerate(arrays)],
        "review_id long, ad_account_id long, review_author string, review_date date, "
        "r_persona_attributes string, loaded_at timestamp")
    analysis = spark.createDataFrame([(i, 3) for i in range(len(arrays))],
                                     "review_creative_analysis_id long, ad_account_id long")
    out = normalize.review_persona_attributes(reviews, analysis)
    got = sorted((r.review_id, r.persona_attribute, r.persona_value) for r in out.collect())
    assert got == expected(arrays)
