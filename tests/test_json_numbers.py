"""Texts without numbers keep their form."""

from personalens.functions import json as J
from pyspark.sql import functions as F


def test_texts_without_numbers_are_not_rewritten(spark):
    none = ['["a1", "Brand#12", "x\\\\", "q\\"u"]', "[]", '{"k":true}', "", "[null,false]", '["a1']
    some = ["[1]", "[ -1]", "1", "-2.50", '{"k":3}', '["a",4]', '["a", 0.90]', "['b2']", "[\n7]", '["in 5 days"]']
    assert [r[0] for r in spark.createDataFrame([(t,) for t in none], "t string").select(F.col("t").rlike(J._MAY_HOLD_NUMBER)).collect()] == [False] * len(none)
    rows = spark.createDataFrame([(t,) for t in some], "t string").select(F.col("t").rlike(J._MAY_HOLD_NUMBER), J._numbers_as_strings(F.col("t"))).collect()
    assert all(r[0] for r in rows)
    assert [r[1] for r in rows][:3] == ['["\\u00001"]', '[ "\\u0000-1"]', '"\\u00001"'] and rows[-1][1] == some[-1]
    same = spark.createDataFrame([(t,) for t in none[:-1]], "t string").select(J._numbers_as_strings(F.col("t"))).collect()
    assert [r[0] for r in same] == none[:-1]
