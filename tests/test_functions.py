from decimal import Decimal

from pyspark.sql import functions as F

from personalens.functions.numeric import bucketize, guarded_number, safe_ratio


def test_guarded_number(spark):
    vals = ["12.", "3", "-1", "1e3", ".5", "high", "0.25", "12.\n", None, "1 "]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r.n for r in df.select(guarded_number(F.col("t")).alias("n")).collect()]
    assert got == [Decimal("12"), Decimal("3"), None, None, None, None, Decimal("0.25"),
                   None, None, None]


def test_safe_ratio_and_buckets(spark):
    df = spark.createDataFrame([(1.0, 0.0), (3.0, 2.0), (1.0, None), (2.0, -1.0)],
                               "n double, d double")
    got = [r.r for r in df.select(safe_ratio(F.col("n"), F.col("d")).alias("r")).collect()]
    assert got == [0.0, 1.5, 0.0, 0.0]
    b = spark.createDataFrame([(5.0,), (4.99,), (None,), (1.0,)], "p double").select(
        bucketize(F.col("p"), [(5.0, "High"), (1.0, "Low")], "Minimal").alias("b"))
    assert [r.b for r in b.collect()] == ["High", "Low", "Minimal", "Low"]
