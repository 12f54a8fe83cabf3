"""keep_one where ids repeat or are missing."""

from personalens.llm import ngram_join


def test_rows_fare_by_their_own_text(spark):
    a, b, c = ("alpha one two three four five six seven", "beta nine ten eleven twelve thirteen fourteen fifteen",
               "gamma red green blue black white yellow brown")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, b + " x"), (None, c), (None, "d e f g h i j"), (None, "d e f g h i j"), (None, None), (4, ""), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(docs).collect()), key=repr)
    want = [(1, a), (2, b), (3, c), (None, "d e f g h i j"), (None, None), (4, "")]
    assert got == sorted(want, key=repr)


def test_columns_of_any_name_survive(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 1, 2, 3), (1, "g h i j k l", 4, 5, 6), (2, "a b c d e f", 7, 8, 9)],
                                 "doc_id long, text string, cls int, CLS_ int, _class int")
    got = ngram_join.keep_one(docs)
    assert got.columns == docs.columns and sorted(tuple(r) for r in got.collect()) == [(1, "a b c d e f", 1, 2, 3), (1, "g h i j k l", 4, 5, 6)]
