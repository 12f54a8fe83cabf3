import pytest

from personalens.llm.common import ship_package

# doc_id, text, lang, source, n_chars, and columns whose names the operators use themselves.
EDGE_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, cls long, key long, n int, "
               "shard int, bucket int, part int, mix_copy int, mix_source string, weight double, label int")


def edge_rows():
    prose = "the quick brown fox of the north ran over a lazy dog and then it slept in the warm sun. "
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n\x0b\f\r ", "en", "a", 7), (4, "one", None, None, 3),
        (5, prose * 3, "en", "b", None), (6, prose * 3, "en", "b", None), (7, prose * 3 + "extra", "en", "b", None),
        (8, "idiot! you clown, pathetic trash.", "en", "c", None), (9, 'token = "abcdef0123456789" <|endoftext|> it\'s', "en", "c", None),
        (10, "é ñ 漢字 🙂 don't we'll x", "fr", "c", None), (11, "word " * 40_000, "en", "c", None),
        (12, "a b c d", "en", "c", 7), (13, "a b c d", "en", "c", 7), (13, "a b c d", "en", "c", 7), (None, "lost row of text", "en", "c", 16),
        (14, "x" * 300_000, "en", "c", 300_000), (15, prose.upper(), "en", "c", None), (16, "#$% &&& *** |||", "en", "c", 15),
    ]
    return [(*r, 0.5, 7, 8, 9, 1, 2, 3, 4, "s", 1.0, 1) for r in rows]


TURN_SCHEMA = "conv_id long, turn int, role string, text string, base long, key long, size int, path string, n int, ends string"


def edge_turns():
    """Nulls in every column, ties, repeated rows, a long conversation, negative and absent base ids."""
    rows = [(0, 0, "user", "hello"), (0, 1, "bot", "hi"), (0, 1, "bot", "hi"), (0, None, None, None), (3, 0, "user", "x"), (3, 2, None, "é 漢"),
            (7, 0, "user", "q"), (8, 0, "user", "q"), (9, 0, "user", "q"), (9, 1, "bot", "w" * 100_000), (-3, 0, "user", "minus"),
            (-5, 0, "user", ""), (None, 0, "user", "lost"), (12, None, "user", "b"), (12, None, "user", "a"), (12, None, None, "a")]
    rows += [(20, t, "user", f"turn {t % 4}") for t in range(40)] + [(c, t, "user", f"turn {t % 4}") for c in range(21, 25) for t in range(9)]
    return [(*r, 1, 2, 3, "p", 4, "e") for r in rows]


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    """Tables with nulls in every column, empty and very long texts, ties, repeated rows and clashing extra columns."""
    top = tmp_path_factory.mktemp("edge")
    spark.createDataFrame(edge_rows(), EDGE_SCHEMA).coalesce(2).write.parquet(f"{top}/documents.parquet")
    labels = [(i, i % 2, int(i == 8)) for i in range(1, 17)] + [(None, 1, 1), (2, None, None), (99, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{top}/labels.parquet")
    spark.createDataFrame(edge_turns(), TURN_SCHEMA).coalesce(2).write.parquet(f"{top}/conversations.parquet")
    return str(top)


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("empty")
    spark.createDataFrame([], EDGE_SCHEMA).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    spark.createDataFrame([], TURN_SCHEMA).write.parquet(f"{top}/conversations.parquet")
    return str(top)
