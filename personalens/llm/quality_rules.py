"""Quality rules as weak supervision (operator 1, native).

Each rule votes good (+1), bad (-1) or abstains (0). Expectation-maximisation
over the counts of vote patterns estimates the share of good documents and
every rule's accuracy; a document's posterior probability of being good
decides, instead of all rules having to pass.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from personalens.llm.common import WORD_SPACE, pick, read_table, stored

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_marks", "n_stop", "n_lines")

# Frequent function words of the corpus' languages.
STOP_WORDS = ("the of and to in is it a that for de la le et les des un une du der die das und den von "
              "mit zu ist el los las en que y por con se al para").split()
#: (name, condition for good or None, condition for bad or None); neither: the rule abstains.
RULES = (
    ("stop_words", "n_stop >= 0.12 * n_words", "n_stop < 0.03 * n_words"),
    ("symbols", None, "n_symbols > 0.1 * n_words"),
    ("clean_words", "n_symbols = 0 AND n_marks <= 0.02 * n_words AND n_repeat_words = 0", None),
    ("marks", None, "n_marks > 0.2 * n_words"),
    ("repeats", None, "n_repeat_words > 0.15 * n_words"),
    ("lines", None, "n_dup_lines > 0.2 * n_lines"),
    ("word_length", None, "word_chars NOT BETWEEN 2 * n_words AND 14 * n_words"),
)
START_ACCURACY, START_GOOD, ROUNDS, SMOOTHING = 0.8, 0.8, 12, 10.0
#: A rule is taken to be better than chance and never certain.
LEAST, MOST = 0.6, 0.99


def text_stats(docs: DataFrame) -> DataFrame:
    """doc_id and the counts behind the rules, from every whole text (null: no words).

    n_repeat_words marks the words inside 8-word windows found twice or more. Windows are
    compared by a 64-bit hash of their words' 64-bit hashes, built from halves of 2 and 4 words;
    only texts whose 4-word windows repeat look at 8, and only those whose 8-word windows do are sorted.
    """
    def less(c: Column, chars: str) -> Column:
        for x in chars:  # replace() runs over bytes and is much faster here than translate()
            c = F.replace(c, F.lit(x), F.lit(""))
        return F.length(c).cast("long")

    def pairs(c: str, step: int) -> str:
        return f"zip_with(slice({c}, 1, size({c}) - {step}), slice({c}, {step + 1}, size({c})), (a, b) -> xxhash64(a, b))"

    spaced = F.coalesce("text", F.lit(""))
    for x in WORD_SPACE[1:]:
        spaced = F.replace(spaced, F.lit(x), F.lit(" "))
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), spaced.alias("u"))
    d = d.select("doc_id", "t", "u", F.array_remove(F.split("u", " "), "").alias("w"),
                 F.expr(r"filter(split(t, '\n', -1), x -> x rlike '[^\\x20\\x09-\\x0D]')").alias("l"))
    stop = ", ".join(f"'{x}'" for x in STOP_WORDS)
    d = d.select(
        "doc_id", F.size("w").cast("long").alias("n_words"), less(F.col("u"), " ").alias("word_chars"),
        (F.length("t") - less(F.col("t"), SYMBOLS)).alias("n_symbols"),
        (F.length("t") - less(F.col("t"), "!?")).alias("n_marks"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.size("l").cast("long").alias("n_lines"),
        F.expr(f"size(filter(w, x -> x IN ({stop})))").cast("long").alias("n_stop"),
        F.expr("transform(w, x -> xxhash64(x))").alias("h"))
    d = d.withColumn("h2", F.expr(f"CASE WHEN size(h) >= {WINDOW} THEN {pairs('h', 1)} END"))
    d = d.withColumn("h4", F.expr(pairs("h2", 2)))
    d = d.withColumn("g", F.expr(f"CASE WHEN size(array_distinct(h4)) < size(h4) THEN {pairs('h4', 4)} END"))
    d = d.withColumn("s", F.expr(
        "CASE WHEN size(array_distinct(g)) < size(g) THEN array_sort(transform(g, (x, i) -> struct(x AS x, i AS i))) END"))
    d = d.withColumn("p", F.expr(
        "array_sort(transform(filter(s, (e, i) -> e.x <=> get(s, i - 1).x OR e.x <=> get(s, i + 1).x), e -> e.i))"))
    d = d.withColumn("n_repeat_words", F.expr(
        f"coalesce(aggregate(transform(p, (e, i) -> least({WINDOW}, coalesce(get(p, i + 1) - e, {WINDOW}))), 0L, (a, x) -> a + x), 0L)"))
    return d.select("doc_id", *STATS, *MORE)


def vote_sql(good: str | None, bad: str | None) -> str:
    cases = [f"WHEN {c} THEN {v}" for c, v in ((bad, -1), (good, 1)) if c]
    return f"CASE {' '.join(cases)} ELSE 0 END"


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def log_odds(good: float, accuracy: dict[str, float]) -> Column:
    """Log odds of good given the votes, the rules being independent given the class."""
    odds = F.lit(math.log(good) - math.log(1 - good))
    for name, _, _ in RULES:
        odds = odds + F.col(f"v_{name}") * F.lit(math.log(accuracy[name]) - math.log(1 - accuracy[name]))
    return odds


def fit(patterns: DataFrame, rounds: int = ROUNDS) -> tuple[float, dict[str, float]]:
    """Expectation-maximisation over (votes, n) rows, at most 3 ** rules of them.

    A round is one aggregation that returns one row: the expected number of good documents and,
    for each rule, of its votes that are right. Counts are smoothed towards the start values, and
    accuracies kept between LEAST and MOST, so that a bad vote never speaks for a document.
    """
    good, accuracy = START_GOOD, {n: START_ACCURACY for n, _, _ in RULES}
    for _ in range(rounds):
        p = 1 / (1 + F.exp(-log_odds(good, accuracy)))
        sums = [F.sum("n").alias("n"), F.sum(F.col("n") * F.col("p")).alias("good")]
        for name, _, _ in RULES:
            v = F.col(f"v_{name}")
            sums += [F.sum(F.when(v != 0, F.col("n"))).alias(f"n_{name}"),
                     F.sum(F.when(v > 0, F.col("n") * F.col("p")).when(v < 0, F.col("n") * (1 - F.col("p")))).alias(f"r_{name}")]
        r = patterns.withColumn("p", p).agg(*sums).first()
        good = ((r["good"] or 0.0) + SMOOTHING * START_GOOD) / ((r["n"] or 0) + SMOOTHING)
        accuracy = {n: min(MOST, max(LEAST, ((r[f"r_{n}"] or 0.0) + SMOOTHING * START_ACCURACY) / ((r[f"n_{n}"] or 0) + SMOOTHING)))
                    for n, _, _ in RULES}
    return good, accuracy


def quality_rules(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, the counts, the votes, base_failed, posterior and kept, one row per input row.

    Null and empty texts have no words and fail the base rules; repeated rows
    count each; an empty table gives an empty result.
    """
    votes = [F.expr(vote_sql(g, b)).alias(f"v_{n}") for n, g, b in RULES]
    stats = stored(text_stats(pick(docs)).select("*", *votes), "quality")
    names = [f"v_{n}" for n, _, _ in RULES]
    patterns = stored(stats.groupBy(*names).agg(F.count("*").alias("n")), "patterns")
    posterior = 1 / (1 + F.exp(-log_odds(*fit(patterns))))
    out = stats.withColumn("posterior", posterior).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", *STATS, "base_failed", "kept", F.round("posterior", 6).alias("posterior"))


def _sql() -> str:
    stop = ", ".join(f"'{x}'" for x in STOP_WORDS)
    gone = lambda chars: f"(length(t) - length(translate(t, '{chars}', '')))::BIGINT"
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    votes = ", ".join(f"{vote_sql(g, b)} AS v_{n}" for n, g, b in RULES)
    names = ", ".join(f"v_{n}" for n, _, _ in RULES)
    odds = "ln(m.good) - ln(1 - m.good) + " + " + ".join(f"v_{n} * (ln(m.a_{n}) - ln(1 - m.a_{n}))" for n, _, _ in RULES)
    start = ", ".join(f"{START_ACCURACY}::DOUBLE AS a_{n}" for n, _, _ in RULES)
    steps, last = [f"m0 AS (SELECT {START_GOOD}::DOUBLE AS good, {start})"], "m0"
    for k in range(1, ROUNDS + 1):
        a = ", ".join(
            f"least({MOST}::DOUBLE, greatest({LEAST}::DOUBLE, "
            f"(coalesce(sum(CASE WHEN v_{n} > 0 THEN n * p WHEN v_{n} < 0 THEN n * (1 - p) END), 0) + {SMOOTHING * START_ACCURACY})"
            f" / (coalesce(sum(CASE WHEN v_{n} <> 0 THEN n END), 0) + {SMOOTHING}))) AS a_{n}" for n, _, _ in RULES)
        steps.append(f"""m{k} AS MATERIALIZED (SELECT (sum(n * p) + {SMOOTHING * START_GOOD}) / (sum(n) + {SMOOTHING}) AS good, {a}
            FROM (SELECT pat.*, 1 / (1 + exp(-({odds}))) AS p FROM pat, {last} m))""")
        last = f"m{k}"
    chain = ",\n".join(steps)
    return f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
win AS (
  SELECT rid, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS x
  FROM d, unnest(range(1, len(w) - {WINDOW - 2})) AS u(i) WHERE len(w) >= {WINDOW}),
again AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, x) > 1),
rep AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM again, unnest(range(0, {WINDOW})) AS u(k) GROUP BY rid),
s AS MATERIALIZED (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(translate(t, {space}, ''))::BIGINT AS word_chars,
         {gone(SYMBOLS)} AS n_symbols, {gone("!?")} AS n_marks,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(list_filter(w, lambda x: x IN ({stop}))) AS n_stop
  FROM d LEFT JOIN rep USING (rid)),
v AS MATERIALIZED (SELECT *, {votes} FROM s),
pat AS MATERIALIZED (SELECT {names}, count(*) AS n FROM v GROUP BY {names}),
{chain},
f AS (
  SELECT v.*, 1 / (1 + exp(-({odds}))) AS p,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM v, {last} m)
SELECT doc_id, {', '.join(STATS)}, base_failed, NOT base_failed AND p >= 0.5 AS kept, round(p, 6) AS posterior FROM f
"""


SQL = _sql()
