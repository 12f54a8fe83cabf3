"""Mixing sources to target weights by Poisson replication (operator 10, native)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personalens.llm.common import read_table, stored

# A mean above this is drawn as a sum of independent draws, so that exp(-mean) stays exact.
PART_MEAN = 16.0
# Terms of the distribution function of one draw; beyond them its value is 1 in doubles.
TERMS = 80
# The rates are broadcast only below this measured size; a shuffled join serves otherwise.
BROADCAST_BYTES = 4 << 20
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def uniform(seed: int, *parts: str) -> str:
    """SQL of a number in [0, 1): the first 52 bits of the md5 of the seed and the parts."""
    joined = ", '|', ".join(parts)
    return f"conv(substr(md5(concat('{int(seed)}|', {joined})), 1, 13), 16, 10) / 4503599627370496D"


def mixing_rates(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5,
                 epochs: float = 1.0, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per source: its size, target weight and mean repetition rate.

    Size: code points plus one per document, so never zero. `weights` gives
    target shares by source (sources it leaves out get 0); without it, shares
    are proportional to size**power. rate = epochs * total * share / size.
    The null source is a source of its own.
    """
    size = F.sum(F.length(F.coalesce(docs[text_col], F.lit(""))) + 1).cast("double")
    sizes = stored(docs.groupBy(docs[source_col].alias("mix_source")).agg(size.alias("mix_size")), "sizes")
    if weights is None:
        weight = F.pow("mix_size", F.lit(float(power)))
    else:
        if min(weights.values(), default=0) < 0:
            raise ValueError("weights must not be negative")
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("mix_source") == name, F.lit(float(value))).otherwise(weight)
    sizes = sizes.withColumn("mix_weight", weight)
    total = sizes.agg(F.sum("mix_size").alias("s"), F.sum("mix_weight").alias("w"))
    share = F.col("mix_weight") / F.nullif(total.select("w").scalar(), F.lit(0.0))
    rate = F.coalesce(F.lit(float(epochs)) * total.select("s").scalar() * share / F.col("mix_size"), F.lit(0.0))
    return sizes.withColumn("mix_rate", rate)


def poisson_mix(docs: DataFrame, rates: DataFrame, seed: int = 17, id_col: str = "doc_id",
                source_col: str = "source") -> DataFrame:
    """Each row as often as a Poisson draw of its source's rate says, in a global random order.

    The draw inverts the distribution function at a hash of (seed, id), so a
    rerun or a retried task draws the same. Rates above PART_MEAN are split
    into equal parts whose draws add up. Returns the input's columns (any of
    the new names in the input are replaced) with mix_copy (1..mix_copies), mix_copies,
    mix_rate and mix_key; rows are dealt to partitions and sorted in them by
    mix_key, a hash of (seed, id, copy). Rows with one id get equal draws; a
    null id counts as empty text; null texts are kept; an empty table stays empty.
    """
    own = {"mix_copy", "mix_copies", "mix_rate", "mix_key", "mix_parts", "mix_cdf", "mix_source"}
    docs = docs.select(*[c for c in docs.columns if c not in own])
    parts = F.greatest(F.ceil(F.col("mix_rate") / PART_MEAN), F.lit(1)).cast("int")
    table = rates.select("mix_source", "mix_rate", parts.alias("mix_parts"))
    term = "acc.p * (mix_rate / mix_parts) / k"
    table = table.withColumn("mix_cdf", F.expr(f"""
        aggregate(sequence(1, {TERMS}),
            named_struct('p', exp(-mix_rate / mix_parts), 'c', array(exp(-mix_rate / mix_parts))),
            (acc, k) -> named_struct('p', {term}, 'c', array_append(acc.c, element_at(acc.c, -1) + {term})),
            acc -> acc.c)"""))
    table = stored(table, "rates")
    bytes_ = table.agg(F.sum(F.coalesce(F.octet_length("mix_source"), F.lit(0)) + 8 * TERMS + 64)).first()[0] or 0
    if bytes_ <= BROADCAST_BYTES:
        table = F.broadcast(table)
    joined = docs.join(table, docs[source_col].eqNullSafe(table["mix_source"]))
    key = f"coalesce(cast(`{id_col}` as string), '')"
    u = uniform(seed, key, "cast(j as string)")
    joined = joined.withColumn("mix_copies", F.expr(f"""
        aggregate(transform(sequence(1, mix_parts), j -> {u}), 0,
                  (n, u) -> n + size(filter(mix_cdf, c -> c <= u)))""")).where("mix_copies > 0")
    out = joined.withColumn("mix_copy", F.explode(F.expr("sequence(1, mix_copies)")))
    out = out.withColumn("mix_key", F.expr(f"md5(concat('{int(seed)}|order|', {key}, '|', cast(mix_copy as string)))"))
    out = out.select(*docs.columns, "mix_copy", "mix_copies", "mix_rate", "mix_key")
    return out.repartition("mix_key").sortWithinPartitions("mix_key")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to shares proportional to the root of each source's size."""
    docs = read_table(spark, sf_dir, "documents").select(*DOCUMENT)
    out = poisson_mix(docs, mixing_rates(docs))
    return out.withColumn("mix_rate", F.round("mix_rate", 6))


SQL = f"""
WITH sizes AS (
  SELECT source, sum(length(coalesce(text, '')) + 1)::DOUBLE AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, (SELECT sum(size) FROM sizes) * (sqrt(size) / (SELECT sum(sqrt(size)) FROM sizes)) / size AS rate
  FROM sizes),
parted AS (
  SELECT source, rate, greatest(ceil(rate / {PART_MEAN}), 1)::INTEGER AS parts FROM rates),
pmf AS (
  WITH RECURSIVE r(source, k, p, c) AS (
    SELECT source, 0, exp(-rate / parts), exp(-rate / parts) FROM parted
    UNION ALL
    SELECT r.source, r.k + 1, r.p * (q.rate / q.parts) / (r.k + 1), r.c + r.p * (q.rate / q.parts) / (r.k + 1)
    FROM r JOIN parted q ON r.source IS NOT DISTINCT FROM q.source WHERE r.k < {TERMS})
  SELECT * FROM r),
draws AS (
  SELECT d.doc_id, d.source, q.rate, j,
         ('0x' || substr(md5('17|' || coalesce(d.doc_id::VARCHAR, '') || '|' || j), 1, 13))::BIGINT
           / 4503599627370496::DOUBLE AS u
  FROM (SELECT DISTINCT doc_id, source FROM documents) d
  JOIN parted q ON d.source IS NOT DISTINCT FROM q.source, unnest(range(1, q.parts + 1)) AS t(j)),
counts AS (
  SELECT doc_id, source, rate,
         sum((SELECT count(*) FROM pmf p WHERE p.source IS NOT DISTINCT FROM draws.source AND p.c <= draws.u))::INTEGER AS n
  FROM draws GROUP BY doc_id, source, rate)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, i::INTEGER AS mix_copy, c.n AS mix_copies,
       round(c.rate, 6) AS mix_rate,
       md5('17|order|' || coalesce(d.doc_id::VARCHAR, '') || '|' || i) AS mix_key
FROM documents d JOIN counts c ON d.doc_id IS NOT DISTINCT FROM c.doc_id AND d.source IS NOT DISTINCT FROM c.source,
     unnest(range(1, c.n + 1)) AS t(i)
"""
