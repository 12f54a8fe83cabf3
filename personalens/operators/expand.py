"""Emit a row ``n`` times without putting a large ``n`` into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_CHUNK = 1_000


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in as many partitions as a shuffle has, however few files they come from: dealt round, or by keys."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def repeat_rows(df: DataFrame, count_col: str, chunk: int = DEFAULT_CHUNK, number: str | None = None) -> DataFrame:
    """Each row of ``df`` ``count_col`` times (the count column is dropped); ``number`` names a column for a copy's number, from 0.

    Rows are first cut into chunks of at most ``chunk`` copies; the chunk rows
    are dealt round to the partitions, whatever their values, and expanded
    there. So neither a row standing for a billion identical output rows nor a
    hot key with many such rows is written by few tasks.
    """
    n = F.col(count_col)
    cols = [c for c in df.columns if c != count_col]
    pieces = df.where(n > 0).select("*", F.explode(
        F.sequence(F.lit(0).cast("long"), ((n - 1) / F.lit(chunk)).cast("long"))).alias("_chunk"))
    size = F.least(F.lit(chunk).cast("long"), n - F.col("_chunk") * chunk)
    copies = spread(pieces).select(*cols, "_chunk", F.explode(F.sequence(F.lit(1).cast("long"), size)).alias("_copy"))
    return copies.select(*cols, *([(F.col("_chunk") * chunk + F.col("_copy") - 1).alias(number)] if number else []))
