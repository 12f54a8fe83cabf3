"""Sources and sinks (SRC-1..3, SNK-1..3).

Raw tables are read with declared schemas (never inferred); the product
mapping table is a CSV with a header, quoted JSON text and doubled quotes.
Staging models are lazy views; intermediate models are written as tables
(full rebuild), one namespace per layer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEED_SCHEMA = ("ad_account_id bigint, ad_account_name string, product string, "
               "matched_review_product string, review_account_name string, "
               "review_account_id bigint")

# A quoted cell may hold line ends.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}
BAD_ROW = "_bad_row"


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """SRC-1/2: a raw table with a declared schema."""
    return spark.read.schema(schema).format(fmt).load(path)


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: the product mapping CSV with its column types; rows that don't fit them are left to :func:`bad_seed_rows`."""
    return _seed_rows(spark, path).where(F.col(BAD_ROW).isNull() & _cells().isNotNull()).drop(BAD_ROW)


def bad_seed_rows(spark: SparkSession, path: str) -> DataFrame:
    """Text, readable cells (JSON) and file of the CSV's rows with too few or too many cells, or cells of another type."""
    rows = _seed_rows(spark, path).withColumn("file", F.input_file_name())
    return rows.where(F.col(BAD_ROW).isNotNull()).select(F.col(BAD_ROW).alias("row_text"), _cells().alias("cells"), "file")


def _cells() -> Column:
    """All cells as JSON: Spark refuses to look for bad rows alone, and parses only the cells that a query asks for."""
    return F.to_json(F.struct(*[c.split()[0] for c in SEED_SCHEMA.split(", ")]))


def _seed_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{SEED_SCHEMA}, {BAD_ROW} string").options(
        **CSV_OPTIONS, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_ROW).csv(path)


def write_seed_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """SNK-1: expose a model as a (lazy) temporary view."""
    df.createOrReplaceTempView(name)
    return df


def write_table(df: DataFrame, name_or_path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, path: str | None = None) -> None:
    """SNK-2: full rebuild of a model, as a catalog table (at ``path``, if given) or a path."""
    w = df.write.mode("overwrite").format(fmt)
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in name_or_path:
        w.save(name_or_path)
    else:
        w.saveAsTable(name_or_path)


def ensure_namespace(spark: SparkSession, name: str) -> None:
    """SNK-3: one namespace per layer (staging, intermediate, analytics)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
