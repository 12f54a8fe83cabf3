"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes all that its predecessor kept; all but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personalens.llm import mixing, ngram_join, packing, secrets, toxicity
from personalens.llm.common import read_table, stored, with_package


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or of sentence scores is below one half; trained on the labels outside the held-out fold."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by shingle sets the document with the least id."""
    return ngram_join.keep_one(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets replaced by a mark and n_chars set anew where a text changed."""
    return secrets.redact_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson draws so that sources reach their target weights, in a shuffled order."""
    rows = docs.select("doc_id", "source", F.struct("*").alias("row"))  # whatever the other columns are called
    return mixing.poisson_mix(rows, mixing.mixing_rates(docs)).select("row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of 2048, lexical neighbours together."""
    return packing.pack(docs)


STAGES = [(name, with_package(stage)) for name, stage in (
    ("toxicity", toxicity_stage), ("ngram_jaccard_join", near_copy_stage), ("secret_scan", secret_stage),
    ("mixing", mixing_stage), ("packing", packing_stage))]

# Learned scores, set joins, lexing and packing have no SQL form: tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
