from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts_by_id(spark, sf_dir):
    return {r["doc_id"]: r["text"] or "" for r in documents(spark, sf_dir).where(F.col("doc_id").isNotNull()).collect()}
