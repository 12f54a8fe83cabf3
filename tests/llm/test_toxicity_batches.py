"""The toxicity stage hands on a few texts at a time."""

from llm_help import SMALL, documents
from personalens.llm import common, toxicity


def test_small_batches_keep_all_rows(spark):
    import pyarrow as pa
    texts = ["a" * 400_000, None, "", *["b" * 700_000] * 5, "é"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    out = list(common.small_batches(iter([batch, batch.slice(0, 0)])))
    assert [t for b in out for t in b.column("text").to_pylist()] == texts
    assert [i for b in out for i in b.column("doc_id").to_pylist()] == list(range(len(texts)))
    assert max(sum(len(t or "") for t in b.column("text").to_pylist()) for b in out) <= 1 << 20


def test_drop_toxic_keeps_the_rows_below_the_threshold(spark):
    docs = documents(spark, SMALL)
    model = toxicity.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, model).collect()}
    assert {r.doc_id for r in toxicity.drop_toxic(docs, model).collect()} == {i for i, s in scores.items() if s < 0.5}
