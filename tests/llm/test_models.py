"""Learned scores: held-out accuracy, and what a score may depend on."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from llm_help import MEDIUM, SMALL, documents
from personalens.llm import qda, quality_rules, toxicity

LARGE = "/root/testdata/sf0.1"


def labels(spark, top):
    return spark.read.parquet(f"{top}/labels.parquet")


def test_toxicity_on_held_out_documents(spark):
    model = toxicity.train(documents(spark, LARGE), labels(spark, LARGE))
    out = toxicity.toxicity_scores(documents(spark, LARGE), model).join(labels(spark, LARGE), "doc_id").join(
        documents(spark, LARGE).select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    clean, toxic = [r for r in held if r.toxic == 0], [r for r in held if r.toxic == 1]
    assert sum(r.score >= 0.5 for r in clean) <= 0.01 * len(clean)
    assert sum(r.score >= 0.5 for r in toxic) >= 0.88 * len(toxic)
    rest = [r for r in toxic if r.lang != "en"]  # words with many forms
    assert sum(r.score >= 0.5 for r in rest) >= 0.85 * len(rest)
    assert all(0 <= r.score <= 1 for r in out)
    # The sentences given are where the text offends.
    text = "All is well here. You are a stupid idiot and a clown! Good bye."
    score, spans = model.apply([text.encode()])
    assert score[0] > 0.5 and [text[int(a):int(b)] for a, b, _ in (s.split(":") for s in spans[0].split(","))] == [" You are a stupid idiot and a clown!"]
    # Length alone makes no text toxic.
    texts = documents(spark, LARGE).join(labels(spark, LARGE).where("toxic = 0"), "doc_id").orderBy("doc_id").limit(240).collect()
    long = ["\n".join(r.text or "" for r in texts[i:i + 30]).encode() for i in range(0, 240, 30)]
    assert sum(s < 0.5 for s in model.apply(long)[0]) >= 7


def test_noisy_or_learns_from_document_labels_alone():
    rng = np.random.default_rng(0)
    bags = []
    for _ in range(600):  # word 0 makes a sentence bad, word 1 is harmless
        y = int(rng.random() < 0.3)
        s = [(int(rng.integers(8)), 1) for _ in range(3)] + ([(int(rng.integers(8)), 0)] if y else [])
        bags.append((y, 1.0, [a for a, _ in s], [b for _, b in s]))
    m = toxicity.fit(np.array([1, 2], np.uint64), *zip(*bags, strict=True))
    assert m.lexicon.tolist() == [1] and m.weight[0] > 5  # the harmless word is left out


def test_quality_on_held_out_documents(spark):
    out = qda.quality_scores(documents(spark, MEDIUM), labels(spark, MEDIUM))
    rows = out.join(labels(spark, MEDIUM), "doc_id").where("held_out").collect()
    assert rows and all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)


def test_scores_do_not_use_held_out_labels_or_other_columns(spark):
    docs, marks = documents(spark, SMALL), labels(spark, SMALL)
    before = sorted((r.doc_id, r.score) for r in qda.quality_scores(docs, marks).collect())
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    other = marks.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    changed = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy"))
    after = sorted((r.doc_id, r.score) for r in qda.quality_scores(changed, other).collect())
    assert np.allclose([s for _, s in before], [s for _, s in after])


def test_one_class_and_no_labels(spark):
    docs, marks = documents(spark, SMALL), labels(spark, SMALL)
    for some in (marks.where("quality = 1"), marks.limit(0)):
        assert all(0 <= r.score <= 1 for r in qda.quality_scores(docs, some).collect())
    toxicity.toxicity_scores(docs, toxicity.train(docs, marks.limit(0))).collect()


def test_log_odds_are_those_of_the_two_densities():
    rng = np.random.default_rng(1)
    k = len(qda.FEATURES)
    x = {c: rng.normal(c, 1 + c, (400, k)) for c in (0, 1)}
    m = qda.fit([(c, len(v), v.sum(0), v.T @ v) for c, v in x.items()])
    point = rng.normal(size=(5, k))
    want = []
    for c in (0, 1):
        cov = np.linalg.inv(m.factor[c].T @ m.factor[c])
        d = point - m.mean[c]
        want.append(m.log_prior[c] - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(m.log_odds(point), want[1] - want[0])


def test_quality_rules_keep_clean_documents(spark):
    out = quality_rules.quality_rules(documents(spark, MEDIUM)).join(labels(spark, MEDIUM), "doc_id").where("NOT base_failed").collect()
    good, bad = [r for r in out if r.quality == 1], [r for r in out if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good) and sum(r.kept for r in bad) <= 0.2 * len(bad)
