"""The pipeline against a brute-force version of its stages."""

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from llm_help import SMALL, documents
from personalens.llm import mixing, pretoken, secrets, toxicity
from test_sets_and_spans import brute_components


def test_stages_follow_each_other(spark):
    secret = [(900_001, 'mail me, password = "hunter2hunter2" is mine', "en", "src1", 44)]
    start = documents(spark, SMALL).unionByName(spark.createDataFrame(secret, documents(spark, SMALL).schema)).cache()
    docs, seen = start, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = stage(spark, docs, SMALL)
        docs = spark.createDataFrame(seen[name].collect(), seen[name].schema)
    rows = {r.doc_id: r for r in start.collect()}
    model = toxicity.train(start, spark.read.parquet(f"{SMALL}/labels.parquet"))
    score, _ = model.apply([(r.text or "").encode() for r in rows.values()])
    kept = {i: r.text or "" for (i, r), s in zip(rows.items(), score, strict=True) if s < 0.5}
    assert {r.doc_id for r in seen["toxicity"].collect()} == set(kept)
    kept = {i: kept[i] for i, (_, c) in brute_components(kept).items() if i == c}
    assert {r.doc_id for r in seen["ngram_jaccard_join"].collect()} == set(kept)
    clean = {i: secrets.redact(t) for i, t in kept.items()}
    out = seen["secret_scan"].collect()
    assert {r.doc_id: r.text for r in out} == clean and any(clean[i] != kept[i] for i in kept)
    assert all(r.n_chars == (len(clean[r.doc_id]) if clean[r.doc_id] != kept[r.doc_id] else rows[r.doc_id].n_chars) for r in out)
    times = {}
    for r in seen["mixing"].collect():
        assert r.text == clean[r.doc_id]
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    mixed = mixing.poisson_mix(spark.createDataFrame(out, seen["secret_scan"].schema), mixing.mixing_rates(spark.createDataFrame(out, seen["secret_scan"].schema)))
    assert times == {r.doc_id: r.mix_copies for r in mixed.collect()}
    library = Tokenizer.from_file(pretoken.tokenizer_path())
    tokens = {}
    for r in seen["packing"].collect():
        whole = np.array([*library.encode(clean[r.doc_id], add_special_tokens=False).ids, 1], "<u4")
        assert np.array_equal(np.frombuffer(r.ids, "<u4"), whole[r.start:r.start + r.length])
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    assert tokens == {i: n * (len(library.encode(clean[i], add_special_tokens=False).ids) + 1) for i, n in times.items()}


def test_run_applies_all_stages(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.count() > 0 and "sequence_id" in out.columns
