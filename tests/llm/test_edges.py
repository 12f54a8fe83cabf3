"""Every operator and pipeline stage on edge rows and on empty tables."""

import pytest

import corpus_pipeline
from llm_help import documents
from personalens.llm.registry import QUERIES

PER_ROW = [n for n in QUERIES if not n.startswith(("op4_", "op9_", "op10_", "op11_", "op12_"))]


@pytest.mark.parametrize("name", list(QUERIES))
def test_edge_rows(spark, edge_dir, name):
    rows = QUERIES[name](spark, edge_dir).collect()
    if name in PER_ROW:
        assert len(rows) == documents(spark, edge_dir).count()
    if name.startswith("op6"):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
        assert got[1] == (0, 1) and got[3] == (0, 3) and got[4] == (1, 4)
        assert got[5][1] == got[6][1] == got[7][1] == 5 and got[12] == got[13] == (1, 12)
    if name.startswith("op13_"):
        got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows}
        assert got[1] == got[2] == got[3] == ("0" * 16, 1) and got[5] == got[6] and got[5][1] == 5 and got[12] == got[13]
    if name.startswith("op12_"):
        root, = [r for r in rows if r.depth == 0]
        assert (root.conv_id, root.parent_conv_id, root.n_convs) == (-5, None, 13)
    if name.startswith("op2_"):
        prints = {r.doc_id: r.fingerprint for r in rows}
        assert prints[5] == prints[6] != prints[7] and prints[1] == prints[2]
    if name.startswith("op1_"):
        got = {r.doc_id: r for r in rows}
        assert got[1].base_failed and got[11].n_repeat_words == 40_000 and not got[1].kept


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


def test_stages_on_edge_rows_and_empty_tables(spark, edge_dir, empty_dir):
    for top in (edge_dir, empty_dir):
        docs = documents(spark, top)
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, top)
            if name != "packing":
                assert out.columns == columns, name
                if name == "secret_scan":
                    assert out.count() == docs.count()
            else:
                out.collect()
            docs = spark.createDataFrame(out.collect(), out.schema)
