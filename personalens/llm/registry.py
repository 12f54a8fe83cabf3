"""Queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from personalens.llm import (collocations, fingerprints, mixing, ngram_join, packing, prefix_trie, qda, quality_rules, secrets, simhash,
                             token_counts, token_shards, toxicity)
from personalens.llm.common import with_package

QUERIES = {
    "op1_quality_rules": quality_rules.op1,
    "op2_fingerprints": fingerprints.op2,
    "op3_toxicity": toxicity.op3,
    "op4_training_order": token_shards.op4,
    "op5_token_counts": token_counts.op5,
    "op6_ngram_jaccard_join": ngram_join.op6,
    "op7_quality_classifier": qda.op7,
    "op8_secret_scan": secrets.op8,
    "op9_retrieval_packing": packing.op9,
    "op10_mixing": mixing.op10,
    "op11_collocations": collocations.op11,
    "op12_prefix_trie": prefix_trie.op12,
    "op13_simhash": simhash.op13,
}
QUERIES = {name: with_package(query) for name, query in QUERIES.items()}
SQL = {
    "op1_quality_rules": quality_rules.SQL,
    "op10_mixing": mixing.SQL,
    "op11_collocations": collocations.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
}
