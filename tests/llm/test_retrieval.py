"""Neighbours of the packing index against brute-force BM25."""

import math

import numpy as np
import zstandard
from pyspark.sql import functions as F

from llm_help import MEDIUM, SMALL, documents
from personalens.llm import packing, pretoken
from personalens.llm.common import pick

FEW = 300


def brute_scores(texts):
    """BM25 of every text for every text as a query: all words, by their own spelling."""
    c = pretoken.counter(pretoken.tokenizer_path())
    bags = []
    for t in texts:
        joined, start, end, *_ = c.split([t])
        words = [joined[a:b] for a, b in zip(start, end, strict=True)]
        bags.append({w: words.count(w) for w in set(words)})
    df = {}
    for bag in bags:
        for w in bag:
            df[w] = df.get(w, 0) + 1
    size = [sum(b.values()) for b in bags]
    mean = sum(size) / len(size)
    postings = {}
    for d, bag in enumerate(bags):
        for w, f in bag.items():
            idf = math.log1p((len(bags) - df[w] + 0.5) / (df[w] + 0.5))
            weight = idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * size[d] / mean))
            postings.setdefault(w, []).append((d, weight))
    out = np.zeros((len(bags), len(bags)))
    for q, bag in enumerate(bags):
        for w in bag:
            for d, weight in postings[w]:
                out[q, d] += weight
    np.fill_diagonal(out, 0)
    return out


def recall(found, scores):
    """Share of documents whose found neighbour scores as the best one does."""
    return np.mean([j is not None and scores[i, j] >= 0.999 * scores[i].max() for i, j in found.items() if scores[i].max() > 0])


def found_in_blocks(docs, block_tokens):
    """Best neighbour of every row in the shard it is packed in, and the number of shards."""
    tokens = packing.Tokens(docs, pretoken.tokenizer_path(), block_tokens)
    homed = sorted(tokens.sharded().collect(), key=lambda r: (r.shard, r.key, r.doc_id))
    unpack, near = zstandard.ZstdDecompressor(), {}
    shards = {r.shard for r in homed}
    for shard in shards:
        block = [r for r in homed if r.shard == shard]
        ids = [packing.unpacked_ids(unpack, r.ids, False) for r in block]
        index = packing.Index(*packing.weighted_terms(ids, [r.starts for r in block], tokens.idf.value, tokens.mean_words))
        for i, r in enumerate(block):
            others = np.array([x.cls != r.cls for x in block])
            best = next(index.neighbours(i, others), None)
            near[r.cls] = None if best is None else block[best].cls
    return near, len(shards)


def test_neighbours_are_those_of_brute_force_bm25(spark):
    docs = pick(documents(spark, MEDIUM)).where("length(text) > 0").orderBy("doc_id").limit(FEW)
    docs = docs.withColumn("cls", F.xxhash64("doc_id", "text")).cache()
    rows = docs.collect()
    scores = brute_scores([r.text for r in rows])
    place = {r.cls: i for i, r in enumerate(rows)}

    def of(block_tokens):
        near, shards = found_in_blocks(docs.repartition(4), block_tokens)
        return recall({place[c]: place.get(n) for c, n in near.items()}, scores), shards

    one, shards = of(packing.BLOCK_TOKENS)
    assert shards == 1 and one >= 0.97
    many, shards = of(sum(len(r.text) for r in rows) // 16)
    print(f"recall of the best neighbour: {one:.3f} in one block, {many:.3f} over {shards} blocks")
    assert shards > 2 and many >= 0.15  # texts without a subject in common meet by chance, copies by their home


def test_copies_share_a_home_and_blocks_are_bounded(spark):
    texts = [f"alpha{i % 5} beta gamma{i % 5} delta epsilon{i % 5}" for i in range(50)] + [""] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("cls", F.xxhash64("doc_id", "text"))
    key = {r.doc_id: r.key for r in packing.Tokens(docs, pretoken.tokenizer_path(), packing.BLOCK_TOKENS).rows.collect()}
    assert all(key[i] == key[i % 5] for i in range(50)) and len({key[i] for i in range(50, 90)}) == 40


def test_packing_places_every_id_once_at_any_block_size(spark):
    docs = documents(spark, SMALL)
    want = {}
    for block_tokens in (packing.BLOCK_TOKENS, 5000):
        rows = packing.pack(docs, block_tokens=block_tokens).collect()
        pieces, used = {}, {}
        for r in rows:
            pieces.setdefault(r.doc_id, []).append((r.start, r.length, bytes(r.ids)))
            used.setdefault(r.sequence_id, []).append((r.offset, r.length))
        joined = {}
        for d, p in pieces.items():
            at = 0
            for start, length, ids in sorted(p):
                assert start == at and len(ids) == 4 * length
                at += length
            joined[d] = b"".join(ids for *_, ids in sorted(p))
        for p in used.values():
            assert [o for o, _ in sorted(p)] == list(np.cumsum([0] + [n for _, n in sorted(p)][:-1])) and sum(n for _, n in p) <= 2048
        want = want or joined
        assert joined == want and len(joined) == docs.count()
