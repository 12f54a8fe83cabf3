"""Token operators against the library itself, and exact round trips."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_help import MEDIUM, SMALL, documents, texts_by_id
from personalens.llm import packing, pretoken, token_counts, token_shards
from personalens.llm.common import scratch

LIBRARY = Tokenizer.from_file(pretoken.tokenizer_path())


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(list(" \t\n'strevlmd<|>aé1!  ")), st.characters(exclude_categories=["Cs"])), max_size=30),
                min_size=1, max_size=5))
def test_ids_are_the_librarys(texts):
    texts.append("x<|endoftext|> y'll  z")
    flat, begin, *_ = pretoken.counter(pretoken.tokenizer_path()).encode(texts)
    assert [flat[begin[i]:begin[i + 1]].tolist() for i in range(len(texts))] == [ids_of(t) for t in texts]


def test_every_code_point_splits_as_in_the_library():
    c = pretoken.counter(pretoken.tokenizer_path())
    texts = [f"a{chr(i)}1{chr(i)}!{chr(i)}" for i in range(0x3100) if not 0xD800 <= i < 0xE000]
    flat, begin, *_ = c.encode(texts)
    want = LIBRARY.encode_batch_fast(texts, add_special_tokens=False)
    assert all(flat[begin[i]:begin[i + 1]].tolist() == e.ids for i, e in enumerate(want))


def test_memory_starts_afresh_when_full(monkeypatch):
    monkeypatch.setattr(pretoken, "REMEMBERED", 50)
    c = pretoken.PieceCounter(pretoken.tokenizer_path())
    for k in range(6):
        texts = [" ".join(f"word{k}x{j}" for j in range(30))]
        assert c.encode(texts)[0].tolist() == ids_of(texts[0])
    assert len(c.known) < 120


@pytest.mark.parametrize("heavy", [0, 100, 200_000])
def test_token_counts(spark, monkeypatch, heavy):
    choose = token_counts.frequent
    monkeypatch.setattr(token_counts, "frequent", lambda pieces: choose(pieces, heavy))
    texts = texts_by_id(spark, SMALL)
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.token_counts(documents(spark, SMALL)).collect()}
    assert got == {i: (len(t.encode()), len(ids_of(t))) for i, t in texts.items()}


def test_packing_covers_every_token_once(spark):
    texts = texts_by_id(spark, MEDIUM)
    want = {i: np.array([*ids_of(t), 1], "<u4") for i, t in texts.items()}
    rows = packing.pack(documents(spark, MEDIUM)).collect()
    seen, sequences = {}, {}
    for r in rows:
        assert np.array_equal(np.frombuffer(r.ids, "<u4"), want[r.doc_id][r.start:r.start + r.length]) and r.doc_tokens == len(want[r.doc_id])
        seen.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(seen) == set(want)
    for parts, whole in [*((p, len(want[i])) for i, p in seen.items()), *((p, None) for p in sequences.values())]:
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == whole if whole else at <= 2048
    assert sum(sum(n for _, n in s) < 2048 for s in sequences.values()) <= 4  # one a task at most


def test_index_returns_the_best_unused_neighbour():
    terms = [np.array(t) for t in ([1, 2, 3], [1], [2, 3], [9])]
    weights = [np.ones(len(t), np.float32) for t in terms]
    index = packing.Index(terms, weights)
    unused = np.array([False, True, True, True])
    assert list(index.neighbours(0, unused)) == [2, 1]
    got = list(packing.Packer(0, 8).block([0, 1, 2, 3], [4, 3, 6, 2], terms, weights))
    assert got == [(0, 0, 4, 0, 0), (2, 0, 4, 0, 4), (2, 4, 2, 1, 0), (1, 0, 3, 1, 2), (3, 0, 2, 1, 5)]
    assert [x[0] for x in got[:2]] == [0, 2]


def test_heavy_bins_are_split():
    bins = np.array([10, 10, 1000, 10, 0, 95])
    first, many = packing.plan_shards(bins, 100)
    assert many.tolist() == [1, 1, 10, 1, 1, 1]
    assert (np.diff(first) >= 0).all() and first[3] >= first[2] + 10 - 1


@given(st.integers(1, 3000), st.integers(0, 1 << 40))
@settings(max_examples=60, deadline=None)
def test_permutation_is_a_bijection(n, seed):
    slot = token_shards.permute(np.arange(n), n, seed)
    assert sorted(slot) == list(range(n))
    assert np.array_equal(token_shards.unpermute(slot, n, seed), np.arange(n))


def test_shards_round_trip(spark):
    folder = scratch(spark, "test-shards")
    docs = documents(spark, SMALL)
    rows = sorted(token_shards.write_shards(docs, folder, length=256, shard_size=50).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(len(rows)))
    got = {}
    for record, r in zip(token_shards.read_slots(folder, 0, len(rows), 256, 50), rows, strict=True):
        assert zlib.crc32(record.tobytes()) == r.ids_crc32 and r.byte_offset == r.slot % 50 * 512
        at = 0
        for doc, start, n in zip(r.doc_ids, r.starts, r.lengths, strict=True):
            got.setdefault(doc, {})[start] = record[at:at + n]
            at += n
        assert at == r.n_ids and (record[at:] == token_shards.END_ID).all()
    for i, t in texts_by_id(spark, SMALL).items():
        assert np.concatenate([got[i][k] for k in sorted(got[i])]).tolist() == [*ids_of(t), token_shards.END_ID]
    part = list(token_shards.read_slots(folder, 40, 60, 256, 50))
    assert [zlib.crc32(x.tobytes()) for x in part] == [r.ids_crc32 for r in rows[40:60]]


def test_changed_partitions_are_refused(spark):
    run = token_shards._numbered(pretoken.tokenizer_path(), 16, 1, {0: 5}, 1, 10)
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string").coalesce(1)
    with pytest.raises(Exception, match="stored table"):
        docs.mapInArrow(run, token_shards.ROW_SCHEMA).collect()
