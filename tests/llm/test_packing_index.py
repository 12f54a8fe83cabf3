"""The packing index gets smaller and denser without another order; the memory of pre-tokens outlives a task."""

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from personalens.llm import packing, pretoken


def block(rng, n, words):
    terms = [np.unique(np.minimum(rng.zipf(1.3, 40), words)).astype(np.int32) for _ in range(n)]
    return terms, [rng.random(len(t)).astype(np.float32) for t in terms]


def brute_order(terms, weights, seed, unused):
    total = np.zeros(len(terms))
    for i, (t, w) in enumerate(zip(terms, weights, strict=True)):
        total[i] = w[np.isin(t, terms[seed])].astype(float).sum()
    return [i for i in np.argsort(-total, kind="stable").tolist() if unused[i] and total[i] > 0], total


def test_neighbours_are_in_order_with_dense_rows_or_without(monkeypatch):
    rng = np.random.default_rng(5)
    terms, weights = block(rng, 600, 3000)
    for dense_bytes in (0, 3 * 4 * 600, 1 << 26):
        monkeypatch.setattr(packing, "DENSE_BYTES", dense_bytes)
        index = packing.Index(terms, weights)
        assert 4 * 600 * len(index.dense) <= dense_bytes
        for seed in (0, 17, 599):
            unused = rng.random(600) < 0.7
            unused[seed] = False
            want, total = brute_order(terms, weights, seed, unused)
            got = list(index.neighbours(seed, unused))
            assert sorted(got) == sorted(want) and np.allclose(total[got], total[want], rtol=1e-4)


def test_index_of_some_documents_is_the_index_made_of_them():
    rng = np.random.default_rng(6)
    terms, weights = block(rng, 500, 2000)
    member = np.flatnonzero(rng.random(500) < 0.4)
    part = packing.Index(terms, weights).of(member)
    whole = packing.Index([terms[i] for i in member], [weights[i] for i in member])
    assert np.array_equal(part.df, whole.df) and np.array_equal(part.begin, whole.begin) and (part.df > 1).all()
    for k in range(len(member)):
        assert np.array_equal(part.scores(k), whole.scores(k))
    assert packing.Index(terms, weights).of(member[:1]).scores(0).tolist() == [0.0]


def test_a_block_places_every_document_once_while_its_index_shrinks():
    rng = np.random.default_rng(7)
    terms, weights = block(rng, 900, 2000)
    sizes = rng.integers(1, 60, 900).tolist()
    got = list(packing.Packer(0, 64).block((np.arange(900) // 2).tolist(), sizes, terms, weights))
    placed = np.bincount([i for i, *_ in got], [n for _, _, n, *_ in got])
    assert placed.tolist() == sizes


def test_numbers_are_found_again_after_growth_and_clashes():
    rng = np.random.default_rng(8)
    hashes = np.unique(np.concatenate([rng.integers(0, 1 << 64, 400_000, np.uint64), np.arange(5000, dtype=np.uint64)]))  # the last ones clash
    rng.shuffle(hashes)
    known = pretoken.Numbers()
    for part in np.array_split(hashes, 7):
        assert (known.find(part) == -1).all()
        known.add(part)
    assert len(known) == len(hashes) and np.array_equal(known.find(hashes), np.arange(len(hashes)))
    assert (known.find(np.arange(1 << 40, (1 << 40) + 1000, dtype=np.uint64)) == -1).all()


def test_the_next_task_of_a_worker_calls_the_library_for_new_words_alone(monkeypatch):
    path, asked = pretoken.tokenizer_path(), []
    pretoken.counter.cache_clear()
    real = pretoken.PieceCounter.flat_pieces
    monkeypatch.setattr(pretoken.PieceCounter, "flat_pieces", lambda self, words: asked.append(list(words)) or real(self, words))
    library = Tokenizer.from_file(path)

    def task(text):
        rows = pa.RecordBatch.from_pydict({"cls": [1], "doc_id": [1], "text": [text]})
        out = pa.Table.from_batches(packing._tokenized(path)(iter([rows]))).to_pylist()[0]
        ids = packing.unpacked_ids(packing.zstandard.ZstdDecompressor(), out["ids"], False).tolist()
        assert ids == [*library.encode(text, add_special_tokens=False).ids, packing.END_ID]

    task("one two three <|endoftext|>")
    task("one two three <|endoftext|> four")
    assert sum(asked[1:], []) == [" four"]
    pretoken.counter.cache_clear()
