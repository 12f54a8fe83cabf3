"""Packing by lexical retrieval (operator 9).

Texts are tokenised once, into a stored table of ids and the places where words (pre-tokens)
start among them; a word is known by its ids. Each document has
a home: the least hash over its words, weighted towards long words, which are rare, so that
documents with such words in common tend to share it. Homes in order are cut
into shards of about BLOCK_TOKENS. Each shard has a BM25 inverted index over all words of all
its documents; a seed document's unused neighbours, best first, fill its
window up to the last token, and the neighbour that is cut becomes the next seed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personalens.llm.common import give_back_memory, merged, mix64, pick, read_table, span_hashes, split_parts, stored
from personalens.llm.pretoken import DEFAULT_TOKENIZER, counter, id_codes, text_chunks, tokenizer_path

WINDOW, END_ID = 2048, 1
# Words are told apart by this many bits of their hash, counted for document frequencies by fewer; homes are counted by bins.
TERM_BITS, DF_BITS, BIN_BITS = 28, 22, 16
K1, B = 1.2, 0.75
#: Tokens and documents under one index.
BLOCK_TOKENS, BLOCK_DOCS = 1 << 23, 1 << 15
#: Neighbours that are sought one by one; then neighbours that are sorted at first.
SOUGHT, FIRST = 16, 64
#: Words in at least one of so many documents of a block have dense postings too, the most frequent ones up to so many bytes.
DENSE, DENSE_BYTES = 16, 1 << 26
#: Lists of at least so many postings are added as slices, shorter ones gathered.
LONG = 128
POSTING = np.dtype([("doc", np.int32), ("weight", np.float32)])


def doc_terms(hashes: np.ndarray, doc: np.ndarray):
    """(document, term, frequency) sorted by document, each pair once."""
    code = doc.astype(np.uint64) << np.uint64(TERM_BITS) | hashes >> np.uint64(64 - TERM_BITS)
    pair, tf = np.unique(code, return_counts=True)
    return (pair >> np.uint64(TERM_BITS)).astype(np.int64), (pair & np.uint64((1 << TERM_BITS) - 1)).astype(np.int64), tf


def home_keys(hashes: np.ndarray, doc: np.ndarray, length: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Of each document the mixed hash of the word that wins a race at speeds equal to its squared length; of its class if it has no word.

    Two documents have the same winner with a probability that grows with the weight of the words they share.
    """
    key = mix64(cls.view(np.uint64))
    if not len(hashes):
        return key
    time = np.log(((hashes >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / -np.square(length.astype(np.float64))
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    least = np.minimum.reduceat(time, first)
    hit = np.flatnonzero(time == np.repeat(least, np.diff(np.append(first, len(doc)))))
    key[doc[hit]] = mix64(hashes[hit])
    return key


def shards_of(key: np.ndarray, cls: np.ndarray, first: np.ndarray, many: np.ndarray) -> np.ndarray:
    place = (key >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    return first[place] + (mix64(cls.view(np.uint64)) % many[place].astype(np.uint64)).astype(np.int64)


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str]]:
    return (batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64),
            [t or "" for t in batch.column("text").to_pylist()])


def plan_shards(bins: np.ndarray, size: int = BLOCK_TOKENS) -> tuple[np.ndarray, np.ndarray]:
    """First shard and number of shards of each bin: light bins share one, a heavy bin is split by document."""
    many = np.maximum(1, -(-bins // size))
    light = np.where(many == 1, bins, 0)
    group = np.cumsum(light) // size
    first = group + np.concatenate(([0], np.cumsum(np.where(many > 1, many, 0))[:-1]))
    return first, many


def word_hashes(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every word from its ids; starts marks where words and end ids (at `ends`) stand among the ids of several documents."""
    first = np.flatnonzero(starts)
    is_word = np.ones(len(ids), bool)
    is_word[ends] = False
    is_word = is_word[first]
    return span_hashes(id_codes(ids), first[is_word], np.append(first[1:], len(ids))[is_word])


def weighted_terms(ids: list[np.ndarray], starts: list[bytes], idf: np.ndarray, mean_words: float) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of each document its terms, ascending, and their BM25 weights."""
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    marks = [np.unpackbits(np.frombuffer(m, np.uint8), count=k) for m, k in zip(starts, n.tolist(), strict=True)]
    words = np.fromiter((np.count_nonzero(m) for m in marks), np.int64, len(ids)) - 1  # the end id is none
    hashes = word_hashes(np.concatenate(ids), np.concatenate(marks), np.cumsum(n) - 1)
    d, term, tf = doc_terms(hashes, np.repeat(np.arange(len(ids)), words))
    damp = K1 * (1 - B + B * words / max(mean_words, 1.0))
    weight = (idf[term >> TERM_BITS - DF_BITS] * tf * (K1 + 1) / (tf + damp[d])).astype(np.float32)
    cut = np.searchsorted(d, np.arange(1, len(ids)))
    return np.split(term.astype(np.int32), cut), np.split(weight, cut)


def inverse_frequency(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.log1p((n_docs - df + 0.5) / (df + 0.5))


TOKENIZED = "cls long, doc_id long, n long, ids binary, starts binary, words long, key long, part int, counts binary"


def packed_ids(pack, ids: np.ndarray) -> bytes:
    """Ids, first bytes before second bytes."""
    return pack.compress(np.ascontiguousarray(ids.view(np.uint8).reshape(-1, ids.itemsize).T))


def unpacked_ids(unpack, blob: bytes, wide: bool) -> np.ndarray:
    planes = np.frombuffer(unpack.decompress(blob), np.uint8).reshape(4 if wide else 2, -1)
    return np.ascontiguousarray(planes.T).view("<u4" if wide else "<u2").ravel()


def _tokenized(path: str):
    """Of each document its ids with the end id, where words start and its home; at the end, parts of the documents by term and of the tokens by home."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    names = [f.split()[0] for f in TOKENIZED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back_memory()
        c, pack = counter(path), zstandard.ZstdCompressor(1)
        df, bins = np.zeros(1 << DF_BITS, np.uint64), np.zeros(1 << BIN_BITS, np.uint64)
        for batch in batches:
            classes = batch.column("cls").to_numpy(zero_copy_only=False).astype(np.int64)
            _, texts = _texts(batch)
            for a, b in text_chunks(texts):
                flat, begin, hashes, doc, length, size, words = c.encode_ended(texts[a:b], END_ID)
                starts = np.zeros(len(flat), bool)
                starts[(np.cumsum(size) - size + doc)[size > 0]] = True
                starts[begin[1:] - 1] = True
                cell = doc[size > 0] << DF_BITS | (words[size > 0] >> np.uint64(64 - DF_BITS)).view(np.int64)
                cell.sort()
                new = np.flatnonzero(np.diff(cell, prepend=-1))  # words of one cell are one word of a document
                np.add.at(df, cell[new] & (1 << DF_BITS) - 1, np.uint64(1))
                key, n = home_keys(hashes, doc, length, classes[a:b]), np.diff(begin)
                bins += np.bincount((key >> np.uint64(64 - BIN_BITS)).astype(np.int64), n, len(bins)).astype(np.uint64)
                cut = list(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array(classes[a:b]), batch.column("doc_id").slice(a, b - a), pa.array(n),
                    pa.array([packed_ids(pack, flat[x:y]) for x, y in cut], pa.binary()),
                    pa.array([np.packbits(starts[x:y]).tobytes() for x, y in cut], pa.binary()),
                    pa.array(np.bincount(doc[size > 0], minlength=b - a)), pa.array(key.view(np.int64)), pa.nulls(b - a, pa.int32()), pa.nulls(b - a, pa.binary())], names=names)
        for part in split_parts(np.concatenate([df, bins]), ["part", "counts"]):
            yield pa.RecordBatch.from_arrays([*(pa.nulls(part.num_rows, t) for t in types), *part.columns], names=names)
        give_back_memory()  # the counter stays: the worker's next task finds most pre-tokens in it
    return run


class Tokens:
    """The stored rows of a table of documents (see TOKENIZED), and what all its texts together say."""

    def __init__(self, docs: DataFrame, path: str, block_tokens: int):
        context = docs.sparkSession.sparkContext
        rows = stored(docs.mapInArrow(_tokenized(path), TOKENIZED), "tokenized")
        counts = merged(rows.where("part IS NOT NULL"), np.add, "u8", (1 << DF_BITS) + (1 << BIN_BITS))
        df, bins = np.split(counts.astype(np.int64), [1 << DF_BITS])
        self.rows = rows.where("part IS NULL").drop("part", "counts")
        n, words = self.rows.agg(F.count(F.lit(1)), F.sum("words")).first()
        self.mean_words = float(words or 0) / max(n, 1)
        self.idf = context.broadcast(inverse_frequency(df.astype(np.float64), n).astype(np.float32))
        first, many = plan_shards(bins, block_tokens)
        self.plan, self.shards = context.broadcast((first, many)), int((first + many).max())

    def sharded(self) -> DataFrame:
        """The rows with the shard of their home."""
        plan = self.plan

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                key, cls = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "cls"))
                shard = shards_of(key.view(np.uint64), cls, *plan.value)
                yield batch.append_column("shard", pa.array(shard.astype(np.int32), pa.int32()))

        return self.rows.mapInArrow(run, TOKENIZED.replace("part int, counts binary", "shard int"))


class Index:
    """Inverted index of one block: postings by term, with BM25 weights; terms of one document alone are left out, they find none."""

    def __init__(self, terms: list[np.ndarray], weights: list[np.ndarray]):
        self.size = len(terms)
        n = np.fromiter(map(len, terms), np.int64, len(terms))
        term = np.concatenate(terms) if terms else np.zeros(0, np.int32)
        weight = np.concatenate(weights) if weights else np.zeros(0, np.float32)
        code = term.astype(np.int64) << 32 | np.arange(len(term))  # sorted by term, then document
        code.sort()
        order = code & 0xFFFFFFFF
        df = np.diff(np.append(np.flatnonzero(np.diff(code >> 32, prepend=-1)), len(term)))
        postings = np.empty(len(term), POSTING)
        postings["doc"] = np.repeat(np.arange(len(terms)), n)[order]
        postings["weight"] = weight[order]
        word = np.empty(len(term), np.int32)  # of each document's terms, in its order, the number of the word
        word[order] = np.repeat(np.arange(len(df), dtype=np.int32), df)
        self._fill(n, word, df, postings)

    def _fill(self, n: np.ndarray, word: np.ndarray, df: np.ndarray, postings: np.ndarray) -> None:
        """From each document's number of words, their numbers, and the postings of every word in a row; shared words are numbered anew."""
        shared = df > 1
        number = np.cumsum(shared, dtype=np.int32) - np.int32(1)
        has = shared[word]
        self.begin = np.concatenate(([0], np.cumsum(has)))[np.concatenate(([0], np.cumsum(n)))]
        self.word = number[word[has]]
        self.postings, self.df = postings[np.repeat(shared, df)], df[shared]
        self.end = np.cumsum(self.df)
        self.start = self.end - self.df
        rows = np.flatnonzero(self.df * DENSE >= self.size)
        most = DENSE_BYTES // (4 * max(self.size, 1))
        if len(rows) > most:
            rows = rows[np.argsort(-self.df[rows], kind="stable")[:most]]
        self.row = np.full(len(self.df), -1, np.int32)
        self.row[rows] = np.arange(len(rows))
        self.dense = list(np.zeros((len(rows), self.size), np.float32))
        for r, a, b in zip(self.dense, self.start[rows].tolist(), self.end[rows].tolist(), strict=True):
            r[self.postings["doc"][a:b]] = self.postings["weight"][a:b]

    def of(self, member: np.ndarray) -> Index:
        """The index of some of its documents, given in its order."""
        out = object.__new__(Index)
        out.size = len(member)
        place = np.full(self.size, -1, np.int32)
        place[member] = np.arange(len(member))
        doc = place[self.postings["doc"]]
        kept = doc >= 0
        postings = self.postings[kept]
        postings["doc"] = doc[kept]
        df = np.add.reduceat(kept, self.start, dtype=np.int64) if len(self.df) else self.df
        n = np.diff(self.begin)
        out._fill(n[member], self.word[np.repeat(place >= 0, n)], df, postings)
        return out

    def scores(self, seed: int) -> np.ndarray:
        """BM25 score of every other document by all words of the seed."""
        q = self.word[self.begin[seed]:self.begin[seed + 1]]
        row = self.row[q]
        score = np.zeros(self.size, np.float32)
        for r in row[row >= 0].tolist():
            np.add(score, self.dense[r], score)
        rare = q[row < 0]
        if len(rare):
            df = self.df[rare]
            long = df >= LONG
            spans = zip(self.start[rare[long]].tolist(), self.end[rare[long]].tolist(), strict=True)
            short, df = rare[~long], df[~long]
            at = np.repeat(self.start[short] - np.cumsum(df) + df, df) + np.arange(df.sum())
            raw = self.postings.view(np.int64)  # copied as whole numbers
            found = np.concatenate([*(raw[a:b] for a, b in spans), raw.take(at)]).view(POSTING)
            score += np.bincount(found["doc"], found["weight"], self.size).astype(np.float32)
        return score

    def neighbours(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """Unused documents that share a word with the seed, best first; ties in order of the block."""
        score = self.scores(seed) * unused
        for _ in range(SOUGHT):  # most windows take few
            best = int(score.argmax())
            if score[best] <= 0:
                return
            yield best
            score[best] = 0
        found = np.flatnonzero(score > 0)
        if len(found) > 4 * FIRST:  # the best are sorted alone
            least = np.partition(score[found], len(found) - FIRST)[len(found) - FIRST]
            best = found[score[found] >= least]
            yield from best[np.argsort(-score[best], kind="stable")].tolist()
            found = found[score[found] < least]
        yield from found[np.argsort(-score[found], kind="stable")].tolist()


class Packer:
    """Fills windows with pieces (document, start, length); each piece is given out with its sequence and offset."""

    def __init__(self, first_sequence: int, window: int = WINDOW):
        self.sequence, self.used, self.window = first_sequence, 0, window

    def place(self, start: int, total: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the pieces of a document from start on."""
        while start < total:
            length = min(total - start, self.window - self.used)
            yield start, length, self.sequence, self.used
            start, self.used = start + length, self.used + length
            if self.used == self.window:
                self.sequence, self.used = self.sequence + 1, 0

    def block(self, ids: list, sizes: list[int], terms: list[np.ndarray], weights: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, start, length, sequence, offset): every token of the block once."""
        index = Index(terms, weights)
        member, place = np.arange(len(sizes)), list(range(len(sizes)))  # indexed documents, and where each stands in the index
        unused, left = np.ones(len(sizes), bool), len(sizes)  # by place in the index, and their number
        used = bytearray(len(sizes))
        order = iter(range(len(sizes)))
        seed = None
        while True:
            if seed is None:
                seed = next((i for i in order if not used[i]), None)
                if seed is None:
                    return
                used[seed], unused[place[seed]], left = 1, False, left - 1
                for piece in self.place(0, sizes[seed]):
                    yield seed, *piece
            query, seed = seed, None
            if self.used == 0:
                continue
            if 4 * (left + 1) < 3 * len(member) and len(member) > 4 * FIRST:  # index what is left
                unused[place[query]] = True
                kept = np.flatnonzero(unused)
                index, member, unused = index.of(kept), member[kept], np.ones(len(kept), bool)
                for k, i in enumerate(member.tolist()):
                    place[i] = k
                unused[place[query]] = False
            for k in index.neighbours(place[query], unused):
                i = int(member[k])
                if ids[i] == ids[query]:
                    continue  # another row of the same document goes elsewhere
                used[i], unused[k], left = 1, False, left - 1
                before = self.sequence
                for piece in self.place(0, sizes[i]):
                    yield i, *piece
                if self.sequence != before:
                    seed = i if self.used else None  # its rest opens the next window
                    break


PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def size_chunks(sizes: list[int], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive documents of about `limit` ids."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def _packed(window: int, wide: bool, shared_idf, mean_words: float, block_tokens: int, block_docs: int):
    """Sequences of each task, from rows sorted by shard and key; ids as little-endian unsigned 32-bit numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter.cache_clear()  # of the token pass in this worker
        give_back_memory()
        packer, unpack = Packer(TaskContext.get().partitionId() << 32, window), zstandard.ZstdDecompressor()
        idf = shared_idf.value
        rows: list[tuple] = []
        tokens = 0
        for batch in batches:
            doc_ids, sizes, blobs, starts = (batch.column(c).to_pylist() for c in ("doc_id", "n", "ids", "starts"))
            for x, y in size_chunks(sizes):
                ids = [unpacked_ids(unpack, b, wide) for b in blobs[x:y]]
                terms, weights = weighted_terms(ids, starts[x:y], idf, mean_words)
                for row in zip(doc_ids[x:y], sizes[x:y], ids, terms, weights, strict=True):
                    rows.append(row)
                    tokens += row[1]
                    if tokens >= block_tokens or len(rows) >= block_docs:
                        yield from _block(packer, rows)
                        rows, tokens = [], 0
        yield from _block(packer, rows)
        rows.clear()
        give_back_memory()
    return run


def _block(packer: Packer, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if not rows:
        return
    doc_ids, sizes, ids, terms, weights = zip(*rows, strict=True)
    out = []
    for i, start, length, sequence, offset in packer.block(list(doc_ids), list(sizes), list(terms), list(weights)):
        out.append((doc_ids[i], start, length, ids[i][start:start + length], sizes[i], sequence, offset))
        if len(out) >= 512:
            yield _pieces(out)
            out = []
    if out:
        yield _pieces(out)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    end = np.concatenate(([0], np.cumsum([4 * len(x) for x in cols[3]]))).astype(np.int32)
    ids = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(end), pa.py_buffer(np.concatenate(cols[3], dtype="<u4"))])
    return pa.RecordBatch.from_arrays([ids if i == 3 else pa.array(x, pa.int64()) for i, x in enumerate(cols)],
                                      names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces of every row's ids (and an end id) in sequences of at most `window` tokens; see PIECE_SCHEMA.

    Null counts as empty text, which has the end id alone. Repeated rows are packed each. Only a task's
    last sequence is shorter than the window. An empty table gives an empty result.
    Texts are read once; their packed ids and word starts are stored, and shuffled once to the shard of their home.
    """
    path = path or tokenizer_path(DEFAULT_TOKENIZER)
    tokens = Tokens(pick(docs).withColumn("cls", F.xxhash64("doc_id", "text")), path, block_tokens)
    rows = tokens.sharded().repartitionById(tokens.shards, F.col("shard")).sortWithinPartitions("shard", "key", "doc_id", "cls")
    wide = counter(path).dtype == np.uint32
    # A shard may be somewhat larger than planned: up to half as much again stays one block.
    return rows.mapInArrow(_packed(window, wide, tokens.idf, tokens.mean_words, block_tokens * 3 // 2, BLOCK_DOCS), PIECE_SCHEMA)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
