"""Token counts by pre-token frequencies (operator 5).

The pieces of each distinct pre-token are counted once. A text's count is the
sum over its pre-tokens of frequency times pieces; ids are never made per text.
Frequent pre-tokens are joined inside the task, the others by a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personalens.llm.common import mix64, pick, read_table, span_hashes, stored
from personalens.llm.pretoken import DEFAULT_TOKENIZER, counter, text_chunks, tokenizer_path

#: At most so many pre-tokens, the most frequent ones, are sent to all tasks: 12 bytes each.
HEAVY = 200_000
#: Distinct pre-tokens that a task gathers before it hands their counts on.
GATHERED = 300_000
OVER = 512


def distinct_pretokens(docs: DataFrame, path: str) -> DataFrame:
    """(pretoken, occurrences) over all texts; counted within each task before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, total = counter(path), Counter()
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in text_chunks(texts):
                joined, start, end, hashes, _ = c.split(texts[a:b])
                _, at, n = np.unique(hashes, return_index=True, return_counts=True)
                for s, e, k in zip(start[at].tolist(), end[at].tolist(), n.tolist(), strict=True):
                    total[joined[s:e]] += k
                if len(total) > GATHERED:
                    yield _counts(total)
                    total.clear()
        yield _counts(total)

    parts = docs.mapInArrow(count, "pretoken string, occurrences long")
    return parts.groupBy("pretoken").agg(F.sum("occurrences").alias("occurrences"))


def _counts(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                      names=["pretoken", "occurrences"])


def pieces_of(distinct: DataFrame, path: str) -> DataFrame:
    """distinct with the library's number of pieces of each pre-token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            n = [len(ids) for ids in c.pieces(batch.column("pretoken").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int32())], names=[*batch.schema.names, "pieces"])

    return distinct.mapInArrow(run, "pretoken string, occurrences long, pieces int")


def frequent(pieces: DataFrame, limit: int = HEAVY) -> tuple[list[str], list[int]]:
    """The pre-tokens (and their pieces) seen at least 2**k times, for the least k that leaves at most limit."""
    level = F.floor(F.log2("occurrences")).cast("int")
    sizes = {r["k"]: r["n"] for r in pieces.groupBy(level.alias("k")).agg(F.count("*").alias("n")).collect()}
    k, total = max(sizes, default=0) + 1, 0
    while k > 0 and total + sizes.get(k - 1, 0) <= limit:
        k -= 1
        total += sizes.get(k, 0)
    rows = pieces.where(F.col("occurrences") >= (1 << k)).select("pretoken", "pieces").collect() if total else []
    return [r["pretoken"] for r in rows], [r["pieces"] for r in rows]


class HeavyTable:
    """Pieces by pre-token hash: one look at a table of 2**20 places, and a binary search where places clash."""

    def __init__(self, pretokens: list[str], pieces: list[int]):
        size = np.fromiter((len(p) for p in pretokens), np.int64, len(pretokens))
        code = np.frombuffer("".join(pretokens).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        end = np.cumsum(size)
        hashes = span_hashes(mix64(code + np.uint64(1)), end - size, end)
        order = np.argsort(hashes)
        self.hash, self.pieces = hashes[order], np.asarray(pieces, np.int32)[order]

    def open(self) -> HeavyTable:
        self.table = np.zeros(1 << 20, np.int32)
        self.table[(self.hash >> np.uint64(44)).astype(np.int64)] = np.arange(len(self.hash))
        return self

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Pieces of each pre-token; 0 for those not in the table."""
        if not len(self.hash):
            return np.zeros(len(hashes), np.int32)
        at = self.table[(hashes >> np.uint64(44)).astype(np.int64)]
        found = self.hash[at] == hashes
        out = np.where(found, self.pieces[at], 0)
        rest = np.flatnonzero(~found)
        at = np.minimum(np.searchsorted(self.hash, hashes[rest]), len(self.hash) - 1)
        ok = self.hash[at] == hashes[rest]
        out[rest[ok]] = self.pieces[at[ok]]
        return out


def _frequencies(path: str, heavy: HeavyTable):
    """Rows (row, doc_id, n_bytes, n) with the frequent pre-tokens' sum, and (row, pretoken, n = frequency) for each other one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, table = counter(path), heavy.open()
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, texts = batch.column("doc_id"), [t or "" for t in batch.column("text").to_pylist()]
            for a, b in text_chunks(texts):
                joined, start, end, hashes, doc = c.split(texts[a:b])
                pieces = table.find(hashes)
                n_docs = b - a
                total = np.bincount(doc, pieces, n_docs).astype(np.int64)
                rare = np.flatnonzero(pieces == 0)
                order = rare[np.lexsort((hashes[rare], doc[rare]))]
                d, h = doc[order], hashes[order]
                first = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (h[1:] != h[:-1]))))[:len(order)] if len(order) else order
                n = np.diff(np.append(first, len(order)))
                at = order[first]
                words = [joined[s:e] for s, e in zip(start[at].tolist(), end[at].tolist(), strict=True)]
                bytes_ = [len(t.encode()) for t in texts[a:b]]
                none = pa.nulls(len(at), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([row + np.arange(n_docs), row + doc[at]]), pa.int64()),
                    pa.concat_arrays([ids.slice(a, n_docs).cast(pa.int64()), none]),
                    pa.concat_arrays([pa.array(bytes_, pa.int64()), none]),
                    pa.array([None] * n_docs + words, pa.string()),
                    pa.array(np.concatenate([total, n]), pa.int64())], names=["row", "doc_id", "n_bytes", "pretoken", "n"])
                row += n_docs
    return run


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every whole text, one row per input row.

    Null counts as empty text (0 tokens). Special strings in a text count as
    the library counts them by default: one token. Repeated rows are counted each;
    an empty table gives an empty result.
    """
    path = path or tokenizer_path(DEFAULT_TOKENIZER)
    docs = pick(docs)
    pieces = stored(pieces_of(distinct_pretokens(docs, path), path), "pieces")
    heavy = HeavyTable(*frequent(pieces))
    parts = stored(docs.mapInArrow(_frequencies(path, heavy), "row long, doc_id long, n_bytes long, pretoken string, n long"), "frequencies")
    own = parts.where("pretoken IS NULL").select("row", "doc_id", "n_bytes", "n")
    other = parts.where("pretoken IS NOT NULL").join(pieces, "pretoken").select(
        "row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_bytes"), (F.col("n") * F.col("pieces")).alias("n"))
    total = own.unionByName(other).groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens"))
    return total.select("doc_id", "n_bytes", "n_tokens")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path(DEFAULT_TOKENIZER))
    return out.withColumn("over_limit", F.col("n_tokens") > OVER)
