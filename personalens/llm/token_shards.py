"""Training-order materialisation of token ids (operator 4).

The ids of all documents, each ended by an end id, are cut into sequences of
equal length. A keyed Feistel permutation with cycle-walking gives the sequence
with number g its slot in the training order, without any table. Slots are cut
into ranges, and each range is written as one shard file of fixed-stride
records, so that a reader can go through them in order and resume at any slot by a seek.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from personalens.llm.common import mix64, pick, read_table, scratch
from personalens.llm.pretoken import DEFAULT_TOKENIZER, counter, text_chunks, tokenizer_path

LENGTH, END_ID, ROUNDS, SEED = 2048, 50256, 6, 17
#: Sequences of one shard file.
SHARD = 4096


def permute(index: np.ndarray, size: int, seed: int = SEED, rounds: int = ROUNDS) -> np.ndarray:
    """Bijection of [0, size): Feistel rounds over the next even number of bits, walked until back in range."""
    half = np.uint64(max(1, -(-max(size - 1, 1).bit_length() // 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = [mix64(np.array([seed * 64 + r], np.uint64))[0] for r in range(rounds)]
    x = index.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> half, x[todo] & mask
        for k in keys:
            left, right = right, left ^ (mix64(right ^ k) & mask)
        x[todo] = left << half | right
        todo = todo[x[todo] >= size]
    return x.astype(np.int64)


def unpermute(slot: np.ndarray, size: int, seed: int = SEED, rounds: int = ROUNDS) -> np.ndarray:
    """The sequence number of each slot."""
    half = np.uint64(max(1, -(-max(size - 1, 1).bit_length() // 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = [mix64(np.array([seed * 64 + r], np.uint64))[0] for r in range(rounds)]
    x = slot.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> half, x[todo] & mask
        for k in reversed(keys):
            left, right = right ^ (mix64(left ^ k) & mask), left
        x[todo] = left << half | right
        todo = todo[x[todo] >= size]
    return x.astype(np.int64)


def _sequences(batches: Iterator[pa.RecordBatch], path: str, length: int, end_id: int):
    """(ids, documents, starts, lengths of their pieces) of each sequence of this task, the last one filled up with end ids."""
    c = counter(path)
    ids, doc, first, n = np.zeros(0, c.dtype), [], [], 0  # the open sequence
    for batch in batches:
        doc_ids = batch.column("doc_id").to_pylist()
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for a, b in text_chunks(texts):
            flat, begin, *_ = c.encode_ended(texts[a:b], end_id)
            cut = np.concatenate((begin + n, [begin[-1] + n]))
            ids = np.concatenate([ids, flat])
            doc += doc_ids[a:b]
            first += [(int(x), int(y)) for x, y in zip(cut[:-2], cut[1:-1], strict=True)]
            n = len(ids)
            at = k = 0
            while n - at >= length:
                pieces = []
                while k < len(doc) and first[k][0] < at + length:
                    x, y = max(first[k][0], at), min(first[k][1], at + length)
                    pieces.append((doc[k], x - first[k][0], y - x))
                    if first[k][1] > at + length:
                        break
                    k += 1
                yield ids[at:at + length], pieces
                at += length
            # what is left keeps the place of its first document's beginning, which may lie before it
            doc, first = doc[k:], [(x - at, y - at) for x, y in first[k:]]
            ids, n = ids[at:], n - at
    if n:
        pieces = [(d, max(x, 0) - x, y - max(x, 0)) for d, (x, y) in zip(doc, first, strict=True)]
        yield np.concatenate([ids, np.full(length - n, end_id, ids.dtype)]), pieces


def count_sequences(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID) -> dict[int, int]:
    """Number of sequences of each partition of docs; one row a partition reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, total = counter(path), 0
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in text_chunks(texts):
                total += len(c.encode_ended(texts[a:b], end_id)[0])
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([-(-total // length)])],
                                         names=["part", "n"])

    return {r["part"]: r["n"] for r in docs.mapInArrow(run, "part int, n long").collect()}


ROW_SCHEMA = "shard long, slot long, sequence long, ids binary, doc_ids array<long>, starts array<long>, lengths array<long>"


def _numbered(path: str, length: int, end_id: int, counts: dict[int, int], seed: int, shard_size: int):
    base, total = {}, 0
    for part in sorted(counts):
        base[part], total = total, total + counts[part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, done, pack = TaskContext.get().partitionId(), [], 0, zstandard.ZstdCompressor(1)

        def out() -> pa.RecordBatch:
            number = base[part] + done - len(rows) + np.arange(len(rows))
            slot = permute(number, total, seed)
            pieces = [list(zip(*p, strict=True)) for _, p in rows]
            return pa.RecordBatch.from_arrays(
                [pa.array(slot // shard_size), pa.array(slot), pa.array(number), pa.array([x for x, _ in rows], pa.binary()),
                 *(pa.array([p[i] for p in pieces], pa.list_(pa.int64())) for i in range(3))],
                names=["shard", "slot", "sequence", "ids", "doc_ids", "starts", "lengths"])

        for ids, pieces in _sequences(batches, path, length, end_id):
            rows.append((pack.compress(ids.tobytes()), pieces))
            done += 1
            if len(rows) == 512:
                yield out()
                rows.clear()
        if rows:
            yield out()
        if done != counts.get(part, 0):
            raise RuntimeError(f"partition {part} gave {done} sequences and {counts.get(part, 0)} before; docs must be a stored table")
    return run


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


MANIFEST_SCHEMA = ("shard long, slot long, byte_offset long, sequence long, n_ids long, ids_crc32 long, "
                   "doc_ids array<long>, starts array<long>, lengths array<long>")


def _written(folder: str, shard_size: int, length: int, stride: int):
    """Writes each shard of rows sorted by (shard, slot) as one file, and gives out a manifest row a record.

    A file gets its name when it is whole; a task that is run again writes the same bytes anew.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _file_system(folder)
        unpack, attempt = zstandard.ZstdDecompressor(), TaskContext.get().taskAttemptId()
        shard, file, temporary = None, None, ""

        def close() -> None:
            if file is not None:
                file.close()
                store.move(temporary, f"{top}/{shard_name(shard)}")

        for batch in batches:
            crc = []
            for s, blob in zip(batch.column("shard").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if s != shard:
                    close()
                    shard, temporary = s, f"{top}/.{shard_name(s)}.{attempt}"
                    file = store.open_output_stream(temporary)
                record = unpack.decompress(blob)
                file.write(record)
                crc.append(zlib.crc32(record))
            names = ["shard", "slot", "sequence", "doc_ids", "starts", "lengths"]
            column = {c: batch.column(c) for c in names}
            slot = column["slot"].to_numpy()
            n = np.array([sum(x) for x in column["lengths"].to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [column["shard"], column["slot"], pa.array(slot % shard_size * stride), column["sequence"], pa.array(n), pa.array(crc, pa.int64()),
                 *(column[c] for c in names[3:])],
                names=["shard", "slot", "byte_offset", "sequence", "n_ids", "ids_crc32", *names[3:]])
        close()
    return run


def write_shards(docs: DataFrame, folder: str, path: str | None = None, length: int = LENGTH, end_id: int = END_ID,
                 seed: int = SEED, shard_size: int = SHARD) -> DataFrame:
    """Shard files of all rows' ids in training order below folder (a URI that all executors reach), and their manifest.

    Files are written when the returned manifest is computed. docs must be a table as stored (its partitions are read
    twice and must be the same; this is checked). Null and empty texts give their end id alone;
    repeated rows are written each; an empty table writes nothing.
    """
    spark = docs.sparkSession
    path = path or tokenizer_path(DEFAULT_TOKENIZER)
    docs = pick(docs)
    counts = count_sequences(docs, path, length, end_id)
    store, top = _file_system(folder)
    store.create_dir(top, recursive=True)
    rows = docs.mapInArrow(_numbered(path, length, end_id, counts, seed, shard_size), ROW_SCHEMA)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "shard").sortWithinPartitions("shard", "slot")
    return rows.mapInArrow(_written(folder, shard_size, length, length * counter(path).dtype().itemsize), MANIFEST_SCHEMA)


def read_slots(folder: str, first: int, last: int, length: int = LENGTH, shard_size: int = SHARD, dtype=np.uint16) -> Iterator[np.ndarray]:
    """The records of slots [first, last) in order: one seek, then sequential reads."""
    store, top = _file_system(folder)
    stride = length * np.dtype(dtype).itemsize
    while first < last:
        shard, at = divmod(first, shard_size)
        take = min(last - first, shard_size - at)
        with store.open_input_file(f"{top}/{shard_name(shard)}") as f:
            f.seek(at * stride)
            for _ in range(take):
                yield np.frombuffer(f.read(stride), dtype)
        first += take


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents' shards into a new folder and returns the manifest, one row a sequence."""
    return write_shards(read_table(spark, sf_dir, "documents"), scratch(spark, "shards"))
