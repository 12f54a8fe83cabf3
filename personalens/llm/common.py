"""Shared helpers of the training-data operators: input columns, scratch tables, text batches."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from personalens.session import checkpoint_dir

# Word separators fixed by the contract: space and the controls tab to carriage return.
WORD_SPLIT = r"[\x20\x09-\x0D]+"
# The same characters, for translate().
WORD_SPACE = " \t\n\x0b\f\r"


def ship_package(spark: SparkSession) -> None:
    """Send this library's modules to the Python workers, once per application, wherever they are started."""
    sc = spark.sparkContext
    if getattr(sc, "_personalens_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="personalens-")) / "personalens.zip"  # the driver's own copy; Spark serves it
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(str(target))
    sc._personalens_shipped = True


def with_package(query: Callable) -> Callable:
    """The query or stage, run after its modules were sent to the workers."""
    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        ship_package(spark)
        return query(spark, *args)
    return run


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), so that extra columns can't clash with an operator's own names."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       docs[text_col].cast("string").alias("text"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_text(c: str = "doc_id") -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def crc_fold(c: Column, modulus: int) -> Column:
    """crc32 of the id written as decimal text, modulo `modulus`."""
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(modulus))


def binary_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def in_chunks(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts holding about `limit` bytes (one long text stands alone)."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def small_batches(batches: Iterator[pa.RecordBatch], text_col: str = "text", limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of text (one long text stands alone); memory is given back before and after."""
    give_back_memory()
    for batch in batches:
        start = size = 0
        for i, n in enumerate(pc.binary_length(batch.column(text_col)).fill_null(0).to_pylist()):
            if i > start and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        yield batch.slice(start)
    give_back_memory()


def give_back_memory() -> None:
    """Hand a Python worker's freed memory back to the system; workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


#: A fixed-size array is handed on in so many parts.
PARTS = 64


def split_parts(values: np.ndarray, names: list[str]) -> Iterator[pa.RecordBatch]:
    packed = [zlib.compress(x.tobytes(), 1) for x in np.split(values, PARTS)]
    none = [pa.nulls(PARTS, pa.int64())] * (len(names) - 2)
    yield pa.RecordBatch.from_arrays([*none, pa.array(np.arange(PARTS), pa.int32()), pa.array(packed, pa.binary())], names=names)


def merged(parts: DataFrame, combine: Callable, dtype: str, size: int) -> np.ndarray:
    """One array of that size from many tasks' (part, counts): a fixed size, whatever the number of tasks or rows.

    Each task adds up the parts it gets as they come in; the driver receives PARTS of them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, x in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                x = np.frombuffer(zlib.decompress(x), dtype)
                held[part] = combine(held[part], x) if part in held else x
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())],
                                         names=["part", "counts"])

    rows = parts.select("part", "counts").repartition(PARTS, "part").mapInArrow(run, "part int, counts binary").collect()
    return np.concatenate([np.frombuffer(r["counts"], dtype) for r in sorted(rows, key=lambda r: r["part"])] or [np.zeros(size, dtype)])


class Words:
    """Words of a chunk of texts as arrays: byte start, byte end, index of the text."""

    def __init__(self, texts: list[bytes]):
        lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        self.text_start = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
        space = _IS_SPACE[self.buf]
        edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1)))
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, np.append(self.text_start, len(self.buf)))
        self.n = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.n)

    def hashes(self, lower: bool = False) -> np.ndarray:
        b = _LOWER[self.buf] if lower else self.buf
        return span_hashes(BYTE_CODE[b], self.start, self.end)


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MULT_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * _MULT)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2**64; grown by doubling."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        with np.errstate(over="ignore"):
            _powers = tuple(np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, m))), dtype=np.uint64)
                            for m in (_MULT, _MULT_INV))
    return _powers


def span_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end) of a sequence of 64-bit codes.

    Prefix sums of code * multiplier**position give each span's polynomial
    hash from two look-ups, whatever its length.
    """
    power, inverse = _power_tables(len(codes) + 1)
    prefix = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * power[:len(codes)], out=prefix[1:])
    return mix64((prefix[end] - prefix[start]) * inverse[start])
