"""Document fingerprints from prefix polynomial hashes (operator 2).

For each text two modular prefix arrays answer whether any two spans are
equal in constant time and give longest common extensions by binary search.
A fingerprint holds the length, the whole text's hash and the least hashes of all
its WINDOW-long spans, read off the prefix arrays, so that two
fingerprints alone tell equality and an estimate of how much is shared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from personalens.llm.common import mix64, pick, read_table

PRIME = np.uint64((1 << 31) - 1)
BASES = (911382323, 972663749)
WINDOW, KEPT, DIGITS = 16, 48, 12
# Buckets of documents for each shuffle partition: several, so that hashing them to partitions stays even.
BUCKETS = 4

_tables: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of each base and of its inverse modulo PRIME; grown by doubling."""
    global _tables
    if not _tables or len(_tables[0][0]) < n:
        size = 1 << max(14, (n - 1).bit_length())
        _tables = [tuple(_power_row(b, size) for b in (base, pow(base, -1, int(PRIME)))) for base in BASES]
    return _tables


def _power_row(base: int, size: int) -> np.ndarray:
    row = np.ones(1, np.uint64)
    while len(row) < size:
        row = np.concatenate([row, row * np.uint64(pow(base, len(row), int(PRIME))) % PRIME])
    return row


class PrefixHash:
    """Prefix arrays of one text."""

    def __init__(self, text: str):
        self.code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(self.code)
        self.prefix = []
        for power, _ in _powers(self.n + 1):
            p = np.zeros(self.n + 1, np.uint64)
            np.cumsum(self.code * power[:self.n] % PRIME, out=p[1:])
            self.prefix.append(p % PRIME)

    def spans(self, start, end) -> np.ndarray:
        """62-bit hashes of the spans [start, end): equal spans have equal ones."""
        h = [(p[end] + PRIME - p[start]) % PRIME * inverse[start] % PRIME
             for p, (_, inverse) in zip(self.prefix, _powers(self.n + 1), strict=True)]
        return h[0] << np.uint64(31) | h[1]

    def same(self, a: int, b: int, length: int, other: PrefixHash | None = None) -> bool:
        """Whether length code points from a equal those from b (of the other text, if given)."""
        return int(self.spans(a, a + length)) == int((other or self).spans(b, b + length))

    def extension(self, a: int, b: int, other: PrefixHash | None = None) -> int:
        """Longest common extension from a here and b there, by binary search."""
        low, high = 0, min(self.n - a, (other or self).n - b)
        while low < high:
            mid = (low + high + 1) // 2
            if self.same(a, b, mid, other):
                low = mid
            else:
                high = mid - 1
        return low

    def windows(self) -> np.ndarray:
        """Mixed hashes of all WINDOW-long spans; of the whole text if it is shorter."""
        if self.n < WINDOW:
            return mix64(np.atleast_1d(self.spans(0, self.n))) if self.n else np.zeros(0, np.uint64)
        start = np.arange(self.n - WINDOW + 1)
        return mix64(self.spans(start, start + WINDOW))


def least(values: np.ndarray) -> np.ndarray:
    """The KEPT least distinct values, sorted."""
    if len(values) > 8 * KEPT:
        few = np.unique(values[values < np.uint64(2 ** 64 // len(values) * 4 * KEPT)])
        if len(few) >= KEPT:
            return few[:KEPT]
    return np.unique(values)[:KEPT]


class Fingerprint:
    """(length, whole hash, least window hashes); its text form holds all of them."""

    def __init__(self, n: int, whole: int, kept: np.ndarray):
        self.n, self.whole, self.kept = n, whole, np.unique(kept >> np.uint64(64 - 4 * DIGITS))

    def __str__(self) -> str:
        return f"{self.n:x}-{self.whole:016x}-" + "".join(f"{x:0{DIGITS}x}" for x in self.kept.tolist())

    @classmethod
    def parse(cls, s: str) -> Fingerprint:
        n, whole, kept = s.split("-")
        values = [int(kept[i:i + DIGITS], 16) << (64 - 4 * DIGITS) for i in range(0, len(kept), DIGITS)]
        return cls(int(n, 16), int(whole, 16), np.array(values, np.uint64))

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal texts, else twice the estimated shared windows over both texts' windows."""
        if (self.n, self.whole) == (other.n, other.whole):
            return 1.0
        union = np.union1d(self.kept, other.kept)
        if not len(union):
            return 0.0
        union = union[:KEPT] if max(len(self.kept), len(other.kept)) >= KEPT else union
        j = (np.isin(union, self.kept) & np.isin(union, other.kept)).sum() / len(union)
        return float(2 * j / (1 + j))


class Text:
    """A text with its prefix arrays, window hashes and fingerprint."""

    def __init__(self, text: str):
        self.text = text
        self.hash = PrefixHash(text)
        self.wide = self.hash.windows()
        self.fingerprint = Fingerprint(self.hash.n, int(self.hash.spans(0, self.hash.n)), least(self.wide))

    def edited(self, following: Text) -> tuple[str, Fingerprint]:
        """The text whose last half is replaced by the start of the following one, and its fingerprint.

        Only windows across the seam are hashed anew; all others, and the whole
        text's hash, come from the two texts' prefix arrays.
        """
        keep = self.hash.n - self.hash.n // 2
        take = min(self.hash.n // 2, following.hash.n)
        text = self.text[:keep] + following.text[:take]
        n = keep + take
        if n < 4 * WINDOW:
            return text, Text(text).fingerprint
        seam = PrefixHash(text[max(0, keep - WINDOW + 1):keep + WINDOW - 1])
        parts = [self.wide[:max(0, keep - WINDOW + 1)], seam.windows() if seam.n >= WINDOW else seam.code[:0]]
        if take >= WINDOW:
            parts.append(following.wide[:take - WINDOW + 1])
        whole = 0
        for mine, other, (power, _) in zip(self.hash.prefix, following.hash.prefix, _powers(keep + 1), strict=True):
            whole = whole << 31 | (int(mine[keep]) + int(other[take]) * int(power[keep])) % int(PRIME)
        return text, Fingerprint(n, whole, least(np.concatenate(parts)))


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, next_common_prefix long")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, borrowed, id, text): each own row is followed by its next document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *((c, pa.string()) for c in (
        "edited_sha256", "fingerprint", "edited_fingerprint")), ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ("next_common_prefix", pa.int64())])
    last, rows, size = None, [], 0
    for batch in batches:
        for bucket, borrowed, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "borrowed", "doc_id", "text")), strict=True):
            if last and last[0] == bucket and last[1]:
                continue  # a further borrowed row of this bucket
            here = Text(text)
            if last and last[0] == bucket:
                rows.append(_row(last[2], last[3], here))
            last = (bucket, borrowed, doc_id, here)
            if len(rows) >= 2000:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
    yield pa.RecordBatch.from_pylist(rows, schema)


def _row(doc_id: int, mine: Text, following: Text) -> dict:
    text, edited = mine.edited(following)
    return {"doc_id": doc_id, "n_chars": mine.hash.n, "edited_sha256": hashlib.sha256(text.encode()).hexdigest(),
            "fingerprint": str(mine.fingerprint), "edited_fingerprint": str(edited),
            "near_edited": mine.fingerprint.likeness(edited), "near_next": mine.fingerprint.likeness(following.fingerprint),
            "next_common_prefix": mine.hash.extension(0, 0, following.hash)}


def _bucket(key: Column, bounds: list[int], first: int = 0) -> Column:
    """Number of bounds at or below the key, as a tree of comparisons."""
    if not bounds:
        return F.lit(first)
    mid = len(bounds) // 2
    return F.when(key < bounds[mid], _bucket(key, bounds[:mid], first)).otherwise(_bucket(key, bounds[mid + 1:], first + mid + 1))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text, and how near it is to its edited text's and to the next document's.

    Next: in ascending (id, text), a null id first, the last followed by the first; a lone
    row follows itself. Null counts as empty text. An empty table gives an empty result.
    Ids are cut into buckets at approximate quantiles; each bucket also gets
    the first document of the next one, so one shuffle of the texts brings
    neighbours together and no task holds more than two texts at a time.
    """
    spark = docs.sparkSession
    docs = pick(docs).withColumn("text", F.coalesce("text", F.lit("")))
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    n = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 10_000)).first()[0] or []
    docs = docs.withColumn("bucket", _bucket(key, sorted(set(cuts))))
    firsts = {r["bucket"]: r["k"] for r in docs.groupBy("bucket").agg(F.min(key).alias("k")).collect()}
    order = sorted(firsts)
    before = {b: order[i - 1] for i, b in enumerate(order)}
    lend = F.lit(None).cast("int")
    if order:
        place = F.element_at(F.array(*[F.lit(before.get(b, 0)) for b in range(max(order) + 1)]), F.col("bucket") + 1)
        lend = F.when(key.isin(list(firsts.values())), place)
    own, lent = F.struct("bucket", F.lit(0).alias("borrowed")), F.struct(lend.alias("bucket"), F.lit(1).alias("borrowed"))
    at = F.explode(F.when(lend.isNull(), F.array(own)).otherwise(F.array(own, lent)))
    rows = docs.select("doc_id", "text", at.alias("at")).select("at.bucket", "at.borrowed", "doc_id", "text")
    rows = rows.repartition(max(1, n // BUCKETS), "bucket").sortWithinPartitions("bucket", "borrowed", "doc_id", "text")
    return rows.mapInArrow(_pairs, SCHEMA)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))
