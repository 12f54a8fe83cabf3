"""SimHash near-duplicates by pigeonhole blocks (operator 13).

A fingerprint has bit i set if more than half of the hashes of a text's
3-word shingles have it. Fingerprints link at MOST_APART or fewer differing
bits. Of BLOCKS = MOST_APART + 1 blocks of the bits, two linked fingerprints
agree in at least one; so distinct fingerprints are sorted by (block, value)
and the members of one bucket are verified by Hamming distance.

Range partitions deal the buckets, so a hot bucket is spread. What a task
holds of a bucket whole and bounded is linked there. All others (cut by a
partition's border, or too large) go to the next level: the bits on which the
bucket does not agree yet are split into BLOCKS blocks again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personalens.llm.common import binary_texts, pick, read_table, stored
from personalens.llm.ngram_join import components

SHINGLE, SEED = 3, 42
MOST_APART = 3
BLOCKS = MOST_APART + 1
#: Distinct fingerprints of a bucket that one task links at once: 8 bytes each. Larger buckets go to the next level.
BUCKET = 1 << 19
#: Groups up to this size are compared pair by pair.
FEW = 48
#: Hashes whose bits are counted at once.
COUNTED = 1 << 14
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes) -> int:
    """The SimHash of a whole text; no words give zero."""
    words = text.translate(_LOWER).split()  # splits at space and tab to carriage return
    if not words:
        return 0
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate(([0], end[:-1] + 1))
    n = max(len(words) - SHINGLE + 1, 1)
    start, end = start[:n], end[min(SHINGLE, len(words)) - 1:]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for a in range(0, n, COUNTED):
        spans = zip(start[a:a + COUNTED].tolist(), end[a:a + COUNTED].tolist(), strict=True)
        h = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), ">u8", min(COUNTED, n - a))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter(map(fingerprint, binary_texts(batch.column("text"))), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "cls"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and cls, the fingerprint as a signed 64-bit number, of every row; null counts as empty text."""
    return pick(docs).mapInArrow(_fingerprint_batches, "doc_id long, cls long")


def split_mask(free: int) -> list[int]:
    """The free bits as BLOCKS masks of about equal size, from the highest bit on."""
    bits = [1 << i for i in range(63, -1, -1) if free >> i & 1]
    cut = [len(bits) * i // BLOCKS for i in range(BLOCKS + 1)]
    return [sum(bits[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def free_bits(way: int) -> int:
    """Bits on which a bucket need not agree. way: the chosen block at each level, two bits each, below a leading one."""
    free = (1 << 64) - 1
    for level in range((way.bit_length() - 1) // 2 - 1, -1, -1):
        free &= ~split_mask(free)[way >> 2 * level & 3]
    return free


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= MOST_APART


def forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links a-b among n members at most n - 1 that join the same ones: (least member of its component, member)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        for x in (a, b):
            np.minimum.at(root, root[x], low)
            np.minimum.at(root, x, low)
        root = root[root]
        if (root == before).all():
            break
    member = np.flatnonzero(root != np.arange(n))
    return root[member], member


def bucket_links(prints: np.ndarray, bucket: np.ndarray, free: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (a, b) of links that join all linked members of each bucket. Rows are sorted by bucket, prints distinct in it."""
    left, right = [], []
    work = [(np.arange(len(prints)), bucket, free)]
    while work:
        at, group, free = work.pop()
        start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, np.int64)
        size = np.diff(np.append(start, len(group)))
        length, rank = np.repeat(size, size), np.arange(len(group)) - np.repeat(start, size)
        small = length <= FEW  # five free bits or fewer leave no larger group
        for step in range(1, int(length[small].max(initial=1))):
            j = np.flatnonzero(small & (rank >= step))
            ok = near(prints[at[j]], prints[at[j - step]])
            left.append(at[j[ok] - step])
            right.append(at[j[ok]])
        rest = np.flatnonzero(~small)
        if len(rest):  # split the bits that are free in these groups once more
            group, at = np.cumsum(np.concatenate(([True], group[1:] != group[:-1])))[rest].astype(np.uint64), at[rest]
            for mask in split_mask(free):
                value = prints[at] & np.uint64(mask)
                order = np.lexsort((value, group))
                g, v = group[order], value[order]
                new = np.concatenate(([True], (g[1:] != g[:-1]) | (v[1:] != v[:-1])))
                work.append((at[order], np.cumsum(new), free & ~mask))
        if sum(map(len, left)) > 4 * len(prints) + 1024:  # keep no more than a forest
            x, y = forest(len(prints), np.concatenate(left), np.concatenate(right))
            left, right = [x], [y]
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return forest(len(prints), np.concatenate(left), np.concatenate(right))


LINK_SCHEMA = "a long, b long, way int, cls long"


def _rows(a, b, way, cls) -> pa.RecordBatch:
    """Links (a, b), then members (way, cls) of buckets that are left to the next level."""
    none, no_way = pa.nulls(len(cls), pa.int64()), pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([
        pa.concat_arrays([pa.array(a, pa.int64()), none]), pa.concat_arrays([pa.array(b, pa.int64()), none]),
        pa.concat_arrays([no_way.cast(pa.int32()), pa.array(way, pa.int32())]), pa.concat_arrays([no_way, pa.array(cls, pa.int64())])],
        names=["a", "b", "way", "cls"])


def _bucket_batches(whole: bool, most: int):
    """whole: no bucket is cut by the border of a partition. Rows come sorted by (way, value, cls)."""
    def finish(way, value, prints, cut_first, cut_last) -> pa.RecordBatch:
        """Links of the whole buckets, and the rows of the others."""
        edge = np.concatenate(([True], (way[1:] != way[:-1]) | (value[1:] != value[:-1])))
        bucket = np.cumsum(edge) - 1
        size = np.bincount(bucket)
        later = size > most
        later[0] |= cut_first
        later[-1] |= cut_last
        open_ = later[bucket]
        a, b = [], []
        ways = way[~open_]
        for w in np.unique(ways):
            at = np.flatnonzero(~open_ & (way == w))
            x, y = bucket_links(prints[at], bucket[at], free_bits(int(w)))
            a.append(prints[at[x]])
            b.append(prints[at[y]])
        a, b = (np.concatenate(v) if v else np.zeros(0, np.uint64) for v in (a, b))
        return _rows(a.view(np.int64), b.view(np.int64), way[open_], prints[open_].view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, not whole  # the first bucket may have begun in the partition before
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("way", "value", "cls")]
            now[2] = now[2].view(np.uint64)
            held = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            way, value, _ = held
            same = (way == way[-1]) & (value == value[-1])
            last = len(same) - int(same.sum())
            if last >= BUCKET // 4:
                yield finish(*(x[:last] for x in held), first, False)
                held, first = [x[last:] for x in held], False
            elif len(same) - last > most or first and not last:  # a bucket not to be linked here: pass it on as it comes
                if last:
                    yield finish(*(x[:last] for x in held), first, False)
                yield _rows([], [], way[last:-1], held[2][last:-1].view(np.int64))
                held, first = [x[-1:] for x in held], True  # its last row stays, so that its rest is known to be cut
        if held is not None:
            yield finish(*held, first, not whole)
    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each member (way, cls) its BLOCKS buckets at the next level: way, and value, the bits on which the bucket agrees."""
    for batch in batches:
        way, cls = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("way", "cls"))
        for w in np.unique(way):
            x, free = cls[way == w], free_bits(int(w))
            for i, mask in enumerate(split_mask(free)):
                agreed = np.uint64(~free & ((1 << 64) - 1) | mask)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), w << 2 | i), pa.int32()),
                                                  pa.array((x.view(np.uint64) & agreed).view(np.int64)), pa.array(x)],
                                                 names=["way", "value", "cls"])


def near_links(prints: DataFrame, most: int = BUCKET) -> DataFrame:
    """(a, b): links between distinct fingerprints, column cls, that join all that link. most moves work between levels, not the result."""
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, found = prints.select(F.lit(1).alias("way"), "cls"), None
    for level in range(1, 7):
        # Few rows are left, or 12 bits or fewer are free: a task can hold any bucket, and hash partitions cut none.
        whole = level == 6 or level > 1 and rows.count() <= most
        dealt = rows.mapInArrow(_blocks, "way int, value long, cls long")
        dealt = dealt.repartition(n, "way", "value") if whole else dealt.repartitionByRange(n, "way", "value", "cls")
        dealt = dealt.sortWithinPartitions("way", "value", "cls")
        out = stored(dealt.mapInArrow(_bucket_batches(whole, 1 << 62 if whole else most), LINK_SCHEMA), "blocks")
        links = out.where("a IS NOT NULL").select("a", "b")
        found = links if found is None else found.union(links)
        rows = out.where("cls IS NOT NULL").select("way", "cls").distinct()
        if whole:
            break
    return found


def simhash_components(docs: DataFrame, most: int = BUCKET) -> DataFrame:
    """doc_id, cls (fingerprint) and component_id (least doc_id reachable by links) of every row.

    Null, empty and wordless texts have fingerprint zero and link like any other. Equal
    fingerprints are one class, so copies, ties and repeated rows share a component; a null id is never
    the least. A text with fewer words than a shingle has its whole sequence as its one shingle.
    An empty table gives an empty result.
    """
    members = stored(fingerprints(docs), "fingerprints")
    classes = stored(members.groupBy("cls").agg(F.min("doc_id").alias("least_id")), "prints")
    roots = stored(components(near_links(classes.select("cls"), most)), "roots")
    rooted = classes.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    ids = rooted.join(least, "root").select("cls", "component_id")
    return members.join(ids, "cls").select("doc_id", "cls", "component_id")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_components(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("cls"), 16, "0")).alias("fingerprint"), "component_id")
