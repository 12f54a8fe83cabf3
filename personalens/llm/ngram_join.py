"""N-gram Jaccard join, size-aware and heavy-light (operator 6).

Sets of 5-word shingles link when 100 * intersection >= 75 * union. Equal sets
form one class; links are sought between classes. Shingles are ordered from rare
to frequent (by a count sketch over all texts). Two linked sets share, among
the first |s| - ceil(0.75 |s|) + c shingles of each, at least c. Large sets
therefore list their prefix for c = 1 in an inverted index; small sets
enumerate the 2-subsets of their prefix for c = 2. The boundary between
them comes from the estimated cost of both ways.

Short lists give all their pairs. A long list pairs each member with a pivot.
Once the components of the verified links are known, only members of long
lists that lie in different components are paired: first neighbours by size,
at last all that are left. So no list gives all its pairs, and no link between
components is lost.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from personalens.llm.common import Words, binary_texts, in_chunks, merged, mix64, pick, read_table, split_parts, stored

SHINGLE, PERCENT = 5, 75
SKETCH_BITS, BITMAP_BITS = 20, 24
#: Lists up to this length give all their pairs; longer ones go by pivots and components.
SHORT_LIST = 16
#: A key that the sketch expects in more sets than this is salted into runs of about this length.
RUN = 4096
LARGEST_SMALL = 64
#: Words of 64 bits in a set's signature.
SIGNATURE = 16
_K = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
# Verification compares 48 bits of each shingle's hash.
FOLD = 6


def least_overlap(n):
    """Shingles that a set of n shares with any set it links to, at least."""
    return -(-PERCENT * n // 100)


def linked(shared, n_a, n_b):
    return 100 * shared >= PERCENT * (n_a + n_b - shared)


class Sets:
    """Distinct shingles of a chunk of texts: doc (sorted), hash (sorted within a doc), sizes and class of each set."""

    def __init__(self, texts: list[bytes]):
        w = Words(texts)
        h = w.hashes(lower=True)
        if len(h) >= SHINGLE:
            s = h[:1 - SHINGLE] * _K[0]
            for k in range(1, SHINGLE):
                s = s + h[k:len(h) - SHINGLE + 1 + k] * _K[k]
            full = w.doc[:1 - SHINGLE] == w.doc[SHINGLE - 1:]
            doc, s = w.doc[:1 - SHINGLE][full], s[full]
        else:
            doc, s = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        few = np.flatnonzero((w.n > 0) & (w.n < SHINGLE))
        if len(few):
            short = np.zeros(len(few), np.uint64)
            for i, d in enumerate(few):
                at = np.arange(w.first[d], w.first[d + 1])
                with np.errstate(over="ignore"):
                    short[i] = (h[at] * np.array(_K[:len(at)])).sum() + np.uint64(len(at)) * _K[5]
            doc, s = np.concatenate([doc, few]), np.concatenate([s, short])
        s = mix64(s)
        order = np.lexsort((s, doc))
        doc, s = doc[order], s[order]
        if len(s):
            new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (s[1:] != s[:-1])))
            doc, s = doc[new], s[new]
        self.doc, self.hash = doc, s
        self.n = np.bincount(doc, minlength=len(texts))
        self.first = np.concatenate(([0], np.cumsum(self.n)))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(s ^ _K[1]), dtype=np.uint64)))
        sums = total[self.first[1:]] - total[self.first[:-1]]
        self.cls = mix64(sums + self.n.astype(np.uint64) * _K[2]).view(np.int64)


def small_boundary(sizes: dict[int, int], list_length: float) -> int:
    """The size up to which 2-subsets cost less than single prefix shingles.

    sizes: number of sets by size. A key costs one unit to shuffle and sort; a
    single shingle also meets the list_length sets that share it.
    """
    best, cost, at = 0, 0.0, 0.0
    for n in range(3, LARGEST_SMALL + 1):
        p = n - least_overlap(n)
        at += sizes.get(n, 0) * (math.comb(p + 2, 2) - (p + 1) * (1 + list_length))
        if at < cost:
            best, cost = n, at
    return best


def prefix_keys(s: Sets, counts: np.ndarray, boundary: int, rows: np.ndarray):
    """(key, doc, position, salt) of every key of the sets `rows`. Position p: if the key is the first that two sets
    share, n - p is the most they can share, so a 2-subset stands one before its second shingle."""
    of = np.minimum(counts[(s.hash >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], (1 << 24) - 1).astype(np.uint64)
    order = np.lexsort((of << np.uint64(40) | s.hash >> np.uint64(24), s.doc))  # stable: equal ranks stay in order of the hash
    h, doc, rank = s.hash[order], s.doc[order], np.arange(len(s.doc)) - s.first[s.doc]
    n = s.n[doc]
    take = np.zeros(len(s.n), bool)
    take[rows] = True
    single = take[doc] & (rank <= n - least_overlap(n)) & (100 * n > PERCENT * boundary) & (n > 2)
    excess = of[order][single].astype(np.int64) - 2 * int(counts.mean(dtype=float))  # over what mere clashes make
    salt = np.where(excess > RUN, np.minimum(excess // RUN + 1, 1000), 0)
    keys, docs, at = [mix64(h[single])], [doc[single]], [rank[single]]
    salts = [np.where(salt > 0, 1 + s.cls[doc[single]] % np.maximum(salt, 1), 0)]  # 0: an unsalted key
    for d in rows[(s.n[rows] <= boundary) & (s.n[rows] > 2)]:
        p = s.n[d] - least_overlap(s.n[d]) + 2
        x = h[s.first[d]:s.first[d] + p]
        i, j = np.triu_indices(len(x), 1)
        keys.append(mix64(mix64(x[i]) * _K[3] + x[j]))
        docs.append(np.full(len(i), d))
        at.append(j - 1)
        salts.append(np.zeros(len(i), np.int64))
    return np.concatenate(keys), np.concatenate(docs), np.concatenate(at), np.concatenate(salts)


def _member_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document its set's size and class; at the end, parts of the counts of all sets' shingles."""
    names = ["doc_id", "n", "cls", "part", "counts"]
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in batches:
        texts, n, cls = binary_texts(batch.column("text")), [], []
        for a, b in in_chunks(texts):
            s = Sets(texts[a:b])
            counts += np.bincount((s.hash >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
            n.append(s.n)
            cls.append(s.cls)
        if n:
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(n)), pa.array(np.concatenate(cls)),
                                              pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names=names)
    yield from split_parts(counts.astype(np.uint64), names)


def packed(salt: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(salt, position, n) in one number that sorts in this order: 10, 25 and 28 bits."""
    return np.minimum(salt, 1023).astype(np.int64) << 53 | np.minimum(at, (1 << 25) - 1).astype(np.int64) << 28 | n.astype(np.int64)


def _posting_batches(counts, boundary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binary_texts(batch.column("text"))
            for a, b in in_chunks(texts):
                s = Sets(texts[a:b])
                rows = np.unique(s.cls, return_index=True)[1]  # copies in one chunk list their keys once
                key, doc, at, salt = prefix_keys(s, counts.value, boundary, rows)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(packed(salt, at, s.n[doc])), pa.array(s.cls[doc])],
                                                 names=["key", "place", "cls"])
    return run


def may_link(n_a, at_a, n_b, at_b):
    """Whether sets may link whose first common key stands at these positions, from sizes and what can follow."""
    need = -(-PERCENT * (n_a + n_b) // (100 + PERCENT))
    rest = np.minimum(n_a - at_a, n_b - at_b)
    return (100 * np.minimum(n_a, n_b) >= PERCENT * np.maximum(n_a, n_b)) & (rest >= need)


PAIR_SCHEMA = "a long, b long, key long, n int, at int"


def _pair_batches(batches: Iterator[pa.RecordBatch], short: int) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (a, b) of lists sorted by (key, salt, position, n, cls); of long lists also their rows (a = cls, b null)."""
    held: dict[str, np.ndarray] | None = None
    cut = None  # the last list if its beginning was given out already
    for batch in batches:
        now = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "cls")}
        place = batch.column("place").to_numpy(zero_copy_only=False)
        now |= {"salt": place >> 53, "at": (place >> 28 & (1 << 25) - 1).astype(np.int32), "n": (place & (1 << 28) - 1).astype(np.int32)}
        if held is not None:
            now = {c: np.concatenate([held[c], now[c]]) for c in now}
        same = (now["key"] == now["key"][-1]) & (now["salt"] == now["salt"][-1]) if len(now["key"]) else np.zeros(0, bool)
        last = len(same) - int(same.sum())
        end = (now["key"][-1], now["salt"][-1]) if len(same) else cut
        if long := len(same) - last > 4 * RUN:  # much longer than expected: bounded parts, all of them marked as long
            last = len(same)
        held = {c: x[last:] for c, x in now.items()}
        yield from _pairs_of({c: x[:last] for c, x in now.items()}, {cut, end} if long else {cut}, short)
        cut = end if long or end == cut else None
    if held is not None:
        yield from _pairs_of(held, {cut}, short)


def _pairs_of(x: dict[str, np.ndarray], marked: set, short: int) -> Iterator[pa.RecordBatch]:
    """marked: lists (key, salt) of which x holds a part only."""
    if not len(x["key"]):
        return
    again = np.concatenate(([False], (x["key"][1:] == x["key"][:-1]) & (x["cls"][1:] == x["cls"][:-1])))
    x = {c: v[~again] for c, v in x.items()}
    new = np.concatenate(([True], (x["key"][1:] != x["key"][:-1]) | (x["salt"][1:] != x["salt"][:-1])))
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(new)))
    length = np.repeat(size, size)
    salted = x["salt"] > 0
    for part in marked - {None}:
        salted |= (x["key"] == part[0]) & (x["salt"] == part[1])
    i = np.arange(len(new))
    first = np.repeat(start, size)
    left, right = [], []
    for step in range(1, min(short, int(size.max()))):  # all pairs of short lists
        j = i[(length <= short) & (i - first >= step)]
        left.append(j - step)
        right.append(j)
    long = i[length > short]
    if len(long):
        for pivot, row in _pivots(x["n"], first, long):
            left.append(pivot)
            right.append(row)
    a = np.concatenate(left) if left else np.zeros(0, np.int64)
    b = np.concatenate(right) if right else np.zeros(0, np.int64)
    ok = may_link(x["n"][a].astype(np.int64), x["at"][a], x["n"][b].astype(np.int64), x["at"][b])
    lo, hi = x["cls"][a[ok]], x["cls"][b[ok]]
    lo, hi = np.minimum(lo, hi), np.maximum(lo, hi)
    if len(lo):
        lo, hi = np.unique(np.column_stack([lo, hi]), axis=0).T
    heavy = i[(length > short) | salted]
    none = pa.nulls(len(lo), pa.int64())
    yield pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([lo, x["cls"][heavy]])), pa.concat_arrays([pa.array(hi), pa.nulls(len(heavy), pa.int64())]),
        pa.concat_arrays([none, pa.array(x["key"][heavy])]),
        pa.concat_arrays([none.cast(pa.int32()), pa.array(x["n"][heavy])]),
        pa.concat_arrays([none.cast(pa.int32()), pa.array(x["at"][heavy])])], names=["a", "b", "key", "n", "at"])


def _pivots(n: np.ndarray, first: np.ndarray, long: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each row of long lists: the first row of its list in its band of sizes and in the two next to it.

    Lists are sorted by position: a first row has the fewest shingles of its own before the
    shared one, so it is the nearest to what its list has in common.
    """
    band = np.floor(np.log(n[long]) / math.log(100 / PERCENT)).astype(np.int64)
    code = first[long] * 64 + band
    bands, start = np.unique(code, return_index=True)  # rows are in order, so the first of a band comes first
    out = []
    for step in (-1, 0, 1):
        at = np.minimum(np.searchsorted(bands, code + step), len(bands) - 1)
        pivot = long[start[at]]
        ok = (bands[at] == code + step) & (pivot < long)
        out.append((pivot[ok], long[ok]))
    return out


def _bitmap_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << BITMAP_BITS, bool)
    for batch in batches:
        bits[_place(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False))] = True
    yield from split_parts(np.packbits(bits), ["part", "counts"])


def _place(ids: np.ndarray) -> np.ndarray:
    return (mix64(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _held(batch: pa.RecordBatch, bitmap) -> pa.RecordBatch:
    """The rows whose id the bitmap may hold."""
    place = _place(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False))
    return batch.filter(pa.array(bitmap.value[place >> 3] >> (7 - (place & 7)) & 1 == 1))


def _set_batches(bitmap):
    """(cls, shingles) of the documents whose id the bitmap may hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = _held(batch, bitmap)
            texts = binary_texts(batch.column("text"))
            for a, b in in_chunks(texts):
                s = Sets(texts[a:b])
                rows = np.unique(s.cls, return_index=True)[1]
                blobs = [folded(s.hash[s.first[d]:s.first[d + 1]]) for d in rows]
                yield pa.RecordBatch.from_arrays([pa.array(s.cls[rows]), pa.array(blobs, pa.binary())], names=["cls", "shingles"])
    return run


def folded(h: np.ndarray) -> bytes:
    """The leading 48 bits of sorted hashes."""
    return (h >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :FOLD].tobytes()


def unfolded(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // FOLD, 8), np.uint8)
    wide[:, :FOLD] = np.frombuffer(blob, np.uint8).reshape(-1, FOLD)
    return wide.view("<u8").ravel()


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, sets = [], {}
        for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "x", "y")), strict=True):
            for c, blob in ((a, x), (b, y)):
                if c not in sets:
                    if len(sets) > 200:
                        sets.clear()
                    sets[c] = unfolded(blob)
            u, v = sets.get(a), sets.get(b)
            u, v = unfolded(x) if u is None else u, unfolded(y) if v is None else v
            at = np.minimum(np.searchsorted(u, v), len(u) - 1)
            keep.append(linked(int((u[at] == v).sum()), len(u), len(v)))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verify(pairs: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs of classes (a, b) that link, from their representatives' whole sets."""
    bitmap = _wanted(pairs.select(F.col("a").alias("cls")).union(pairs.select("b")), docs, reps)
    # Both joins read one shuffle of the sets.
    sets = docs.mapInArrow(_set_batches(bitmap), "cls long, shingles binary").dropDuplicates(["cls"])
    x = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y"))
    return stored(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verified, "a long, b long"), "links")


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """(cls, root) for every end of a link, root the least class reachable; by large-star and small-star rounds."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    seen = _digest(edges)
    for _ in range(most):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select("u", F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "edges")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    roots = edges.select(F.col("u").alias("cls"), F.col("v").alias("root"))
    return roots.union(edges.select("v", F.col("v").alias("root")).distinct())


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def open_rows(heavy: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (key, cls, n, at, root) of the long lists whose members lie in several components so far."""
    rows = heavy.join(roots.select(F.col("cls").alias("a"), "root"), "a", "left").withColumn("root", F.coalesce("root", "a"))
    rows = rows.select("key", F.col("a").alias("cls"), "n", "at", "root").distinct()
    open_ = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    return stored(rows.join(open_, "key"), "open")


def _may_link(p: str, q: str) -> Column:
    need = F.ceil((F.col(f"{p}n") + F.col(f"{q}n")) * F.lit(PERCENT) / F.lit(100 + PERCENT))
    rest = F.least(F.col(f"{p}n") - F.col(f"{p}at"), F.col(f"{q}n") - F.col(f"{q}at"))
    return (100 * F.least(f"{p}n", f"{q}n") >= PERCENT * F.greatest(f"{p}n", f"{q}n")) & (rest >= need)


def steps(rows: DataFrame) -> DataFrame:
    """Pairs of neighbours by size in a list that lie in different components: at most as many as rows."""
    by = Window.partitionBy("key").orderBy("n", "cls")
    rows = rows.select("cls", "n", "at", "root", *[F.lag(c).over(by).alias(f"q_{c}") for c in ("cls", "n", "at", "root")])
    pairs = rows.where((F.col("root") != F.col("q_root")) & _may_link("", "q_"))
    return pairs.select(F.least("cls", "q_cls").alias("a"), F.greatest("cls", "q_cls").alias("b")).distinct()


def _signature_batches(bitmap):
    """(cls, s0...) of the documents whose id the bitmap may hold: bit i is the parity of the shingles that hash to i."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = _held(batch, bitmap)
            texts = binary_texts(batch.column("text"))
            for a, b in in_chunks(texts):
                s = Sets(texts[a:b])
                rows = np.unique(s.cls, return_index=True)[1]
                bits = (s.hash & np.uint64(64 * SIGNATURE - 1)).astype(np.int64)
                words = np.array([np.packbits(np.bincount(bits[s.first[d]:s.first[d + 1]], minlength=64 * SIGNATURE) & 1).view(np.int64)
                                  for d in rows]).reshape(-1, SIGNATURE)
                yield pa.RecordBatch.from_arrays([pa.array(s.cls[rows]), *(pa.array(w) for w in words.T)],
                                                 names=["cls", *(f"s{i}" for i in range(SIGNATURE))])
    return run


def _wanted(classes: DataFrame, docs: DataFrame, reps: DataFrame):
    """Broadcast bitmap of the ids of the classes' representatives."""
    ids = classes.distinct().join(reps, "cls").select("doc_id")
    bits = merged(ids.mapInArrow(_bitmap_batches, "part int, counts binary"), np.bitwise_or, "u1", 1 << BITMAP_BITS - 3)
    return docs.sparkSession.sparkContext.broadcast(bits)


def bridges(rows: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame:
    """All pairs of members of one long list that lie in different components and may link.

    Two sets differ in at least as many shingles as their signatures do in bits, so a pair
    whose signatures differ in more than linked sets can is left out; that loses no link.
    """
    words = [f"s{i}" for i in range(SIGNATURE)]
    signatures = docs.mapInArrow(_signature_batches(_wanted(rows.select("cls"), docs, reps)),
                                 "cls long, " + ", ".join(f"{w} long" for w in words)).dropDuplicates(["cls"])
    rows = stored(rows.join(signatures, "cls"), "signed")
    apart = functools.reduce(Column.__add__, [F.bit_count(F.col(f"p.{w}").bitwiseXOR(F.col(f"q.{w}"))) for w in words])
    near = apart * (100 + PERCENT) <= (100 - PERCENT) * (F.col("p.n") + F.col("q.n"))
    band = F.floor(F.log("n") / F.lit(math.log(100 / PERCENT))).cast("int")  # sets that link lie in one band or in adjacent ones
    x = rows.withColumn("band", band)
    p, q = x.alias("p"), x.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") - 1))).alias("q")
    on = (F.col("p.key") == F.col("q.key")) & (F.col("p.band") == F.col("q.band")) & (F.col("p.root") != F.col("q.root"))
    pairs = p.join(q, on & _may_link("p.", "q.") & near)
    return pairs.select(F.least("p.cls", "q.cls").alias("a"), F.greatest("p.cls", "q.cls").alias("b")).distinct()


def jaccard_components(docs: DataFrame, short_list: int = SHORT_LIST) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links) of every row.

    Null, empty and wordless texts have the empty set, link with nothing and
    are their own component. Rows with equal sets are one class, so repeated
    rows and ties share a component; a null id is never the least. An empty
    table gives an empty result. short_list moves work between the two ways, not the result.
    """
    return rooted_components(docs, short_list).select("doc_id", "n_shingles", "component_id")


def rooted_components(docs: DataFrame, short_list: int = SHORT_LIST) -> DataFrame:
    """jaccard_components with each row's class and its component's root class; both null for empty sets."""
    spark = docs.sparkSession
    docs = pick(docs)
    first = stored(docs.mapInArrow(_member_batches, "doc_id long, n long, cls long, part int, counts binary"), "members")
    members = first.where("part IS NULL").select("doc_id", "n", F.when(F.col("n") > 0, F.col("cls")).alias("cls"))
    counts = merged(first.where("part IS NOT NULL"), np.add, "u8", 1 << SKETCH_BITS)
    classes = stored(members.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n")), "classes")
    reps = classes.select("cls", "doc_id")
    sizes = {r["n"]: r["k"] for r in classes.where(F.col("n") <= LARGEST_SMALL).groupBy("n").agg(F.count("*").alias("k")).collect()}
    total = float(counts.sum())
    repeats = max(0.0, float((counts.astype(float) ** 2).sum()) / total - total / len(counts)) if total else 0.0
    boundary = small_boundary(sizes, repeats)
    shared = spark.sparkContext.broadcast(np.minimum(counts, (1 << 32) - 1).astype(np.uint32))
    postings = docs.mapInArrow(_posting_batches(shared, boundary), "key long, place long, cls long")
    lists = postings.repartition(F.col("key"), F.shiftright("place", 53)).sortWithinPartitions("key", "place", "cls")
    found = stored(lists.mapInArrow(lambda batches: _pair_batches(batches, short_list), PAIR_SCHEMA), "pairs")
    pairs = stored(found.where("b IS NOT NULL").select("a", "b").distinct(), "candidates")
    links = verify(pairs, docs, reps)
    roots = stored(components(links), "roots")
    heavy, seen = found.where("b IS NULL"), pairs
    for way in (steps, steps, bridges):  # the first two leave few components for the last, which is complete
        rows = open_rows(heavy, roots)
        more = stored((way(rows) if way is steps else way(rows, docs, reps)).join(seen, ["a", "b"], "left_anti"), "more")
        if more.head(1):
            links, seen = links.union(verify(more, docs, reps)), seen.union(more)
            roots = stored(components(links), "roots")
    smallest = roots.join(reps, "cls").groupBy("root").agg(F.min("doc_id").alias("least"))
    least = roots.join(smallest, "root").select("cls", "least", "root")
    ids = classes.join(least, "cls", "left").select("cls", F.coalesce("least", "doc_id").alias("least"), F.coalesce("root", "cls").alias("root"))
    return members.join(ids, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"), "cls", "root")


#: Ids to drop are broadcast up to this many (16 bytes each); beyond, they are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def _with_class(docs: DataFrame, name: str) -> DataFrame:
    """docs and the class of each row's set, null for empty sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binary_texts(batch.column("text"))
            parts = [Sets(texts[a:b]) for a, b in in_chunks(texts)]
            cls = [c if n else None for s in parts for c, n in zip(s.cls.tolist(), s.n.tolist(), strict=True)]
            yield batch.append_column(name, pa.array(cls, pa.int64()))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of docs, with all their columns: of each component the row with the least doc_id, then the least class; null ids last.

    Rows of one id with different sets fare each by its own. Empty sets are linked with nothing:
    of those with one id one stays, and all without an id.
    """
    found = stored(rooted_components(docs), "components")
    if not found.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").head(1):
        gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
        if gone.count() <= BROADCAST_IDS:
            gone = F.broadcast(gone)
        return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "cls")).alias("first")
    kept = found.where("cls IS NOT NULL").groupBy("root").agg(first).select(
        F.col("first.doc_id").alias("kept_id"), F.col("first.cls").alias("kept_cls"))
    name = "cls"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    rows = _with_class(docs, name)
    same = (rows[name] == kept["kept_cls"]) & rows["doc_id"].eqNullSafe(kept["kept_id"])
    empty = rows.where(rows[name].isNull())
    out = rows.join(kept, same, "left_semi").dropDuplicates([name])
    out = out.unionByName(empty.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).unionByName(empty.where("doc_id IS NULL"))
    return out.drop(name)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))
