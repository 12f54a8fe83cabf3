"""Phrase collocations from FM-indexes over word ids (operator 11).

Texts are cut into pieces at punctuation and line ends and written as word ids, one
shard a language and some two million words. Each shard has two indexes of the
Burrows-Wheeler kind, sorted only as deep as phrases go: one by following words,
one by preceding words. A phrase is an interval in both; extending it by a word
on either side is one look at the other words' ranks. Intervals give the
phrases of a shard with their counts; counts are summed across shards.

Shards are read level by level: a phrase is extended only where both its parts
may have the support (bitmaps of the frequent words and pairs; a clash costs
work, not correctness).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from personalens.llm.common import merged, mix64, read_table, split_parts, stored

DEPTH = 3
SUPPORT, COVERED, TOP = 10, 50, 2000
SCALE = 1_000_000
#: Words of a shard.
SHARD_WORDS = 1 << 21
#: Bits of a bitmap of frequent phrases, sent to all tasks.
BITMAP_BITS = 25
#: Index entries that are extended at once.
ENTRIES = 1 << 17
#: Words of text for each bucket of phrases; a task sums one bucket at a time.
BUCKET_WORDS = 1 << 18
CUT = b"\xff"  # no byte of UTF-8: stands between pieces
_PLAIN = bytearray(range(256))
for _upper in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _PLAIN[_upper] = _upper + 32
for _end in b".,;:!?\n\x0b\x0c\r":
    _PLAIN[_end] = 0xFF
_PLAIN[0x09] = 0x20
_PLAIN = bytes(_PLAIN)


class _Ids(dict):
    """Word ids of a shard in order of their first use; 0 cuts pieces."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


SHARDS = "lang string, n long, words binary, following binary, preceding binary"


def _shard_batches(size: int):
    """Index shards of a task's texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[_Ids, list]] = {}
        total: dict[str, int] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist(), strict=True):
                if lang not in held:
                    held[lang], total[lang] = (_Ids({CUT: 0}), [np.zeros(1, np.int32)]), 0
                ids, parts = held[lang]
                words = (text or b"").translate(_PLAIN).replace(CUT, b" \xff ").split(b" ")
                x = np.fromiter(map(ids.__getitem__, filter(None, words)), np.int32)
                parts += [x, np.zeros(1, np.int32)]
                total[lang] += len(x)
                if total[lang] >= size:
                    yield _shard(lang, *held.pop(lang))
                    del total[lang]
                elif sum(total.values()) >= 2 * size or len(held) > 4096:  # many languages: all of them at once
                    for key in list(held):
                        yield _shard(key, *held.pop(key))
                    total.clear()
        for lang, x in held.items():
            yield _shard(lang, *x)
    return run


def _shard(lang: str, ids: _Ids, parts: list) -> pa.RecordBatch:
    del ids[CUT]
    words = sorted(ids)  # ids in order of the words, so that phrases come out sorted
    number = np.zeros(len(words) + 1, np.int32)
    number[np.fromiter(map(ids.__getitem__, words), np.int64, len(words))] = np.arange(1, len(words) + 1)
    seq = number[np.concatenate(parts)]
    seq = seq[np.concatenate(([True], (seq[1:] > 0) | (seq[:-1] > 0)))]  # one cut is as good as several
    following, preceding = transforms(seq)
    pack = zstandard.ZstdCompressor(1).compress
    return pa.RecordBatch.from_arrays([
        pa.array([lang], pa.string()), pa.array([int((seq > 0).sum())], pa.int64()),
        pa.array([pack(b" ".join(words))], pa.binary()), pa.array([pack(following.tobytes())], pa.binary()),
        pa.array([pack(preceding.tobytes())], pa.binary())], names=[f.split()[0] for f in SHARDS.split(", ")])


def transforms(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words before the positions sorted by their next DEPTH words, words after the positions sorted by their last DEPTH words).

    The sequence starts and ends with a cut and is read as a ring, so the cut after the last word is the one before the first.
    """
    seq = seq[:-1] if len(seq) > 1 else seq
    bits = max(1, int(seq.max(initial=0)).bit_length())
    out = []
    for way in (1, -1):
        deep = [np.roll(seq, -way * k) for k in range(DEPTH)]
        if DEPTH * bits <= 63:
            code = np.zeros(len(seq), np.int64)
            for x in deep:
                code = code << bits | x
            order = np.argsort(code, kind="stable")
        else:
            order = np.lexsort(deep[::-1])
        out.append(np.roll(seq, way)[order])
    return out[0], out[1]


class Index:
    """Both transforms of a shard, with the rank of each entry among its equals."""

    def __init__(self, words: bytes, following: bytes, preceding: bytes):
        unpack = zstandard.ZstdDecompressor().decompress
        self.words = [b""] + (unpack(words).split(b" ") if words else [])
        self.before, self.after = (np.frombuffer(unpack(x), np.int32) for x in (following, preceding))
        self.count = np.bincount(self.before, minlength=len(self.words))
        self.first = np.cumsum(self.count) - self.count
        self.step = {}

    def _steps(self, side: str) -> np.ndarray:
        """Of each entry where the position one word on stands: the first place of its word and its rank among its equals."""
        if side not in self.step:
            x = self.after if side == "after" else self.before
            out = np.empty(len(x), np.int32)
            out[np.argsort(x, kind="stable")] = np.arange(len(x), dtype=np.int32)
            self.step[side] = out
        return self.step[side]

    def single(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Every word: (words as one column, place in the order by following words, place by preceding words, count)."""
        w = np.arange(1, len(self.count))
        return w[:, None], self.first[w], self.first[w], self.count[w]

    def extend(self, side: str, phrases, by_following, by_preceding, count):
        """All phrases one word longer after (or before) the given ones; the same four columns, and which phrase each comes from."""
        mine, other = (by_preceding, by_following) if side == "after" else (by_following, by_preceding)
        text = self.after if side == "after" else self.before
        parent = np.repeat(np.arange(len(count)), count)
        at = np.arange(len(parent)) + np.repeat(mine - np.cumsum(count) + count, count)
        word = text[at]
        code = parent * len(self.words) + word
        order = np.argsort(code, kind="stable")
        code = code[order]
        new = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
        size = np.diff(np.append(new, len(code)))
        parent, word, entry = parent[order[new]], word[order[new]], at[order[new]]
        start = np.searchsorted(parent, np.arange(len(count)))
        total = np.cumsum(size) - size
        inside = total - total[start[parent]] if len(new) else total  # longer phrases with a lesser word lie before in the other order
        own, opposite = self._steps(side)[entry], other[parent] + inside
        keep = word > 0
        longer = np.column_stack([phrases[parent], word] if side == "after" else [word, phrases[parent]])[keep]
        both = (opposite, own) if side == "after" else (own, opposite)
        return longer, both[0][keep], both[1][keep], size[keep], parent[keep]


def word_codes(lang: str, words: list[bytes]) -> np.ndarray:
    """64-bit codes of the words of a language."""
    seed = xxhash.xxh64_intdigest(lang.encode()) & 0x7FFFFFFF
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in words), np.uint64, len(words))


def phrase_codes(codes: np.ndarray) -> np.ndarray:
    """Code of each phrase from the codes of its words, one column a word; says where it stands in a bitmap and in which bucket."""
    out = np.zeros(len(codes), np.uint64)
    for column in codes.T:
        out = mix64(out ^ column)
    return out


def bitmap(frequent: DataFrame) -> np.ndarray:
    """Packed bits of the places of (lang, phrase): a fixed size, made where the rows are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << BITMAP_BITS, bool)
        for batch in batches:
            langs, phrases = batch.column("lang").to_pylist(), batch.column("phrase").cast(pa.binary()).to_pylist()
            by_lang: dict[str, list] = {}
            for lang, phrase in zip(langs, phrases, strict=True):
                by_lang.setdefault(lang, []).append(phrase)
            for lang, some in by_lang.items():
                parts = [p.split(b" ") for p in some]
                bits[_place(phrase_codes(word_codes(lang, [w for p in parts for w in p]).reshape(len(some), -1)))] = True
        yield from split_parts(np.packbits(bits), ["part", "counts"])

    return merged(frequent.mapInArrow(run, "part int, counts binary"), np.bitwise_or, "u1", 1 << BITMAP_BITS - 3)


def _place(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _has(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    place = _place(codes)
    return bits[place >> 3] >> (7 - (place & 7)) & 1 == 1


PACKED = "lang string, bucket int, phrases binary, counts binary"


def _count_batches(depth: int, maps, buckets: int):
    """Phrases of `depth` words in each shard whose parts may have the support, with their counts, packed by bucket; maps: bitmaps by depth."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one shard at a time
                lang, words, following, preceding = (batch.column(c)[i].as_py() for c in ("lang", "words", "following", "preceding"))
                index = Index(words, following, preceding)
                codes = np.concatenate((np.zeros(1, np.uint64), word_codes(lang, index.words[1:])))
                phrases, counts = _of_shard(index, codes, depth, maps)
                if len(counts):
                    yield from _pack(index, lang, phrases, counts, (phrase_codes(codes[phrases]) % np.uint64(buckets)).astype(np.int32))
    return run


def _pack(index: Index, lang: str, phrases: np.ndarray, counts: np.ndarray, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    pack, order = zstandard.ZstdCompressor(1).compress, np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    for a in range(0, len(cut) - 1, 256):
        spans = [order[x:y] for x, y in zip(cut[a:a + 256], cut[a + 1:a + 257], strict=False)]
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * len(spans), pa.string()), pa.array(bucket[cut[a:a + len(spans)]], pa.int32()),
            pa.array([pack(b"\n".join(_texts(index, phrases[x]))) for x in spans], pa.binary()),
            pa.array([pack(counts[x].astype("<i4").tobytes()) for x in spans], pa.binary())], names=["lang", "bucket", "phrases", "counts"])


def _summed(support: int):
    """(lang, phrase, f) of the phrases that occur at least `support` times, from packed rows sorted by language and bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, held, texts, counts = zstandard.ZstdDecompressor().decompress, None, [], []

        def total() -> pa.RecordBatch:
            table = pa.table({"phrase": pa.array([p for t in texts for p in t.split(b"\n")], pa.binary()), "f": np.concatenate(counts)})
            table = table.group_by("phrase").aggregate([("f", "sum")])
            table = table.filter(pc.greater_equal(table["f_sum"], support))
            return pa.RecordBatch.from_arrays([
                pa.array([held[0]] * len(table), pa.string()), pa.array(table["phrase"].to_pylist(), pa.binary()).cast(pa.string()),
                pa.array(table["f_sum"].to_numpy(), pa.int64())], names=["lang", "phrase", "f"])

        for batch in batches:
            for lang, bucket, phrases, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "bucket", "phrases", "counts")), strict=True):
                if held != (lang, bucket):
                    if held:
                        yield total()
                    held, texts, counts = (lang, bucket), [], []
                texts.append(unpack(phrases))
                counts.append(np.frombuffer(unpack(n), "<i4").astype(np.int64))
        if held:
            yield total()
    return run


def _blocks(level: tuple) -> Iterator[tuple]:
    """The phrases in parts that have about ENTRIES entries in the index together (one frequent phrase stands alone)."""
    cut = np.flatnonzero(np.diff(np.cumsum(level[3]) // ENTRIES, prepend=-1, append=np.iinfo(np.int64).max))
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        yield tuple(x[a:b] for x in level)


def _of_shard(index: Index, codes: np.ndarray, depth: int, maps) -> tuple[np.ndarray, np.ndarray]:
    """Phrases (a column a word) and their counts."""
    level = index.single()
    if depth == 1:
        return level[0], level[3]
    common = _has(maps.value[1], phrase_codes(codes[:, None]))  # by word id
    common[0] = False
    kept = []
    for block in _blocks(_where(level, common[1:])):
        *longer, _ = index.extend("after", *block)
        longer = _where(longer, common[longer[0][:, 1]])
        if depth > 2:
            longer = _where(longer, _has(maps.value[2], phrase_codes(codes[longer[0]])))
        kept.append((longer[0].astype(np.int32), *longer[1:]))
    if depth == 2 or not kept:
        return _joined([(x[0], x[3]) for x in kept], depth)
    level = tuple(np.concatenate(x) for x in zip(*kept, strict=True))
    pair, kept = np.sort(_code(index, level[0])), []
    for block in _blocks(level):
        *longer, _ = index.extend("after", *block)
        tail = _code(index, longer[0][:, 1:])
        at = np.minimum(np.searchsorted(pair, tail), len(pair) - 1)
        longer = _where(longer, pair[at] == tail)
        kept.append((longer[0].astype(np.int32), longer[3]))
    return _joined(kept, depth)


def _joined(parts: list[tuple], depth: int) -> tuple[np.ndarray, np.ndarray]:
    none = (np.zeros((0, depth), np.int32), np.zeros(0, np.int64))
    return tuple(np.concatenate(x) for x in zip(none, *parts, strict=True))


def _where(level, keep: np.ndarray) -> tuple:
    return tuple(x[keep] for x in level)


def _code(index: Index, pairs: np.ndarray) -> np.ndarray:
    return pairs[:, 0].astype(np.int64) * len(index.words) + pairs[:, 1]


def _texts(index: Index, phrases: np.ndarray) -> list[bytes]:
    words = index.words
    if phrases.shape[1] == 1:
        return [words[i] for i in phrases[:, 0].tolist()]
    return [b" ".join([words[i] for i in p]) for p in phrases.tolist()]


def index_shards(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The stored index shards of all texts; null text is empty, null lang is `und`."""
    texts = docs.select(docs["text"].cast("string").alias("text"), F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"))
    return stored(texts.mapInArrow(_shard_batches(shard_words), SHARDS), "index")


def phrase_counts(shards: DataFrame, support: int = SUPPORT) -> dict[int, DataFrame]:
    """By number of words: (lang, phrase, f) of all phrases that occur at least `support` times."""
    spark = shards.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out, maps = {}, {}
    buckets = int(shards.agg(F.sum("n")).first()[0] or 0) // BUCKET_WORDS + 1
    for depth in range(1, DEPTH + 1):
        shared = spark.sparkContext.broadcast(dict(maps))
        counts = shards.mapInArrow(_count_batches(depth, shared, buckets), PACKED)
        # A task sums one bucket after the other, so it holds a small part of what it gets.
        counts = counts.repartition(n, "lang", "bucket").sortWithinPartitions("lang", "bucket")
        out[depth] = stored(counts.mapInArrow(_summed(support), "lang string, phrase string, f long"), f"phrases{depth}")
        if depth < DEPTH:
            maps[depth] = bitmap(out[depth])
    return out


def collocations(docs: DataFrame, support: int = SUPPORT, covered: int = COVERED, shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, phrase, a, l, r, n, score of every phrase of 2 to 3 words with support that no longer one covers.

    Null text is empty, null lang `und`. Wordless texts add nothing; repeated rows count each. An empty
    table gives an empty result. shard_words moves work between shards, not the result.
    """
    shards = index_shards(docs, shard_words)
    f = phrase_counts(shards, support)
    total = shards.groupBy("lang").agg(F.sum("n").alias("n"))

    def part(depth: int, name: str) -> DataFrame:
        return f[depth].select("lang", F.col("phrase").alias(name), F.col("f").alias(f"f_{name}"))

    words = F.split("phrase", " ")
    two = f[2].select("lang", "phrase", F.col("f").alias("a"), words[0].alias("w1"), words[1].alias("w2"))
    three = f[3].select("lang", "phrase", F.col("f").alias("a"), words[0].alias("w1"), words[2].alias("w3"),
                        F.concat_ws(" ", words[0], words[1]).alias("w12"), F.concat_ws(" ", words[1], words[2]).alias("w23"))
    over = three.select("lang", F.explode(F.array("w12", "w23")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    two = two.join(over, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))
    two = two.join(part(1, "w1"), ["lang", "w1"]).join(part(1, "w2"), ["lang", "w2"])
    two = two.select("lang", "phrase", "a", F.col("f_w1").alias("l"), F.col("f_w2").alias("r"))
    three = three.join(part(2, "w23"), ["lang", "w23"]).join(part(2, "w12"), ["lang", "w12"])
    three = three.join(part(1, "w1"), ["lang", "w1"]).join(part(1, "w3"), ["lang", "w3"])
    two = two.withColumn("score", _score("l", "r"))
    cuts = three.select("lang", "phrase", "a", F.struct(_score("f_w1", "f_w23").alias("score"), F.lit(1).alias("k"), F.col("f_w1").alias("l"),
                                                        F.col("f_w23").alias("r")).alias("one"),
                        F.struct(_score("f_w12", "f_w3").alias("score"), F.lit(2).alias("k"), F.col("f_w12").alias("l"),
                                 F.col("f_w3").alias("r")).alias("two"))
    three = cuts.withColumn("cut", F.least("one", "two")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    return two.unionByName(three).join(total, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def _score(left: str, right: str):
    """floor(1000000 a a / (l r)), exact in whole numbers of 38 digits."""
    return F.expr(f"CAST(CAST(a AS DECIMAL(19,0)) * CAST(a AS DECIMAL(19,0)) * {SCALE} AS DECIMAL(38,0)) "
                  f"div (CAST({left} AS DECIMAL(19,0)) * CAST({right} AS DECIMAL(19,0)))")


def best(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first `top` of each language, with their rank."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best(collocations(read_table(spark, sf_dir, "documents")))


SQL = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, string_split_regex(p, '[\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
words AS (SELECT * FROM (SELECT lang, piece, unnest(w) AS w1, unnest(range(len(w))) AS i FROM pieces) WHERE w1 <> ''),
runs AS (SELECT lang, w1, lead(w1, 1) OVER x AS w2, lead(w1, 2) OVER x AS w3 FROM words WINDOW x AS (PARTITION BY piece ORDER BY i)),
total AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
f1 AS (SELECT lang, w1, count(*) AS f FROM runs GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
covers AS (SELECT lang, w1, w2, max(f) AS f FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 t JOIN f1 x ON x.lang = t.lang AND x.w1 = t.w1 JOIN f1 y ON y.lang = t.lang AND y.w1 = t.w2
  LEFT JOIN covers c ON c.lang = t.lang AND c.w1 = t.w1 AND c.w2 = t.w2
  WHERE t.f >= 10 AND coalesce(100 * c.f < 50 * t.f, true)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f
  FROM f3 t JOIN f1 x ON x.lang = t.lang AND x.w1 = t.w1 JOIN f2 y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f
  FROM f3 t JOIN f2 x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN f1 y ON y.lang = t.lang AND y.w1 = t.w3),
scored AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score::BIGINT AS score FROM ranked r JOIN total t ON t.lang = r.lang WHERE rank <= 2000
"""
