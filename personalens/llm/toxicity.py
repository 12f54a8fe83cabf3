"""Toxicity by multiple-instance learning (operator 3).

Labels mark documents; sentences are the instances. A sentence's probability
is the logistic of its lexicon terms' weights, a document's is the noisy-or of
its sentences and a small leak for labels that no sentence explains. Terms are
words and beginnings of words, so that an inflected or compound form never seen
in training is known by its stem. Sentences without lexicon terms carry no
evidence, so length alone makes no text toxic.
Trained from document labels alone, the sentence scores then locate the offending sentences.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personalens.llm.common import BYTE_CODE, binary_texts, crc_fold, in_chunks, pick, read_table, small_batches, span_hashes, stored

#: At most so many labelled documents of each class train the model: those with the least hash of their id.
MAX_LABELLED = 20_000
#: Terms that may be features: all in MIN_DOCUMENTS documents or more whose odds of a toxic document are, SURE standard
#: errors below their estimate, still above RATIO.
MIN_DOCUMENTS, SURE, RATIO = 5, 2.0, 2.0
#: Beginnings of words are terms from SHORTEST to LONGEST code points.
SHORTEST, LONGEST = 3, 8
BEGINNING = np.uint64(0x9E3779B97F4A7C15)  # tells a beginning from the word spelt alike
ROUNDS, RATE, DECAY = 300, 0.1, 2e-5
SENTENCE_SCORE = 0.5
#: Log odds of a sentence before its terms count; terms whose learned weight adds less than LEAST_WEIGHT to it carry no
#: evidence. A sentence of such terms alone would count by its number, and length alone would make a text toxic.
BIAS, LEAST_WEIGHT = -7.0, 0.5


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By byte: its lower case, whether it belongs to a word, whether it ends a sentence."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.zeros(256, bool)
    word[65:91] = word[97:123] = word[128:] = True
    stop = np.zeros(256, bool)
    stop[[ord(c) for c in ".!?\n\0"]] = True
    return lower, word, stop


LOWER, IN_WORD, ENDS = _tables()


@dataclass
class Tokens:
    """Words (runs of letters, lower case) of a chunk of texts and their beginnings, with the sentence and text each is in."""

    hash: np.ndarray
    parent: np.ndarray          # the next shorter beginning, 0 where there is none
    sentence: np.ndarray        # of each term; numbered through the chunk
    sentence_doc: np.ndarray    # text of each sentence
    bounds: np.ndarray          # byte where each sentence starts, in the joined buffer, and the end
    text_start: np.ndarray


def tokens(texts: list[bytes]) -> Tokens:
    buf = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    size = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    text_start = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    edge = np.flatnonzero(np.diff(IN_WORD[buf].view(np.int8), prepend=np.int8(0)))
    start, end = edge[0::2], edge[1::2]
    bounds = np.concatenate(([0], np.flatnonzero(ENDS[buf]) + 1))
    sentence = np.searchsorted(bounds, start, "right") - 1
    doc = np.searchsorted(text_start, bounds[:-1], "right") - 1
    opens = (buf & 0xC0) != 0x80  # first byte of a code point
    at, nth = np.flatnonzero(opens), np.cumsum(opens) - 1
    size = nth[end - 1] - nth[start] + 1 if len(start) else np.zeros(0, np.int64)
    at = np.append(at, len(buf))
    which = [np.flatnonzero(size >= k) for k in range(SHORTEST, LONGEST + 1)] + [np.arange(len(start))]
    ends = [at[nth[start[w]] + k] for w, k in zip(which[:-1], range(SHORTEST, LONGEST + 1), strict=True)]
    word = np.concatenate(which)
    term = span_hashes(BYTE_CODE[LOWER[buf]], start[word], np.concatenate([*ends, end]))
    term[:len(word) - len(start)] ^= BEGINNING
    parent, last, done = np.zeros(len(term), np.uint64), np.zeros(len(start), np.uint64), 0
    for w in which:
        here = slice(done, done + len(w))
        parent[here] = last[w]
        last[w] = term[here]
        done += len(w)
    return Tokens(term, parent, sentence[word], doc, bounds, text_start)


@dataclass
class Model:
    lexicon: np.ndarray     # sorted hashes
    weight: np.ndarray
    bias: float
    leak: float

    def apply(self, texts: list[bytes]) -> tuple[np.ndarray, list[str]]:
        """Score of each text, and its offending sentences as start:end:score in code points."""
        score, spans = np.zeros(len(texts)), [""] * len(texts)
        for a, b in in_chunks(texts):
            score[a:b], spans[a:b] = self._chunk(texts[a:b])
        return score, spans

    def _chunk(self, texts: list[bytes]) -> tuple[np.ndarray, list[str]]:
        t = tokens(texts)
        sent, lex = hits(t, self.lexicon)
        used = np.unique(sent)
        z = np.bincount(sent, self.weight[lex], len(t.sentence_doc)) + self.bias
        alive = -np.bincount(t.sentence_doc[used], np.logaddexp(0, z[used]), len(texts))
        score = -np.expm1(np.log1p(-self.leak) + alive)
        spans = [""] * len(texts)
        for s in used[z[used] >= np.log(SENTENCE_SCORE / (1 - SENTENCE_SCORE))]:
            d = t.sentence_doc[s]
            first, last = t.bounds[s] - t.text_start[d], min(t.bounds[s + 1] - t.text_start[d], len(texts[d]))
            at = len(texts[d][:first].decode(errors="ignore"))
            to = at + len(texts[d][first:last].decode(errors="ignore"))
            spans[d] += f"{',' if spans[d] else ''}{at}:{to}:{1 / (1 + np.exp(-z[s])):.3f}"
        return np.clip(score, 0, 1), spans


def hits(t: Tokens, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sentence, lexicon term) pairs, each once, sorted."""
    if not len(lexicon):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(lexicon, t.hash), len(lexicon) - 1)
    found = lexicon[at] == t.hash
    pair = np.unique(t.sentence[found].astype(np.int64) * len(lexicon) + at[found])
    return pair // len(lexicon), pair % len(lexicon)


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, folds: int, held_fold: int,
                  limit: int = MAX_LABELLED) -> DataFrame:
    """label, weight, text of a bounded sample of labelled documents outside the held-out fold.

    The ids of the sample are at most 2 * limit, so they are broadcast. weight makes up for the
    share of a class that was taken. Equal texts of a label train as one row with their
    summed weight.
    """
    spark = docs.sparkSession
    marked = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label"))
    marked = stored(marked.where("label IN (0, 1)").where(crc_fold(F.col("doc_id"), folds) != held_fold).distinct(), "marked")
    totals = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = [marked.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
             .withColumn("weight", F.lit(max(1.0, totals.get(c, 0) / limit))) for c in (0, 1)]
    sample = stored(parts[0].unionByName(parts[1]), "sample")
    rows = pick(docs).join(F.broadcast(sample), "doc_id").select("label", "weight", F.coalesce("text", F.lit("")).alias("text"))
    once = rows.groupBy("label", F.sha2("text", 256).alias("copy")).agg(F.sum("weight").alias("weight"), F.first("text").alias("text"))
    return stored(once.drop("copy"), "training") if totals else spark.createDataFrame([], "label int, weight double, text string")


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, next shorter beginning, documents of label 0 and 1 with it), summed within a batch."""
    for batch in batches:
        label = batch.column("label").to_numpy(zero_copy_only=False)
        texts = binary_texts(batch.column("text"))
        for a, b in in_chunks(texts):
            t = tokens(texts[a:b])
            doc = t.sentence_doc[t.sentence]
            order = np.lexsort((t.hash, doc))
            d, h = doc[order], t.hash[order]
            first = np.concatenate(([True], (d[1:] != d[:-1]) | (h[1:] != h[:-1]))) if len(d) else np.zeros(0, bool)
            y = label[a:b][d[first]]
            word, one, at = np.unique(h[first], return_index=True, return_inverse=True)
            one = order[first][one]
            yield pa.RecordBatch.from_arrays(
                [pa.array(word.view(np.int64)), pa.array(t.parent[one].view(np.int64)),
                 *(pa.array(np.bincount(at[y == c], minlength=len(word))) for c in (0, 1))],
                names=["word", "parent", "n0", "n1"])


def choose_lexicon(rows: DataFrame) -> np.ndarray:
    """Sorted hashes of the terms that surely speak for the label, by a lower bound of their log odds.

    A beginning that is in the same documents as a longer one, or as a whole word, gives way to it. There
    is no limit on the terms: their number is bounded by the words of the training sample.
    """
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    counts = rows.mapInArrow(_word_counts, "word long, parent long, n0 long, n1 long").groupBy("word").agg(
        F.first("parent").alias("parent"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(F.col("n0") + F.col("n1") >= MIN_DOCUMENTS)
    a, b = F.col("n1") + 0.5, F.col("n0") + 0.5
    odds = F.log(a / (n1 + 1 - a + 0.5)) - F.log(b / (n0 + 1 - b + 0.5))
    error = F.sqrt(1 / a + 1 / b)
    sure = stored(counts.where(odds - SURE * error > math.log(RATIO)), "terms")
    longer = sure.select(F.col("parent").alias("word"), "n0", "n1").distinct()
    return np.sort(np.array([r["word"] for r in sure.join(longer, ["word", "n0", "n1"], "left_anti").select("word").collect()],
                            np.int64).view(np.uint64))


def _bags(lexicon: np.ndarray):
    """Of each document: label, weight and its (sentence, word) hits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows = binary_texts(batch.column("text")), []
            for a, b in in_chunks(texts):
                t = tokens(texts[a:b])
                sent, lex = hits(t, lexicon)
                doc = t.sentence_doc[sent]
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                for i in range(b - a):
                    s = sent[cut[i]:cut[i + 1]]
                    rows.append(((s - s[0]).tolist() if len(s) else [], lex[cut[i]:cut[i + 1]].tolist()))
            s, k = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("weight"), pa.array(s, pa.list_(pa.int64())),
                 pa.array(k, pa.list_(pa.int64()))], names=["label", "weight", "sentence", "word"])
    return run


def fit(lexicon: np.ndarray, label, weight, sentences, words) -> Model:
    """Noisy-or likelihood by Adam over all sampled documents; decay pulls weights to zero."""
    y, wt = np.asarray(label), np.asarray(weight, float)
    if not len(y) or not y.any():
        return Model(lexicon[:0], np.zeros(0), BIAS, 0.01)
    doc = np.repeat(np.arange(len(y)), [len(s) for s in sentences])
    sent = np.array([x for s in sentences for x in s], np.int64)
    lex = np.array([x for w in words for x in w], np.int64)
    _, inst = np.unique(np.column_stack([doc, sent]), axis=0, return_inverse=True)
    inst = inst.ravel()
    n_inst = inst.max() + 1 if len(inst) else 0
    inst_doc = np.zeros(n_inst, np.int64)
    inst_doc[inst] = doc
    k = len(lexicon)
    p = np.append(np.zeros(k), -3.0)  # weights, and the leak's log odds
    m, v, total = np.zeros(k + 1), np.zeros(k + 1), wt.sum()
    sig = lambda z: 1 / (1 + np.exp(-z))
    for i in range(1, ROUNDS + 1):
        z = np.bincount(inst, p[lex], n_inst) + BIAS
        alive = -np.logaddexp(0, p[k]) - np.bincount(inst_doc, np.logaddexp(0, z), len(y))
        gone = np.maximum(-np.expm1(alive), 1e-9)
        up = wt * np.where(y == 1, (1 - gone) / gone, -1.0)
        from_inst = -up[inst_doc] * sig(z)
        g = np.append(np.bincount(lex, from_inst[inst], k), -up.sum() * sig(p[k])) / total
        g[:k] += DECAY * p[:k]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= RATE * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.999 ** i)) + 1e-8)
        p[k] = min(p[k], -1.0)
    used = p[:k] >= LEAST_WEIGHT
    return Model(lexicon[used], p[:k][used], BIAS, float(sig(p[k])))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 5, held_fold: int = 0) -> Model:
    """The model of a bounded, weighted sample of labelled rows outside the held-out fold."""
    rows = training_rows(docs, labels, label_col, folds, held_fold)
    lexicon = choose_lexicon(rows)
    bags = rows.mapInArrow(_bags(lexicon), "label int, weight double, sentence array<long>, word array<long>").collect()
    return fit(lexicon, *([b[c] for b in bags] for c in ("label", "weight", "sentence", "word")))


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, sentences of every row; no shuffle.

    Null, empty and wordless texts score by the leak alone; repeated rows
    are scored each; an empty table gives an empty result.
    """
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, spans = model.apply(binary_texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array(spans, pa.string())],
                                             names=["doc_id", "score", "sentences"])

    return pick(docs).mapInArrow(score, "doc_id long, score double, sentences string")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """Rows of docs, with all their columns, whose score is below the threshold."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text_col):
            s, _ = model.apply(binary_texts(batch.column(text_col)))
            yield batch.filter(pa.array(s < threshold))

    return docs.mapInArrow(keep, docs.schema)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = toxicity_scores(docs, train(docs, read_table(spark, sf_dir, "labels")))
    return out.select("doc_id", F.coalesce(crc_fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "sentences")
