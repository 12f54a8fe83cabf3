"""Quality classifier: regularised quadratic discriminant (operator 7).

Statistics of every whole text, transformed to be near normal, give one
vector a document. Class means and covariances are shrunk towards the pooled
covariance and its diagonal; a document's score is the logistic of the difference of
the classes' Gaussian log densities, from Mahalanobis distances by Cholesky
factors that are computed once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personalens.llm.common import Words, binary_texts, crc_fold, in_chunks, pick, read_table, stored

FEATURES = ("log_words", "word_length", "word_length_spread", "letters", "capitals", "digits", "symbols", "marks",
            "stops", "distinct_words", "top_word", "repeated_pairs", "lines", "spaces")
SHRINK_POOLED, SHRINK_DIAGONAL, RIDGE = 0.3, 0.1, 1e-3
# The score is the logistic of the log odds divided by this, which keeps it off 0 and 1.
TEMPERATURE = 4.0


def _classes() -> np.ndarray:
    """Class of each byte: 0 other, 1 letter (ASCII or part of a longer code), 2 capital, 3 digit, 4 symbol, 5 mark, 6 stop, 7 line end."""
    c = np.zeros(256, np.uint8)
    c[ord("a"):ord("z") + 1] = 1
    c[128:] = 1
    c[ord("A"):ord("Z") + 1] = 2
    c[ord("0"):ord("9") + 1] = 3
    c[[ord(x) for x in "#*$%&|<>@^~_=+{}[]\\/"]] = 4
    c[[ord(x) for x in "!?"]] = 5
    c[[ord(x) for x in ".,;:"]] = 6
    c[ord("\n")] = 7
    return c


BYTE_CLASS = _classes()


def features(texts: list[bytes]) -> np.ndarray:
    """One row of FEATURES a text; an empty text has zeros."""
    out = np.zeros((len(texts), len(FEATURES)))
    for a, b in in_chunks(texts):
        out[a:b] = _features(texts[a:b])
    return out


def _features(texts: list[bytes]) -> np.ndarray:
    w = Words(texts)
    n_docs = len(texts)
    size = np.fromiter((len(t) for t in texts), np.int64, n_docs)
    kinds = BYTE_CLASS[w.buf]
    edges = np.append(w.text_start, len(w.buf))
    per = np.empty((8, n_docs))
    for k in range(1, 8):
        total = np.concatenate(([0], np.cumsum(kinds == k, dtype=np.int64)))
        per[k] = total[edges[:-1] + size] - total[edges[:-1]]
    n, chars = np.maximum(w.n, 1), np.maximum(size, 1)
    length = (w.end - w.start).astype(float)
    mean = np.bincount(w.doc, length, n_docs) / n
    spread = np.sqrt(np.maximum(np.bincount(w.doc, length ** 2, n_docs) / n - mean ** 2, 0))
    h = w.hashes(lower=True)
    distinct, top = _distinct(w.doc, h, n_docs)
    pair_doc = w.doc[:-1][w.doc[:-1] == w.doc[1:]] if len(h) else w.doc
    pair = (h[:-1] * np.uint64(3) + h[1:])[w.doc[:-1] == w.doc[1:]] if len(h) else h
    pairs, _ = _distinct(pair_doc, pair, n_docs)
    n_pairs = np.bincount(pair_doc, minlength=n_docs)
    x = np.column_stack([
        np.log1p(w.n), np.log1p(mean), np.log1p(spread),
        *(np.sqrt(per[k] / chars) for k in (1, 2, 3, 4, 5, 6)),
        distinct / n, np.sqrt(top / n), np.sqrt((n_pairs - pairs) / np.maximum(n_pairs, 1)),
        np.log1p(per[7] / n * 100), np.sqrt(w.n / chars)])
    x[size == 0] = 0
    return x


def _distinct(doc: np.ndarray, h: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """By document: number of distinct values, and how often its most frequent one occurs."""
    if not len(h):
        return np.zeros(n_docs), np.zeros(n_docs)
    order = np.lexsort((h, doc))
    d, v = doc[order], h[order]
    start = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (v[1:] != v[:-1]))))
    runs = np.diff(np.append(start, len(d)))
    top = np.zeros(n_docs)
    np.maximum.at(top, d[start], runs)
    return np.bincount(d[start], minlength=n_docs).astype(float), top


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = features(binary_texts(batch.column("text")))
        vectors = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), vectors], names=["doc_id", "x"])


@dataclass
class Model:
    mean: np.ndarray      # class, feature
    factor: np.ndarray    # class: inverse of the Cholesky factor
    log_det: np.ndarray
    log_prior: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        density = []
        for c in (0, 1):
            z = (x - self.mean[c]) @ self.factor[c].T
            density.append(self.log_prior[c] - 0.5 * self.log_det[c] - 0.5 * np.einsum("ij,ij->i", z, z))
        return density[1] - density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x) / TEMPERATURE, -30, 30)))


def fit(moments: list[tuple[int, int, np.ndarray, np.ndarray]]) -> Model:
    """From (class, rows, sum of x, sum of x x') of each class; a class without rows borrows the other's shape."""
    k = len(FEATURES)
    count, total, square = np.zeros(2), np.zeros((2, k)), np.zeros((2, k, k))
    for c, n, s, ss in moments:
        count[c] += n
        total[c] += s
        square[c] += np.asarray(ss).reshape(k, k)
    mean = total / np.maximum(count, 1)[:, None]
    scatter = square - np.einsum("ci,cj->cij", mean, total)
    pooled = scatter.sum(0) / max(count.sum() - 2, 1) + RIDGE * np.eye(k)
    factors, dets = [], []
    for c in (0, 1):
        own = scatter[c] / max(count[c] - 1, 1)
        weight = max(SHRINK_POOLED, k / (k + count[c]))  # few rows: nearer to the pooled one
        cov = (1 - weight) * own + weight * pooled
        cov = (1 - SHRINK_DIAGONAL) * cov + SHRINK_DIAGONAL * np.diag(np.diag(cov)) + RIDGE * np.eye(k)
        low = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(low))
        dets.append(2 * np.log(np.diag(low)).sum())
    prior = np.log((count + 1) / (count.sum() + 2))
    return Model(mean, np.array(factors), np.array(dets), prior)


def class_moments(rows: DataFrame) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """Moments of (label, x) rows: each task sums its own, so a few numbers a task leave it."""
    def sums(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(FEATURES)
        n, s, ss = np.zeros(2, np.int64), np.zeros((2, k)), np.zeros((2, k, k))
        for batch in it:
            y = batch.column("label").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            for c in (0, 1):
                own = x[y == c]
                n[c] += len(own)
                s[c] += own.sum(0)
                ss[c] += own.T @ own
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1], pa.int32()), pa.array(n), pa.array(s.tolist(), pa.list_(pa.float64())),
             pa.array(ss.reshape(2, -1).tolist(), pa.list_(pa.float64()))], names=["label", "n", "s", "ss"])

    k = len(FEATURES)
    parts = rows.mapInArrow(sums, "label int, n long, s array<double>, ss array<double>")
    total = parts.groupBy("label").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.col("s")[i]) for i in range(k)]).alias("s"),
        F.array(*[F.sum(F.col("ss")[i]) for i in range(k * k)]).alias("ss"))
    return [(r["label"], r["n"], np.array(r["s"]), np.array(r["ss"])) for r in total.collect()]


def quality_scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 3,
                   held_fold: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs.

    Learns from all labelled rows whose crc32(id) modulo folds isn't held_fold;
    null labels don't count. Null and empty texts score by their zero vector;
    without any label every score comes from priors of one half. The table
    of vectors is written once; no text is shuffled.
    """
    vectors = stored(pick(docs).mapInArrow(_feature_batches, "doc_id long, x array<double>"), "vectors")
    marked = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label"))
    marked = marked.where("label IN (0, 1)").where(crc_fold(F.col("doc_id"), folds) != held_fold).distinct()
    model = fit(class_moments(vectors.join(marked, "doc_id").select("label", "x")))

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    out = vectors.mapInArrow(score, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(crc_fold(F.col("doc_id"), folds) == held_fold, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
