"""Regularised quadratic discriminant for text quality.

Each text gives a vector of transformed statistics; each class a mean and a
covariance, shrunk towards the pooled one and its diagonal.  The score is the
logistic of the difference of the log densities (Mahalanobis distances by the
Cholesky factors, computed once) plus that of the priors.

The fit needs each class's count, sum and sum of outer products only, so it
covers all labelled training rows and 2 * (1 + d + d * d) numbers reach the
driver.  Cases: a null text is empty and gets a score; doc_id null has no
label; several labels of one doc_id count each, labels other than 0 and 1 or
null not at all; a class of few rows leans on the pooled covariance the more,
and only without any row of one class does the prior alone decide (0.5 where
there is none of either); an empty table gives no rows; texts are read whole;
repeated rows are scored each; ``score_documents`` reads no other columns,
``keep_good`` carries all through, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import log, sqrt
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, chunks, cut, text_bytes, where_python

NAMES = ("words", "word_len", "word_len_sd", "distinct", "upper", "digit", "mark", "odd_mark", "marked_end", "top_word", "line_len", "sentence_len", "short_words", "adjacent", "lone_marks")
ODD = frozenset(b"%*$#&!|@~^=+<>\\/")
MARKS = frozenset(bytes([c]) for c in range(33, 127) if not chr(c).isalnum())


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one text; an empty one has zeros."""
    low = text.lower().split()
    if not low:
        return [0.0] * len(NAMES)
    n = np.bincount(np.frombuffer(text, np.uint8), minlength=256).tolist()
    size, k, distinct = len(text), len(low), len(set(low))
    upper, digits = sum(n[65:91]), sum(n[48:58])
    letters = upper + sum(n[97:123]) + sum(n[128:])
    marks = sum(n[33:48]) + sum(n[58:65]) + sum(n[91:97]) + sum(n[123:127])
    odd = marks - n[44] - n[46] - n[39] - n[45]
    lens = Counter(map(len, low))
    mean = sum(x * c for x, c in lens.items()) / k
    spread = sqrt(sum((x - mean) ** 2 * c for x, c in lens.items()) / k)
    tails = Counter([w[-1] for w in low])
    odd_end = sum(c for x, c in tails.items() if x in ODD) / k
    lone = sum(w in MARKS for w in low) / k
    same = sum(map(eq, low, low[1:])) / k
    short = lens[1] + lens[2] + lens[3]
    return [
        log(1 + k), log(mean), log(1 + spread), log(distinct / k), log((upper + 0.5) / (letters - upper + 0.5)), sqrt(digits / size), sqrt(marks / size), sqrt(max(odd, 0) / size),
        sqrt(odd_end), log(max(lens.values()) / k), log(1 + k / (n[10] + 1)), log(1 + k / (1 + n[46] + n[33] + n[63])), log((short + 0.5) / (k - short + 0.5)), sqrt(same), sqrt(lone),
    ]


def features(docs: DataFrame) -> DataFrame:
    """doc_id and ``x`` (array of doubles) for each row."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 1024):
            x = [list(map(float, statistics(t))) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long"), text_bytes().alias("t")).mapInArrow(run, "doc_id long, x array<double>")


class Discriminant:
    """Class means, Cholesky factors and log priors of a fitted quadratic discriminant."""

    def __init__(self, n: np.ndarray, s: np.ndarray, ss: np.ndarray, shrink: float = 0.15, diagonal: float = 0.1, ridge: float = 1e-3):
        d, total = s.shape[1], n.sum()
        self.prior = float(np.log((n[1] + 1) / (n[0] + 1))) if total else 0.0
        self.ready = bool((n > 0).all())
        if not self.ready:
            return
        self.mean = s / n[:, None]
        cov = ss / n[:, None, None] - np.einsum("ki,kj->kij", self.mean, self.mean)
        pooled = np.einsum("k,kij->ij", n, cov) / total
        scale = np.sqrt(np.maximum(np.diag(pooled), 1e-12))
        self.low, self.high = self.mean.min(0) - 8 * scale, self.mean.max(0) + 8 * scale
        self.factor, self.logdet = [], []
        for k in (0, 1):
            lean = max(shrink, (d + 1) / (n[k] + d + 1))  # fewer rows than unknowns: towards the pooled one
            m = (1 - lean) * cov[k] + lean * pooled
            m = (1 - diagonal) * m + diagonal * np.diag(np.diag(m)) + ridge * np.diag(scale**2) + 1e-9 * np.eye(d)
            f = np.linalg.cholesky(m)
            self.factor.append(np.linalg.inv(f))
            self.logdet.append(2 * np.log(np.diag(f)).sum())

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        z = np.full(len(x), self.prior)
        if self.ready:
            x = np.clip(x, self.low, self.high)
            for k, sign in ((0, -1), (1, 1)):
                y = (x - self.mean[k]) @ self.factor[k].T
                z = z - sign * 0.5 * ((y * y).sum(1) + self.logdet[k])
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(vectors: DataFrame, labels: DataFrame) -> Discriminant:
    """A discriminant from rows of ``vectors`` (doc_id, x) that ``labels`` (doc_id, quality) mark."""
    d = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((2, 1 + d + d * d))
        for b in batches:
            y = np.array(b.column(0).to_pylist())
            x = np.array(b.column(1).to_pylist()).reshape(len(y), d)
            for k in (0, 1):
                z = x[y == k]
                out[k] += np.concatenate([[len(z)], z.sum(0), (z.T @ z).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], out.shape[1])), pa.array(np.tile(np.arange(out.shape[1]), 2)), pa.array(out.ravel())], ["k", "i", "v"])

    marked = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("y"))
    rows = vectors.join(marked, "doc_id").select("y", "x").mapInArrow(run, "k long, i long, v double").groupBy("k", "i").agg(F.sum("v").alias("v")).collect()
    got = np.zeros((2, 1 + d + d * d))
    for r in rows:
        got[r.k, r.i] = r.v
    return Discriminant(got[:, 0], got[:, 1 : d + 1], got[:, d + 1 :].reshape(2, d, d))


def held_out(col: str = "doc_id"):
    """Whether crc32 of the id's text modulo 3 is 1; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def score_vectors(vectors: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id, score of each row of ``vectors``."""
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column(1).to_pylist()).reshape(b.num_rows, len(NAMES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.score(x))], ["doc_id", "score"])

    return vectors.mapInArrow(run, "doc_id long, score double")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score for every row of ``docs``; learned from labelled rows that are not held out."""
    vectors = cut(features(docs))
    return score_vectors(vectors, fit(vectors.where(~held_out()), labels))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, columns unchanged.

    Texts go to Python in bounded batches and only the verdict comes back; the
    rows stay in the JVM, which drops those that fail.
    """
    bound_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(fit(features(docs).where(~held_out()), labels))

    @F.arrow_udf("boolean")
    def good(texts: pa.Array) -> pa.Array:
        x = np.array([statistics(t) for t in texts.to_pylist()]).reshape(len(texts), len(NAMES))
        return pa.array(model.value.score(x) >= least)

    return where_python(docs, good, text_bytes())
