"""Subword lattice likelihood.

A word's probability sums over every way to cut it into vocabulary pieces
(forward recursion in log space).  Pieces are those of a public tokenizer;
each training word also is a piece of its own that spans the whole word, so
its weight is the discounted relative count and the subword paths share the
mass that the discount leaves:

    P(word) = max(c - d, 0) / N  +  (d * V / N) * P_pieces(word)

``P_pieces`` draws a first piece, then further pieces until it stops, so the
probabilities of all words add up to at most one.  A document's probability is
the product over its words and one end token; words don't overlap, so the
marginal over all segmentations of the document is that product.

Cases: a null text is empty (one end token); texts of any length are scored
whole; repeated rows are scored each; an empty table gives no rows; columns
of other names are not read.
"""

from __future__ import annotations

import base64
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, cut, text_bytes

#: At most so many words have N / HEAVY occurrences or more; those travel as a broadcast, all others by a join.
HEAVY = 1 << 18
SPACES = b"\t\n\x0b\x0c\r "


def read_pieces(path: str) -> list[bytes]:
    """Pieces of a rank file that can occur in a lower-cased word; ``b' '`` in front marks a word's first piece."""
    out = []
    with open(path, "rb") as f:
        for line in f:
            p = base64.b64decode(line.split()[0])
            if p and p == p.lower() and not set(p[1:]) & set(SPACES) and (p[:1] == b" " or p[0] not in SPACES):
                out.append(p)
    return out


class Lattice:
    """Marginal log probability of words over all segmentations into weighted pieces."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: list[bytes], logp: np.ndarray):
        self.longest = max(map(len, pieces))
        self.pieces, self.logp = pieces, np.asarray(logp, dtype=np.float64)
        keys = self._hash(pieces)
        order = np.argsort(keys)
        self.keys, self.vals = keys[order], self.logp[order]
        if len(np.unique(keys)) != len(keys):
            raise ValueError("pieces must be distinct")
        bits = max(10, int(len(keys)).bit_length() + 3)
        self.shift = np.uint64(64 - bits)
        slot = (self.keys >> self.shift).astype(np.int64)
        self.first = np.searchsorted(slot, np.arange((1 << bits) + 1)).astype(np.int32)
        self.chain = int(np.bincount(slot).max())
        self.pad = np.concatenate([self.keys, np.zeros(self.chain, np.uint64)])

    def _hash(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros(len(words), np.uint64)
        for i, w in enumerate(words):
            h = 0
            for c in w:
                h = (h * 0x9E3779B97F4A7C15 + c + 1) & 0xFFFFFFFFFFFFFFFF
            out[i] = h
        return self._mix(out)

    @staticmethod
    def _mix(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Log weights of hashed pieces, -inf where there is none."""
        at = self.first[(h >> self.shift).astype(np.int64)]
        out = np.full(len(h), -np.inf)
        for k in range(self.chain):
            hit = np.flatnonzero(self.pad[at + k] == h)
            if len(hit):
                out[hit] = self.vals[np.minimum(at[hit] + k, len(self.vals) - 1)]
        return out

    def logprob(self, words: list[bytes]) -> np.ndarray:
        out = np.empty(len(words))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        group = np.ceil(np.log2(np.maximum(sizes, 1)) * 2).astype(int)
        for g in np.unique(group):
            ids = np.flatnonzero(group == g)
            step = max(1, (1 << 20) // max(1, int(sizes[ids].max())))
            for at in range(0, len(ids), step):
                some = ids[at : at + step]
                out[some] = self._forward([words[i] for i in some], sizes[some])
        return out

    def _forward(self, words: list[bytes], sizes: np.ndarray) -> np.ndarray:
        n, width = len(words), int(sizes.max())
        if width == 0:
            return np.zeros(n)
        flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width).T.astype(np.uint64) + np.uint64(1)
        alpha = np.full((width + 1, n), -np.inf)
        alpha[0] = 0
        with np.errstate(over="ignore"):
            for j in range(width):
                live = np.flatnonzero((sizes > j) & (alpha[j] > -np.inf))
                if not len(live):
                    continue
                h, a = np.zeros(len(live), np.uint64), alpha[j][live]
                left = sizes[live]
                for i in range(j, min(width, j + self.longest)):
                    if i > j:
                        keep = left > i
                        if not keep.all():
                            live, h, a, left = live[keep], h[keep], a[keep], left[keep]
                        if not len(live):
                            break
                    h = h * self.BASE + flat[i][live]
                    w = self._find(self._mix(h))
                    hit = np.flatnonzero(w > -np.inf)
                    if len(hit):
                        to = live[hit]
                        alpha[i + 1][to] = np.logaddexp(alpha[i + 1][to], a[hit] + w[hit])
        return alpha[sizes, np.arange(n)]


def segment_counts(words: DataFrame, pieces: list[bytes]) -> np.ndarray:
    """How often each piece occurs when the distinct training ``words`` are cut by the longest match; a column's sum, so at most ``len(pieces)`` rows reach the driver."""
    sc = words.sparkSession.sparkContext
    shared = sc.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {p: i for i, p in enumerate(shared.value)}
        longest = max(map(len, index))
        n = np.zeros(len(index) + 1, np.int64)
        for b in batches:
            for w in b.column(0).to_pylist():
                w, at = b" " + w, 0
                while at < len(w):
                    for k in range(min(longest, len(w) - at), 0, -1):
                        i = index.get(w[at : at + k])
                        if i is not None:
                            n[i] += 1
                            break
                    at += k
                n[-1] += 1
        ids = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n[ids])], ["piece", "n"])

    out = np.zeros(len(pieces) + 1)
    for r in words.select("word").mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect():
        out[r.piece] = r.n
    return out


def fit_pieces(pieces: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Log weights of first and inner pieces, and the log probability to stop after a piece."""
    n_words, c = counts[-1], counts[:-1] + 0.1
    first = np.array([p[:1] == b" " for p in pieces])
    inner = float(counts[:-1][~first].sum())
    stop = (n_words + 1) / (n_words + inner + 2)
    logp = np.empty(len(pieces))
    logp[first] = np.log(c[first] / c[first].sum())
    logp[~first] = np.log(c[~first] / c[~first].sum()) + math.log1p(-stop)
    return logp, math.log(stop)


def word_counts(docs: DataFrame, train: str) -> DataFrame:
    """word (binary), c (count in rows where ``train`` holds), over the words of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 4096):
            all_words, known = set(), Counter()
            for x, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = x.lower().split()
                if t:
                    known.update(w)
                else:
                    all_words.update(w)
            words = [*known, *all_words.difference(known)]
            n = np.zeros(len(words), np.int64)
            n[: len(known)] = list(known.values())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n)], ["word", "c"])

    return docs.select(text_bytes().alias("t"), train).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def score(docs: DataFrame, pieces: list[bytes], train: str, heavy: int = HEAVY, discount: float | None = None) -> DataFrame:
    """Each row of ``docs`` (doc_id, text and the boolean column ``train``) with its scores.

    Returns doc_id, ``train``, n_tokens, n_known, train_tokens, base_score and
    score (log10).  Word counts cover all rows; words of at least
    ``N / heavy`` occurrences (at most ``heavy`` of them) are looked up in a
    broadcast table, all others by a join on the word.  Without a given
    ``discount`` it follows from how many words occur once and twice.
    """
    sc = docs.sparkSession.sparkContext
    counts = cut(word_counts(docs, train))
    tot = counts.where("c > 0").agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2")).first()
    if discount is None:
        discount = min(0.95, max(0.1, (tot.n1 + 0.5) / (tot.n1 + 2 * tot.n2 + 1)))
    ends = docs.where(train).count()
    n_all, v = (tot.n or 0) + ends, (tot.v or 0) + (ends > 0)
    known = counts.where("c > 0")
    logp, stop = fit_pieces(pieces, segment_counts(known, pieces))
    model = sc.broadcast((pieces, logp))
    spare = math.log(discount * max(v, 1) / max(n_all, 1)) + stop if n_all else stop
    low = math.log10(n_all + v + 1)
    p_end = math.log10(max(ends - discount, 0.5) / max(n_all, 1)) if n_all else 0.0

    def lattice(words: list[bytes], c: np.ndarray, lat: Lattice) -> np.ndarray:
        sub = lat.logprob([b" " + w for w in words]) + spare
        with np.errstate(divide="ignore"):
            whole = np.log(np.maximum(c - discount, 0) / max(n_all, 1))
        return np.logaddexp(sub, whole) / math.log(10)

    floor = max(2.0, n_all / heavy)
    top = known.where(F.col("c") >= floor).toArrow()
    words = top.column("word").to_pylist()
    c = np.array(top.column("c").to_pylist(), dtype=np.float64)
    lp = lattice(words, c, Lattice(pieces, logp)) if words else []
    table = sc.broadcast({w: (math.log10(k + 1), float(x)) for w, k, x in zip(words, c, lp, strict=True)})

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = Lattice(*model.value)
        for b in chunks(batches, 65536):
            k = b.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(b.column(1)), pa.array(lattice(b.column(0).to_pylist(), k, lat))], ["word", "c", "lp"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = table.value.get
        for b in chunks(batches, 512):
            ids, doc, held, texts = (x.to_pylist() for x in b.columns)
            col: list[list] = [[] for _ in names]
            for uid, d, t, x in zip(ids, doc, held, texts, strict=True):
                w = x.lower().split()
                base = lpsum = 0.0
                hits, rare, ns = 0, [], []
                for word, n in Counter(w).items():
                    if (g := get(word)) is None:
                        rare.append(word)
                        ns.append(n)
                    else:
                        base += n * g[0]
                        lpsum += n * g[1]
                        hits += n
                k = len(rare)
                col[0] += [uid] * (k + 1)
                col[1] += rare
                col[1].append(b" %d" % uid)
                col[2] += ns
                col[2].append(0)
                for c_, x_ in zip(col[3:], (d, t, len(w), hits, base, lpsum), strict=True):
                    c_ += [None] * k
                    c_.append(x_)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(col, types, strict=True)], names)

    types = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    names = ["uid", "word", "n", "doc_id", "train", "words", "hits", "base", "lpsum"]
    for_all = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long"), F.col(train), text_bytes().alias("t"))
    pairs = for_all.mapInArrow(split, "uid long, word binary, n int, doc_id long, train boolean, words long, hits long, base double, lpsum double")
    tail = counts.where(F.col("c") < floor).mapInArrow(weigh, "word binary, c long, lp double")
    n, got = F.col("n"), F.coalesce("c", F.lit(0))
    sums = pairs.join(tail, "word", "left").groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), F.max("train").alias(train), F.max("words").alias("words"), F.max("hits").alias("hits"), F.max("base").alias("base"), F.max("lpsum").alias("lpsum"),
        F.sum(n * F.log10(got + 1.0)).alias("more"), F.sum(F.when(got > 0, n).otherwise(0)).alias("rare"), F.sum(F.when(n > 0, n * F.col("lp")).otherwise(0.0)).alias("lat"),
    )
    tokens = F.col("words") + 1
    return sums.select(
        "doc_id", train, tokens.alias("n_tokens"), (F.col("hits") + F.col("rare") + (1 if ends else 0)).alias("n_known"), F.lit(int(n_all)).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("more") + math.log10(ends + 1) - tokens * low).alias("base_score"), (F.col("lpsum") + F.col("lat") + p_end).alias("score"),
    )
