"""Benchmark decontamination by a broadcast set of n-grams.

Documents are normalised like the benchmark (A-Z lower-cased, words of letters,
digits and non-ASCII characters).  The benchmark's words are numbered, a
document's words looked up in that table, and every run of words that the
benchmark knows is hashed by windows; hits are then verified word by word.
The set is broadcast when its words number at most ``BOUND``.  A larger
benchmark is dealt into slices of that bound; each has a pass of its own over
the documents, whose hits are written before its broadcast is freed, so driver
and workers hold one slice at a time, and the passes are merged by document.

Cases: null texts have no words; items without words match nothing; an item of
fewer than ``n`` words is one window; equal items each count; a null item_id is
left out; texts are scanned whole, however long; repeated rows and ties are
reported each; empty tables give no rows (documents) or no hits (benchmark);
``find`` returns its own columns only, ``clean`` all of its input's, whatever
their names.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, chunks, cut, spare, text_bytes, where_python

#: Benchmark words in one broadcast set at most.
BOUND = 2_000_000
_KEEP = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
PRIME = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


class Grams:
    """The windows of a benchmark by length, for lookups in word lists."""

    def __init__(self, items: list[tuple[int, bytes]], n: int = 8):
        self.ids: dict[bytes, int] = {}
        by: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            w = tuple(self.ids.setdefault(x, len(self.ids) + 1) for x in words_of(text))
            size = min(n, len(w))
            for i in range(len(w) - size + 1 if w else 0):
                by[size][w[i : i + size]].add(item)
        self.by = {k: dict(v) for k, v in by.items()}
        self.hashes = {k: np.sort(self._hash(np.array(list(v), np.uint64).reshape(-1, k), k)) for k, v in self.by.items()}
        self.shortest = min(self.by, default=0)

    @staticmethod
    def _hash(w: np.ndarray, k: int) -> np.ndarray:
        h = np.zeros(len(w), np.uint64)
        for j in range(k):
            h = (h + w[:, j]) * PRIME
            h ^= h >> np.uint64(31)
        return h

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """A mask of the words inside any occurring window, and the items that these belong to."""
        mask, items = np.zeros(len(words), bool), set()
        if not self.by or len(words) < self.shortest:
            return mask, items
        get = self.ids.get
        ids = np.array([get(w, 0) for w in words], np.uint64)
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        for k, table in self.by.items():
            if len(words) < k:
                continue
            at = np.flatnonzero(known[k:] - known[:-k] == k)
            if not len(at):
                continue
            h = np.zeros(len(at), np.uint64)
            for j in range(k):
                h = (h + ids[at + j]) * PRIME
                h ^= h >> np.uint64(31)
            sorted_h = self.hashes[k]
            pos = np.minimum(np.searchsorted(sorted_h, h), len(sorted_h) - 1)
            for i in at[sorted_h[pos] == h].tolist():
                found = table.get(tuple(ids[i : i + k].tolist()))
                if found:
                    mask[i : i + k] = True
                    items |= found
        return mask, items


def slices(benchmark: DataFrame) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in parts of at most ``BOUND`` words (one longer item alone aside)."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), text_bytes().alias("t")).where("i is not null").orderBy("i", "t")
    part, size, none = [], 0, True
    for r in rows.toLocalIterator():
        n = len(r.t) // 2 + 1
        if part and size + n > BOUND:
            yield part
            part, size, none = [], 0, False
        part.append((r.i, bytes(r.t)))
        size += n
    if part or none:
        yield part


def scan(docs: DataFrame, part: list, n: int) -> tuple[DataFrame, Broadcast]:
    """doc_id, th, n_words, ``at`` (positions of hit words) and ``items`` of each row, for one slice; and its broadcast."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Grams(part, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 1024):
            total, at, items = [], [], []
            for t in b.column(2).to_pylist():
                w = words_of(t)
                mask, got = shared.value.hits(w)
                total.append(len(w))
                at.append(np.flatnonzero(mask).astype(np.int32))
                items.append(sorted(got))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(total, pa.int64()), pa.array(at, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))], ["doc_id", "th", "n_words", "at", "items"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), text_bytes().alias("t"))
    return rows.mapInArrow(run, "doc_id long, th long, n_words long, at array<int>, items array<string>"), shared


def marks(docs: DataFrame, parts: Iterator[list], n: int) -> DataFrame:
    """doc_id, th, at, items of each hit document over all slices: a written pass a slice, merged."""
    out = None
    for part in parts:
        rows, shared = scan(docs, part, n)
        hits = cut(rows.where(F.size("at") > 0).select("doc_id", "th", "at", "items"))
        shared.destroy()
        out = hits if out is None else out.unionByName(hits)
    all_of = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return out.groupBy("doc_id", "th").agg(all_of("at"), all_of("items"))


def two_at_most(benchmark: DataFrame) -> tuple[list, Iterator[list]]:
    """The first slice or two, to tell whether one is all, and an iterator of all slices."""
    every = slices(benchmark)
    first = list(islice(every, 2))
    return first, chain(first, every)


def find(docs: DataFrame, benchmark: DataFrame, n: int = 8) -> DataFrame:
    """doc_id, n_words, n_hit and ``items`` (sorted item ids as text) of each row."""
    first, every = two_at_most(benchmark)
    rows, shared = scan(docs, first[0] if len(first) == 1 else [], n)
    if len(first) > 1:
        hits = marks(docs, every, n).withColumnsRenamed({"doc_id": "d", "th": "t", "at": "a", "items": "i"})
        none = F.array().cast("array<string>")
        rows = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left").withColumns({"at": F.coalesce("a", F.array().cast("array<int>")), "items": F.coalesce("i", none)})
    return rows.select("doc_id", "n_words", F.size("at").cast("long").alias("n_hit"), "items")


def item_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def clean(docs: DataFrame, benchmark: DataFrame, n: int = 8, drop: bool = True, least: int = 1) -> DataFrame:
    """``docs`` without contamination, columns unchanged.

    ``drop``: rows with ``least`` hit words or more go; else the hit words (and
    what stands between hit neighbours) are cut out of the text.
    """
    first, every = two_at_most(benchmark)
    bound_batches(docs.sparkSession)
    many = len(first) > 1
    shared = docs.sparkSession.sparkContext.broadcast(Grams([] if many else first[0], n))
    rows, at = docs, ""
    if many:
        d, t, at = spare(docs, "hit_d", "hit_t", "hit_at")
        hits = marks(docs, every, n).select(F.col("doc_id").alias(d), F.col("th").alias(t), F.col("at").alias(at))
        rows = docs.join(hits, docs["doc_id"].cast("long").eqNullSafe(F.col(d)) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col(t)), "left").drop(d, t)
        if drop:
            return rows.where(F.coalesce(F.size(at), F.lit(0)) < least).select(*docs.columns)

    def masked(t: str | None, spots: list[int] | None) -> np.ndarray:
        w = words_of((t or "").encode())
        if not many:
            return shared.value.hits(w)[0]
        mask = np.zeros(len(w), bool)
        mask[spots or []] = True
        return mask

    if drop:

        @F.arrow_udf("boolean")
        def fine(texts: pa.Array) -> pa.Array:
            return pa.array([int(masked(t, None).sum()) < least for t in texts.to_pylist()], pa.bool_())

        return where_python(docs, fine, F.col("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 1024):
            k = b.schema.get_field_index("text")
            texts = b.column(k).to_pylist()
            spots = b.column(b.num_columns - 1).to_pylist() if many else [None] * len(texts)
            cols = list(b.columns)[: len(names)]
            cols[k] = pa.array([without(t, masked(t, p)) if t else t for t, p in zip(texts, spots, strict=True)], b.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(cols, names)

    names = docs.columns
    return rows.mapInArrow(run, docs.schema)


def without(text: str, mask: np.ndarray) -> str:
    """``text`` without its hit words and the gaps between neighbouring ones."""
    if not mask.any():
        return text
    raw = text.encode()
    flat = raw.translate(_KEEP)
    spans, at = [], 0
    for w in flat.split():
        a = flat.index(w, at)
        at = a + len(w)
        spans.append((a, at))
    out, pos, i = [], 0, 0
    while i < len(spans):
        if mask[i]:
            j = i
            while j + 1 < len(spans) and mask[j + 1]:
                j += 1
            out.append(raw[pos : spans[i][0]])
            pos = spans[j][1]
            i = j
        i += 1
    return (b"".join(out) + raw[pos:]).decode()
