"""Optimal length buckets.

The exact histogram of lengths goes through a dynamic program (divide and
conquer, the cost being quadrangle-monotone) that picks the bucket boundaries
of least total padding.  Batches fill a token budget inside a bucket: every row
counts as long as its bucket's boundary.  A bucket's rows are dealt over many
chunks, whose counts turn chunk positions into gapless bucket ranks, so a hot
length needs no task of its own.

The histogram has one row a distinct length, whatever the number of documents.
Cases: a null or empty text has length 0; a row longer than the budget has a
batch of its own with ``over_budget``; repeated rows and ties each get a place;
an empty table gives no rows; extra columns are carried through, but those
named like a column of the result (n_tokens, bucket, padded_to, batch, place,
padding, over_budget) are replaced by it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, spare

CHUNK = 20_000


def n_words(col: str = "text") -> Column:
    """Words of a text; null has none."""
    t = F.coalesce(F.col(col), F.lit(""))
    return F.regexp_count(t, F.lit("[^\\x20\\x09-\\x0D]+"))


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The ascending bucket boundaries of least padding, at most ``buckets``."""
    order = np.argsort(lengths)
    x, c = np.asarray(lengths)[order].astype(np.float64), np.asarray(counts)[order].astype(np.float64)
    n = len(x)
    if not n:
        return []
    cs, cx = np.concatenate([[0], np.cumsum(c)]), np.concatenate([[0], np.cumsum(c * x)])
    k = min(buckets, n)
    best = np.full(n + 1, np.inf)
    best[0] = 0
    back = np.zeros((k + 1, n + 1), np.int64)
    for b in range(1, k + 1):
        nxt = np.full(n + 1, np.inf)
        todo = [(b, n, b - 1, n - 1)]
        while todo:
            lo, hi, a, z = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(a, min(z, j - 1) + 1)
            cost = best[i] + x[j - 1] * (cs[j] - cs[i]) - (cx[j] - cx[i])
            m = int(np.argmin(cost))
            nxt[j], back[b, j] = cost[m], i[m]
            todo += [(lo, j - 1, a, int(i[m])), (j + 1, hi, int(i[m]), z)]
        best = nxt
    out, j = [], n
    for b in range(k, 0, -1):
        out.append(int(x[j - 1]))
        j = int(back[b, j])
    return out[::-1]


def pack(docs: DataFrame, length: Column, buckets: int = 8, budget: int = 16_384, key: str = "doc_id") -> DataFrame:
    """``docs`` with n_tokens, bucket, padded_to, batch (from 0 within a bucket), place, padding and over_budget."""
    part, rank, tie, b2, p2, before = spare(docs, "pack_part", "pack_rank", "pack_key", "pack_b", "pack_p", "pack_before")
    rows = cut(docs.withColumns({tie: F.col(key), "n_tokens": length.cast("long")}))
    hist = rows.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()
    lens, counts = np.array([r[0] for r in hist], np.int64), np.array([r[1] for r in hist], np.int64)
    cuts = boundaries(lens, counts, buckets) or [0]
    bucket = F.lit(len(cuts) - 1)
    for i in range(len(cuts) - 2, -1, -1):
        bucket = F.when(F.col("n_tokens") <= cuts[i], i).otherwise(bucket)
    size = np.bincount(np.searchsorted(cuts, lens), weights=counts, minlength=len(cuts)).astype(int)
    pick = lambda xs, at: F.get(F.array(*[F.lit(int(v)).cast("long") for v in xs]), at)
    chunk = F.pmod(F.xxhash64(tie, "n_tokens", F.monotonically_increasing_id()), pick(size // CHUNK + 4, F.col("bucket")))
    dealt = cut(rows.withColumn("bucket", bucket.cast("int")).withColumn(part, chunk))
    # Where each chunk starts within its bucket: one row a chunk, summed up in order.
    starts = dealt.groupBy(F.col("bucket").alias(b2), F.col(part).alias(p2)).agg(F.count("*").alias("n"))
    starts = starts.select(b2, p2, (F.sum("n").over(Window.partitionBy(b2).orderBy(p2)) - F.col("n")).alias(before))
    within = F.row_number().over(Window.partitionBy("bucket", part).orderBy(tie, "n_tokens"))
    placed = dealt.withColumn(rank, within).join(starts, (F.col("bucket") == F.col(b2)) & (F.col(part) == F.col(p2))).withColumn(rank, F.col(rank) - 1 + F.col(before))
    each, to = pick([max(1, budget // max(1, c)) for c in cuts], F.col("bucket")), pick(cuts, F.col("bucket"))
    return (
        placed.withColumn("padded_to", to).withColumn("batch", F.floor(F.col(rank) / each).cast("long")).withColumn("place", F.pmod(F.col(rank), each).cast("int"))
        .withColumn("padding", F.col("padded_to") - F.col("n_tokens")).withColumn("over_budget", F.col("padded_to") > budget).drop(rank, part, tie, b2, p2, before)
    )
