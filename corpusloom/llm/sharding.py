"""Range sharding by sampled splitters, with exact byte balance.

A size-weighted sample of keys (the exponential draws by size below a threshold) gives
the quantile boundaries of fine ranges; ranges that come out overfull are cut
again by boundaries from a sample of their own.  Rows of one range are ordered
and summed in one task; range totals (a bounded table) turn those sums into
exact global offsets, so that the shards of the ``bytes`` law differ by at most
about one row's size.  The sort key is (key, uid), where ``uid`` is fixed by a
written checkpoint, so a hot key is cut like any other and a retried task sees
the same order.

Cases: null text has size 1, texts of any length count whole; null keys sort
first; repeated rows and repeated keys each get a slot; an empty table gives no
rows; extra columns are carried through, but ``shard`` and ``slot`` replace
columns of these names.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_of, cut

#: At most so many ranges, and so many sampled keys for each.
RANGES, PER_RANGE = 2048, 32


def unit_size(col: str = "text") -> Column:
    """UTF-8 bytes of the text plus one."""
    return (F.coalesce(F.octet_length(col), F.lit(0)) + 1).cast("long")


def weighted_keys(rows: DataFrame, total: int, n: int, *keep: str) -> list:
    """About ``n`` rows at most, drawn with weight ``size``: those with -ln(u) / size of ``n`` / ``total`` or less, found where they lie."""
    u = (F.pmod(F.xxhash64("key", "uid", F.lit(11)), F.lit(1 << 53)) + 1) / float(1 << 53)
    return rows.where(-F.log(u) / F.col("size") <= n / max(1, total)).select("key", "uid", *keep).collect()


def quantiles(keys: list[tuple[int, int]], parts: int) -> list[tuple[int, int]]:
    keys = sorted(keys)
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []


def ranged(rows: DataFrame, total: int, ranges: int) -> DataFrame:
    """``rows`` (key, uid, size, ...) with ``range``, of nearly equal size, ascending in (key, uid)."""
    cuts = quantiles([(r.key, r.uid) for r in weighted_keys(rows, total, ranges * PER_RANGE)], ranges)

    def placed(cuts: list[tuple[int, int]]) -> DataFrame:
        # Rows are compared by key first; ties by the uid among the cuts of that key.
        firsts = sorted({k for k, _ in cuts})
        at = bucket_of(F.col("key"), firsts)
        before = [bisect_left(cuts, (k, -(1 << 63))) for k in firsts] + [len(cuts)]
        hot = {k: [u for kk, u in cuts if kk == k] for k in firsts}
        out = F.get(F.array(*[F.lit(b) for b in before]), at)
        if hot:
            tie = F.get(F.array(*[F.lit(k) for k in firsts]), at) == F.col("key")
            starts = F.get(F.array(*[F.array(*[F.lit(u) for u in us]) for us in hot.values()]), at)
            out = F.when(tie, out + F.size(F.filter(starts, lambda u: u < F.col("uid")))).otherwise(out)
        return rows.withColumn("range", out.cast("int"))

    out = placed(cuts)
    got = {r[0]: r[1] for r in out.groupBy("range").agg(F.sum("size").alias("s")).collect()}
    full = 2 * total / max(1, ranges)
    over = [k for k, s in got.items() if s > full]
    if over:
        extra = []
        drawn = weighted_keys(out.where(F.col("range").isin(over)), sum(got[k] for k in over), min(RANGES, ranges) * PER_RANGE, "range")
        for k in over:
            parts = min(64, int(2 * got[k] / full) + 1)
            extra += quantiles([(r.key, r.uid) for r in drawn if r["range"] == k], parts)
        out = placed(sorted({*cuts, *extra}))
    return out


def shard(rows: DataFrame, key: Column, size: Column, shards: int, ranges: int | None = None) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1, sizes near equal) and ``slot`` (gapless from 0 within a shard), ranged by ``key`` (a long).

    The caller's columns travel as one struct, so their names clash with nothing.
    """
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    fixed = cut(rows.select(
        F.struct(*kept, F.lit(0).alias("shard")).alias("row"), F.coalesce(key.cast("long"), F.lit(-(1 << 63))).alias("key"), size.cast("long").alias("size"), F.monotonically_increasing_id().alias("uid")
    ))
    n, total = fixed.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = ranges or min(RANGES, max(8 * shards, n // 100_000))
    out = ranged(fixed, total, ranges)
    sums = {r[0]: r for r in out.groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("s")).collect()}
    at = rows_at = 0
    offsets = []
    for k in range(max(sums, default=0) + 1):
        offsets.append((at, rows_at))
        if k in sums:
            at, rows_at = at + sums[k].s, rows_at + sums[k].n
    pick = lambda i: F.get(F.array(*[F.lit(int(o[i])).cast("long") for o in offsets]), F.col("range"))
    w = Window.partitionBy("range").orderBy("key", "uid")
    pos = pick(0) + F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.expr("size div 2")
    spot = F.least(F.expr(f"pos * {shards} div {max(1, total)}"), F.lit(shards - 1)).cast("int")
    placed = out.withColumn("pos", pos).withColumn("rank", pick(1) + F.row_number().over(w) - 1).withColumn("shard", spot)
    # Each range touches one shard or a few, so the first rank of a shard is a bounded table too.
    first = {r.shard: r.lo for r in placed.groupBy("shard").agg(F.min("rank").alias("lo")).collect()}
    starts = F.get(F.array(*[F.lit(first.get(i, 0)).cast("long") for i in range(shards)]), F.col("shard"))
    return placed.select(*[F.col("row")[c].alias(c) for c in kept], "shard", (F.col("rank") - starts).cast("long").alias("slot"))
