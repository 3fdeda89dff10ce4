"""Dedupe, ranks, histograms, joins and checks over comment tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import finite


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key; ``order`` has to be total, so that the survivor is always the same."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def top_k(df: DataFrame, keys: list[str], k: int, *order: Column) -> DataFrame:
    """At most ``k`` rows of each key; the limit is applied below the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def pending(listed: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return listed.join(done.select(key), key, "left_anti")


def completed(listed: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return listed.join(done.select(key), key, "left_semi")


def ordinals(df: DataFrame, by: list[str], *order: Column, name: str = "ordinal") -> DataFrame:
    """Position from 0 within ``by``."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)


def ranged_ordinals(df: DataFrame, by: str, key: str, name: str = "ordinal", rows: int = 1_000_000) -> DataFrame:
    """Position from 0 within ``by`` in order of a unique ``key``, with no task that sorts a whole group.

    Ranges of the key of about ``rows`` rows are numbered alone and shifted by
    the group's rows in the ranges before.
    """
    n = df.count()
    parts = min(4096, -(-n // rows))
    if parts <= 1:
        return ordinals(df, [by], F.col(key), name=name)
    cuts = sorted(set(df.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)], 4 * parts)).first()[0]))
    placed = df.withColumn("_p", F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col(key))))
    sizes = placed.groupBy(F.col(by).alias("_by"), F.col("_p").alias("_q")).agg(F.count("*").alias("_n"))
    before = sizes.select("_by", "_q", (F.sum("_n").over(Window.partitionBy("_by").orderBy("_q")) - F.col("_n")).alias("_before"))
    within = placed.withColumn(name, F.row_number().over(Window.partitionBy(by, "_p").orderBy(key)) - 1)
    both = within.join(before, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_p") == F.col("_q")))
    return both.withColumn(name, (F.col(name) + F.col("_before")).cast("int")).drop("_p", "_q", "_by", "_before")


def global_ordinals(df: DataFrame, key: str, parts: int | None = None, name: str = "ordinal") -> DataFrame:
    """Gapless positions from 0 by a unique ``key`` over all rows, without one task that sorts all of them.

    Rows are cut into ranges at approximate quantiles of the key; each range is
    numbered alone and shifted by the count of the ranges before it.
    """
    parts = parts or min(4096, max(2, df.count() // 1_000_000))
    cuts = df.agg(F.percentile_approx(F.col(key), [i / parts for i in range(1, parts)], 100 * parts)).first()[0] or []
    cuts = sorted(set(cuts))
    at = F.lit(0)
    if cuts:
        at = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col(key)))
    placed = df.withColumn("_p", at)
    counts = {r._p: r.n for r in placed.groupBy("_p").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for p in range(max(counts, default=0) + 1):
        before.append(total)
        total += counts.get(p, 0)
    w = Window.partitionBy("_p").orderBy(key)
    return placed.withColumn(name, F.get(F.array(*[F.lit(b).cast("long") for b in before]), F.col("_p")) + F.row_number().over(w) - 1).drop("_p")


def histogram(df: DataFrame, col: str, bins: int, lo: float, hi: float, by: list[str] = ()) -> DataFrame:
    """Counts of ``bins`` equal-width bins over [lo, hi]; half-open but for the last; empty bins included."""
    spark = df.sparkSession
    width = (hi - lo) / bins
    got = df.where(finite(F.col(col)) & F.col(col).between(lo, hi)).groupBy(*by, F.least(F.floor((F.col(col) - lo) / width), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    every = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    if by:
        every = df.select(*by).distinct().select(*by, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.join(got, [*by, "bin"], "left").select(*by, "bin", (lo + F.col("bin") * width).alias("bin_lo"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def histogram_stats(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    c, ok = F.col(col), finite(F.col(col))
    return df.agg(
        F.count("*").alias("records"), F.count_if(ok).alias("scores"), F.count_if(c.isNull()).alias("missing"), F.count_if(c.isNotNull() & ~ok).alias("invalid"), F.count_if(ok & ~c.between(lo, hi)).alias("outside"),
        F.min(F.when(ok, c)).alias("lowest"), F.max(F.when(ok, c)).alias("highest"), F.round(F.avg(F.when(ok, c)), 6).alias("mean"),
    )


def render_histogram(rows: list, width: int = 40) -> str:
    """Text bars of collected (bin_lo, n) rows."""
    top = max((r.n for r in rows), default=0)
    labels = [f"{r.bin_lo:.2f}" for r in rows]
    pad = max(map(len, labels), default=0)
    return "\n".join(f"{x.rjust(pad)} | {'#' * round(r.n / top * width) if top else ''} {r.n}" for x, r in zip(labels, rows, strict=True))


def label_matrix(df: DataFrame, by: list[str], col: str, values: list) -> DataFrame:
    """Pivoted counts with zeros."""
    return df.groupBy(*by).pivot(col, values).count().na.fill(0)


def reconcile(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Ids that only one side has or whose common columns differ (null equals null)."""
    cols = [c for c in a.columns if c != key and c in b.columns]
    x, y = a.select(F.col(key), F.struct(*cols).alias("x")), b.select(F.col(key), F.struct(*cols).alias("y"))
    both = x.join(y, key, "full_outer")
    return both.select(key, F.when(F.col("x").isNull(), "missing_left").when(F.col("y").isNull(), "missing_right").when(~F.col("x").eqNullSafe(F.col("y")), "differs").alias("problem")).where("problem is not null")


def violations(**rules: DataFrame) -> DataFrame:
    """Union of (rule, id) over tables of bad ids."""
    out = None
    for name, bad in rules.items():
        part = bad.select(F.lit(name).alias("rule"), F.col(bad.columns[0]).cast("string").alias("id"))
        out = part if out is None else out.unionByName(part)
    return out


def event_pairs(events: DataFrame, by: str, ts: str, kind: str, start: str, finish: str, id: str = "event_id") -> DataFrame:
    """Each finish with the latest start before it that no other finish has taken; ``by`` may be any key, ``id`` breaks ties."""
    w = Window.partitionBy(by).orderBy(ts, id)
    marked = events.where(F.col(kind).isin(start, finish)).withColumn("_prev", F.lag(kind).over(w)).withColumn("_at", F.lag(ts).over(w))
    return marked.where((F.col(kind) == finish) & (F.col("_prev") == start)).select(by, F.col("_at").alias("started"), F.col(ts).alias("finished"))


def falls(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value is below that of the row before."""
    return df.withColumn("_before", F.lag(value).over(Window.partitionBy(*by).orderBy(*order))).where(F.col(value) < F.col("_before")).drop("_before")


def rising(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """``df``, whose run fails at a row that ``falls`` would give."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(*order))
    bad = F.raise_error(F.concat(F.lit(f"{value} falls to "), F.col(value).cast("string"))).cast("boolean")
    return df.withColumn("_before", before).where(F.when(F.col(value) < F.col("_before"), bad).otherwise(True)).drop("_before")


def runs(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """How often the value changes within each key, the first row included."""
    marked = df.withColumn("_before", F.lag(value).over(Window.partitionBy(*by).orderBy(*order)))
    return marked.groupBy(*by).agg(F.count_if(~F.col(value).eqNullSafe(F.col("_before"))).alias("runs"))
