"""Streams: ingest with exactly-once files, windows, sessions, pairing, smoothing.

Each function takes a DataFrame, streaming or not, so a batch run has the same
result as a stream that has seen all of its input.
"""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout


def timed(df: DataFrame, ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """Timestamps in UTC under a watermark (the tables have them without a zone)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def tumbling(df: DataFrame, width: str, by: list[str], ts: str = "ts") -> DataFrame:
    return df.groupBy(F.window(ts, width), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), *by, "n", "total")


def sliding(df: DataFrame, width: str, step: str, by: list[str], ts: str = "ts") -> DataFrame:
    return df.groupBy(F.window(ts, width, step), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *by, "n")


def sessions(df: DataFrame, gap: str, by: list[str], ts: str = "ts") -> DataFrame:
    return df.groupBy(F.session_window(ts, gap), *by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *by, "n")


def distinct_events(df: DataFrame, key: list[str]) -> DataFrame:
    return df.dropDuplicatesWithinWatermark(key) if df.isStreaming else df.dropDuplicates(key)


def ingest(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, transform=lambda df: df) -> None:
    """All new files once, then stop; the file sink and the checkpoint make the output exactly-once."""
    df = transform(spark.readStream.schema(schema).parquet(source))
    df.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def pair_stream(df: DataFrame, key: str, start: str, finish: str) -> DataFrame:
    """Finish events with the time since the start before them, with the open start as state."""

    def run(k, parts, state):
        open_at = state.get[0] if state.exists else None
        rows = pd.concat(list(parts)).sort_values("ts")
        out = []
        for t, kind in zip(rows["ts"], rows["event_type"], strict=True):
            if kind == start:
                open_at = t.timestamp()
            elif kind == finish and open_at is not None:
                out.append((k[0], t.timestamp() - open_at))
                open_at = None
        state.update((open_at,))
        yield pd.DataFrame(out, columns=[key, "seconds"])

    kind = df.schema[key].dataType.simpleString()
    return df.groupBy(key).applyInPandasWithState(run, f"{key} {kind}, seconds double", "open_at double", "append", GroupStateTimeout.NoTimeout)


def trailing_rate(df: DataFrame, end: Column, hours: float, ts: str = "ts") -> DataFrame:
    """Events an hour in the trailing window."""
    return df.where((F.col(ts) > end - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")) & (F.col(ts) <= end)).agg((F.count("*") / hours).alias("per_hour"))


def ema(df: DataFrame, by: list[str], order: str, value: str, alpha: float = 0.35) -> DataFrame:
    """Exponential moving average seeded by the first non-zero value; ``df`` has few steps a key (already windowed)."""
    steps = F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda s: s[value].cast("double"))
    fold = lambda acc, v: F.when(acc == 0, v).otherwise(acc * (1 - alpha) + v * alpha)
    return df.groupBy(*by).agg(F.aggregate(steps, F.lit(0.0), fold).alias("ema"))


def durations(df: DataFrame, col: str) -> DataFrame:
    c = F.col(col)
    return df.agg(F.count(c).alias("n"), F.round(F.avg(c), 6).alias("mean"), F.round(F.stddev_pop(c), 6).alias("sd"), F.round(F.median(c), 6).alias("median"), F.round(F.percentile(c, F.lit(0.1)), 6).alias("p10"), F.round(F.percentile(c, F.lit(0.9)), 6).alias("p90"))


def latest_progress(df: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """The last value of each key, and never less than one seen before."""
    return df.groupBy(key).agg(F.max(value).alias(value))  # what never falls ends at its maximum


def latest_durations(df: DataFrame, ts: str, id: str, value: str, n: int = 100, shown: int = 5) -> DataFrame:
    """Statistics of the latest ``n`` durations and the latest ``shown`` of them, newest first; the limit is the feature."""
    last = df.select(F.col(ts).alias("t"), F.col(id).alias("i"), F.col(value).alias("v")).where("v is not null").orderBy(F.desc("t"), F.desc("i")).limit(n)
    newest = F.transform(F.slice(F.sort_array(F.collect_list(F.struct("t", "i", "v")), asc=False), 1, shown), lambda x: x["v"])
    stats = durations(last, "v")
    return stats.join(last.agg(newest.alias("latest")), how="inner")  # one row by one row


def group_progress(listed: DataFrame, done: DataFrame, active: DataFrame, group: str, id: str) -> DataFrame:
    """group, total, completed, active: three counts in one pass over marked rows."""
    mark = lambda df, k: df.select(group, *[F.lit(int(k == x)).alias(x) for x in ("total", "completed", "active")])
    every = mark(listed, "total").unionByName(mark(done, "completed")).unionByName(mark(active, "active"))
    return every.groupBy(group).agg(*[F.sum(x).cast("long").alias(x) for x in ("total", "completed", "active")])


def usage(df: DataFrame, by: list[str], *cols: str) -> DataFrame:
    """Sums of token and retry counts, null as none."""
    return df.groupBy(*by).agg(F.count("*").alias("calls"), *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in cols])


def completion(checkpoints: DataFrame, inventory: DataFrame, shard: str, at: str, done: str, size: str, rate: float) -> DataFrame:
    """One row: shards, those begun, what their latest checkpoints add up to, what is left, and seconds to go at ``rate``."""
    latest = checkpoints.groupBy(shard).agg(F.max_by(done, at).alias("_done"))
    both = inventory.join(latest, shard, "left")
    left = F.sum(F.greatest(F.col(size) - F.coalesce("_done", F.lit(0)), F.lit(0)))
    return both.agg(F.count("*").alias("shards"), F.count("_done").alias("begun"), F.coalesce(F.sum("_done"), F.lit(0)).alias("done"), left.alias("left")).withColumn("eta_seconds", F.round(F.col("left") / rate, 3))


def log_time(line: Column) -> Column:
    """The leading time stamp of a log line, null without one."""
    return F.try_to_timestamp(F.regexp_extract(line, "^([0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2},[0-9]{3})", 1), F.lit("yyyy-MM-dd HH:mm:ss,SSS"))
