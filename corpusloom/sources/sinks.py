"""Writers: grouped trees, reports, audit logs, manifests and an atomic publish."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import path_segment, split_name


def write_shards(df: DataFrame, path: str, rows: int = 100_000, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("maxRecordsPerFile", rows).option("compression", "zstd").parquet(path)


def write_tree(df: DataFrame, path: str, by: tuple[str, ...] = ("dataset", "language"), rows: int = 100_000, mode: str = "errorifexists") -> None:
    """A partitioned tree; large groups are dealt over several tasks (rebalance), small ones share them."""
    keys = [f"_{c}" for c in by]
    out = df.withColumns({k: path_segment(F.coalesce(c, F.lit("unknown"))) for k, c in zip(keys, by, strict=True)})
    out.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).option("maxRecordsPerFile", rows).option("compression", "zstd").parquet(path)


def group_manifest(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.count_distinct("_file").alias("shards") if "_file" in df.columns else F.lit(None).cast("long").alias("shards"))


def card(groups: DataFrame, name: str) -> str:
    """A dataset card: YAML configs of the (dataset, language) groups; names that collide get a suffix."""
    seen: dict[str, int] = {}
    lines = ["---", "configs:"]
    rows = groups.select("dataset", "language", split_name(F.coalesce("language", F.lit("unknown"))).alias("split"), "rows").orderBy("dataset", "language").collect()
    for r in rows:
        seen[r.split] = seen.get(r.split, 0) + 1
        split = r.split if seen[r.split] == 1 else f"{r.split}_{seen[r.split]}"
        lines += [f"- config_name: {r.dataset}", f"  data_files: [{{split: {split}, path: '{r.dataset}/{r.language}/*.parquet'}}]"]
    return "\n".join([*lines, "---", f"# {name}", "", f"{sum(r.rows for r in rows)} rows in {len(rows)} groups."])


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file by the file system that Spark uses."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(conf).create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_manifest(spark: SparkSession, path: str, **facts) -> None:
    write_text(spark, path, json.dumps(facts, sort_keys=True, indent=1, default=str))


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def copy(spark: SparkSession, source: str, target: str) -> None:
    """One file from a store that Spark reads to another, through a name of its own, so that no reader sees half of it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    a, b, stage = (jvm.org.apache.hadoop.fs.Path(x) for x in (source, target, f"{target}.part-{uuid.uuid4().hex}"))
    fs = b.getFileSystem(conf)
    if not fs.exists(b):
        jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, fs, stage, False, conf)
        if not fs.rename(stage, b):
            raise OSError(f"can't rename to {target}")


def mirror(df: DataFrame, root: str, target: str, add: dict[str, Column]) -> None:
    """All columns of a tree's rows and ``add``, in folders of the same names under ``target``; older added columns go first."""
    rel = F.regexp_replace(F.col("_metadata.file_path"), "^(file:)?/*" + re.escape(root.removeprefix("file:").strip("/")) + "/|[^/]+$", "")
    rows = df.select("*", rel.alias("_folder")).drop(*add).withColumns(add)
    folders = [r[0] for r in rows.select("_folder").distinct().collect()]  # one row a (dataset, language) folder
    for f in folders:
        rows.where(F.col("_folder") == f).drop("_folder").write.mode("errorifexists").option("compression", "zstd").parquet(f"{target}/{f}")


def publish(df: DataFrame, target: str, verify, marker: str = "_OURS") -> None:
    """Writes beside the target, verifies, then renames; a folder without our marker is never replaced, and a lock file keeps a second run out."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = path(target).getFileSystem(conf)
    if fs.exists(path(target)) and not fs.exists(path(f"{target}/{marker}")):
        raise ValueError(f"{target} exists and is not of this engine")
    lock = path(f"{target}.lock")
    if not fs.createNewFile(lock):
        raise ValueError(f"another run publishes to {target}")
    stage, old = f"{target}.stage-{uuid.uuid4().hex}", f"{target}.old-{uuid.uuid4().hex}"
    try:
        df.write.option("compression", "zstd").parquet(stage)
        bad = verify(spark.read.parquet(stage))
        if not bad.isEmpty():
            raise ValueError(f"verification failed: {bad.limit(5).collect()}")
        write_text(spark, f"{stage}/{marker}", "")
        had = fs.exists(path(target))
        if had and not fs.rename(path(target), path(old)):
            raise OSError(f"can't move {target} aside")
        if not fs.rename(path(stage), path(target)):
            if had:
                fs.rename(path(old), path(target))
            raise OSError(f"can't rename to {target}")
        fs.delete(path(old), True)
    finally:
        fs.delete(path(stage), True)
        fs.delete(lock, False)
