"""Readers that give records, and their registry."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMNS = {
    "content": ["content", "text", "code"], "language": ["language", "lang", "gha_language", "ext"], "path": ["path", "max_stars_repo_path", "file_path", "filename", "meta.path"],
    "repo": ["repo", "repo_name", "max_stars_repo_name", "repository", "meta.repo_name"],
}
READERS: dict[str, Callable[..., DataFrame]] = {}


def reader(name: str):
    def add(f):
        READERS[name] = f
        return f

    return add


def has(schema: T.StructType, dotted: str) -> bool:
    for part in dotted.split("."):
        if not isinstance(schema, T.StructType) or part not in schema.names:
            return False
        schema = schema[part].dataType
    return True


def first_of(df: DataFrame, names: list[str]) -> Column:
    """First non-null of the columns (dotted names allowed) that exist; lists give their first item, structs their name."""

    def flat(n: str) -> Column:
        kind = df.schema
        for part in n.split("."):
            kind = kind[part].dataType
        c = F.col(n)
        if isinstance(kind, T.ArrayType):
            return F.get(F.flatten(c) if isinstance(kind.elementType, T.ArrayType) else c, 0).cast("string")
        if isinstance(kind, T.StructType):
            keys = [k for k in ("name", "language", "lang") if k in kind.names]
            return F.coalesce(*[c[k].cast("string") for k in keys]) if keys else F.lit(None).cast("string")
        return c.cast("string")

    found = [flat(n) for n in names if has(df.schema, n)]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def records(df: DataFrame, dataset: str, columns: dict[str, list[str]] | None = None, record_id: Column | None = None) -> DataFrame:
    """dataset, record_id, content, language, path, repo and all other columns as JSON."""
    names = COLUMNS | (columns or {})
    content = next((n for n in names["content"] if has(df.schema, n)), None)
    rest = [c for c in df.columns if c != content and not c.startswith("_")]
    if record_id is None:
        record_id = F.concat(F.element_at(F.split(F.col("_file"), "/"), -1), F.lit("::row::"), F.col("_row").cast("string")) if "_file" in df.columns else F.lit(None).cast("string")
    return df.select(
        F.lit(dataset).alias("dataset"), record_id.alias("record_id"), first_of(df, names["content"]).alias("content"), first_of(df, names["language"]).alias("language"), first_of(df, names["path"]).alias("path"), first_of(df, names["repo"]).alias("repo"),
        (F.to_json(F.struct(*rest)) if rest else F.lit("{}")).alias("metadata"),
    )


@reader("parquet")
def parquet(spark: SparkSession, path: str, columns: list[str] | None = None, start: int = 0, stop: int | None = None) -> DataFrame:
    """Parquet with ``_file`` and ``_row``, columns pruned, rows of [start, stop) of each file."""
    df = spark.read.parquet(path)
    df = df.select(*(columns or df.columns), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    df = df.where(F.col("_row") >= start) if start else df
    return df if stop is None else df.where(F.col("_row") < stop)


@reader("jsonl")
def jsonl(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines, plain or gzip; blank lines are skipped."""
    r = spark.read.schema(schema) if schema else spark.read
    return r.option("mode", "PERMISSIVE").json(path)


@reader("jsonl_zstd")
def jsonl_zstd(spark: SparkSession, path: str, schema: T.StructType, component: tuple[str, str] | None = None) -> DataFrame:
    """Zstandard JSON lines: whole files are decompressed in streams on the executors, then parsed by Spark.

    ``component``: a dotted field and the value that rows need.
    """

    def lines(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        import zstandard

        for b in parts:
            for blob, name in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                stream = zstandard.ZstdDecompressor().stream_reader(pa.BufferReader(blob.as_buffer()), read_across_frames=True)
                rows, at = [], []
                for i, line in enumerate(io.TextIOWrapper(stream, encoding="utf-8", errors="replace")):
                    if line.strip():
                        rows.append(line.rstrip("\n"))
                        at.append(i)
                    if len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), pa.array(at, pa.int64()), pa.array(rows)], ["_file", "_row", "_line"])
                        rows, at = [], []
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array(at, pa.int64()), pa.array(rows, pa.string())], ["_file", "_row", "_line"])

    lines.__annotations__ = {}
    raw = spark.read.format("binaryFile").load(path).select("content", "path").mapInArrow(lines, "_file string, _row long, _line string")
    df = raw.select("_file", "_row", F.from_json("_line", schema).alias("j")).select("_file", "_row", "j.*")
    return df.where(F.col(component[0]) == component[1]) if component else df


@reader("manifest")
def manifest(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON-line files that a listing names, one a line; ``#`` starts a remark."""
    rows = spark.read.text(path).select(F.trim("value").alias("v")).where("v != '' and v not like '#%'").distinct().orderBy("v").toLocalIterator()
    return jsonl(spark, [r.v for r in rows], schema)


@reader("bucket")
def bucket(spark: SparkSession, path: str, dataset: str = "bucket", lines: int = 250, repos: int = 32) -> DataFrame:
    """Content shards: notebooks give their code cells, other files their first ``lines`` lines, at most ``repos`` repository ids."""
    from ..functions.comments import notebook_code
    from ..functions.text import first_lines

    df = spark.read.parquet(path)
    looks = F.col("content").rlike('^\\s*\\{') & F.col("content").contains('"cells"')
    book = notebook_code(F.when(looks, F.col("content")))
    return df.withColumn("_nb", book).select(
        F.lit(dataset).alias("dataset"), F.col("content_id").alias("record_id"), F.when(looks, F.col("_nb.content")).otherwise(first_lines(F.col("content"), lines)).alias("content"), F.when(looks, F.col("_nb.language")).alias("language"),
        F.slice("repo_ids", 1, repos).alias("repo_ids"),
    )


@reader("blobs")
def hydrate(rows: DataFrame, fetch: Callable[[str, str | None], bytes | None], id: str = "blob_id", encoding: str = "src_encoding") -> DataFrame:
    """``rows`` with content and status: ``fetch`` gives a blob's bytes (gzip or plain), None when it is missing.

    One client a partition; a missing blob is an empty text, not an error.
    """

    def run(parts):
        import gzip

        for b in parts:
            text, status = [], []
            for k, enc in zip(b.column(id).to_pylist(), b.column(encoding).to_pylist(), strict=True):
                raw = fetch(k, enc)
                if raw is None:
                    text.append("")
                    status.append("missing")
                    continue
                raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
                try:
                    text.append(raw.decode(enc or "utf-8", "replace"))
                except LookupError:
                    text.append(raw.decode("utf-8", "replace"))
                status.append("ok")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string()), pa.array(status, pa.string())], [*b.schema.names, "content", "content_status"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("content", T.StringType()), T.StructField("content_status", T.StringType())]))


def tree(spark: SparkSession, root: str, datasets: list[str] | None = None, languages: list[str] | None = None) -> DataFrame:
    """A ``dataset/language/part-*`` tree with ``_dataset`` and ``_language`` from the paths; only the named folders are listed."""
    pick = lambda xs: "{" + ",".join(xs) + "}" if xs else "[!.]*"
    df = spark.read.option("basePath", root).parquet(f"{root}/{pick(datasets)}/{pick(languages)}")
    parts = F.split(F.col("_metadata.file_path"), "/")
    return df.select("*", F.element_at(parts, -3).alias("_dataset"), F.element_at(parts, -2).alias("_language"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def partition_plan(listing: DataFrame, done: DataFrame, start: str | None = None, stop: str | None = None, count: int = 1, index: int = 0, limit: int | None = None) -> DataFrame:
    """Paths to fetch: inside inclusive bounds, every ``count``-th of the sorted listing, not yet done, the first ``limit``."""
    from pyspark.sql import Window

    df = listing.select("path")
    df = df.where(F.col("path") >= start) if start else df
    df = df.where(F.col("path") <= stop) if stop else df
    df = df.withColumn("file_index", F.row_number().over(Window.orderBy("path")) - 1)  # one row a file
    df = df.where(F.pmod("file_index", F.lit(count)) == index).join(done.select("path"), "path", "left_anti")
    return df.orderBy("path").limit(limit) if limit is not None else df


