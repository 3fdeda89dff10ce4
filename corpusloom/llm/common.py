"""What several operators share: lineage cuts, Arrow helpers, exact ranks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_SPACE = "\t\n\x0b\x0c\r "


#: Rows and bytes that Spark puts in one Arrow batch for Python at most, where the operators here send texts.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, or a checkpoint folder that was set on its context; without either an error.

    A folder made here would be local to the driver, which executors on other
    machines do not see.
    """
    sc = spark.sparkContext
    given = sc.getConf().get("spark.checkpoint.dir")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not given:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(given)
    return given or sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's checkpoint folder and read from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the cluster's checkpoint folder and read from there.

    A checkpoint computes its last stage twice, once to count and once to write;
    this does so once, and the reader knows the size.
    """
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes the files of ``stored`` tables that no plan will read again; other tables stay."""
    for df in tables:
        path = df.__dict__.pop("stored_at", None)
        if path:
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def spare(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores behind it as it takes to differ from the columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def where_python(df: DataFrame, test, arg: Column) -> DataFrame:
    """The rows of ``df`` for which the Arrow UDF ``test`` holds.

    It is a column of its own that no rule may move: merged with the filters of
    other plans, a Python predicate can end where Spark doesn't evaluate it.
    """
    (flag,) = spare(df, "passes")
    return df.withColumn(flag, test.asNondeterministic()(arg)).where(F.col(flag)).drop(flag)


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's limits for Arrow batches to ``BATCH_ROWS`` and ``BATCH_BYTES`` where they are above.

    At the defaults a batch of long texts takes tens of MB several times over:
    in the JVM, on the way to Python and there.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = (spark.conf.get(key) or "").rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(col: str = "text") -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


def chunks(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows, so that what Python holds stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` lie below ``key``: a binary search as one expression."""
    if not bounds:
        return F.lit(0)
    steps, step = [], 1
    while step <= len(bounds):
        steps.append(step)
        step *= 2
    table = F.array(*[F.lit(int(b)) for b in bounds])

    def probe(at: Column, step: Column) -> Column:
        nxt = at + step
        return F.when((nxt <= len(bounds)) & (F.get(table, nxt - 1) < key), nxt).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in reversed(steps)]), F.lit(0), probe)
