"""Source records to canonical comments, materialized once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.comments import opening_comments
from ..functions.text import trimmed
from ..operators.relational import first_by


def comments(records: DataFrame) -> DataFrame:
    """One canonical row a comment; a record's id gets a suffix only where it has several."""
    found = records.withColumn("_c", opening_comments(F.col("content"), F.col("language"), F.col("path")))
    rows = found.select("*", F.size("_c").alias("_n"), F.explode("_c").alias("_one"))
    text = trimmed(F.col("_one.text"))
    rid = F.when(F.col("_n") > 1, F.concat("record_id", F.lit("::comment::"), F.col("_one.index").cast("string"))).otherwise(F.col("record_id"))
    return rows.select("dataset", rid.alias("record_id"), text.alias("opening_comment"), "language", "path", "repo", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("extracted_at"), "metadata").where("opening_comment is not null")


def run_stats(records: DataFrame, out: DataFrame) -> DataFrame:
    return records.agg(F.count("*").alias("seen"), F.count_if(F.col("content").isNull()).alias("empty")).crossJoin(F.broadcast(out.agg(F.count("*").alias("written"))))  # one row each


def materialize(df: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """First row of each (dataset, record_id), over all rows or within ``scope``; order by file and row where there are, else by content."""
    order = [F.col("_file"), F.col("_row")] if "_file" in df.columns else [F.sha2("opening_comment", 256), F.xxhash64("*")]
    return first_by(df, [*scope, "dataset", "record_id"], *order)
