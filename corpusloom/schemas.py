"""Fixed schemas and a strict check against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


COMMENT = T.StructType(_strings("dataset", "record_id", "opening_comment", "language", "path", "repo", "extracted_at", "metadata"))
SCORED = T.StructType([*COMMENT.fields, T.StructField("comment_license_detection", T.StringType()), T.StructField("comment_license_score", T.DoubleType())])


def require(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` if names and types equal ``schema`` in order; nullability isn't compared."""
    want, got = [(f.name, f.dataType) for f in schema], [(f.name, f.dataType) for f in df.schema]
    if want != got:
        raise ValueError(f"schema differs: {sorted(set(map(str, want)) ^ set(map(str, got)))}")
    return df
