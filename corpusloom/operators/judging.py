"""Judge batches, validation, memo keys and consensus over votes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fuzzy import ground

REASONS = ("missing_pass", "invalid", "label_disagreement", "signature_disagreement", "low_confidence", "ambiguous_label")


def batches(df: DataFrame, id: str, chars: Column, rows: int, budget: int, groups: int | None = None) -> DataFrame:
    """``df`` with ``batch``: rows dealt by a hash, then closed at ``rows`` rows or ``budget`` characters, in id order.

    The greedy rule needs order, so each hash group runs as one stream; groups
    are independent and their number follows the input.
    """
    groups = groups or max(32, df.count() // 100_000)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(id)
        out, n, used, batch = [], 0, 0, 0
        for c in pdf["_chars"]:
            if n and (n >= rows or used + c > budget):
                batch, n, used = batch + 1, 0, 0
            n, used = n + 1, used + c
            out.append(batch)
        pdf["batch"] = [f"{g}-{b}" for g, b in zip(pdf["_g"], out, strict=True)]
        return pdf.drop(columns=["_g", "_chars"])

    run.__annotations__ = {}
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", batch string"
    return df.withColumn("_g", F.pmod(F.xxhash64(id), F.lit(groups))).withColumn("_chars", chars.cast("long")).groupBy("_g").applyInPandas(run, schema)


def cache_key(*parts: Column) -> Column:
    """Memo key: prompt version, rubric hash, model, payload."""
    return F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts])), 256)


def judge(df: DataFrame, decide: Callable[[list[dict]], list[dict]], schema: str, attempts: int = 3) -> DataFrame:
    """``decide`` over Arrow batches of rows; a batch that fails is retried row by row, at most ``attempts`` times a row."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows, out = pdf.to_dict("records"), []
            try:
                out = decide(rows)
                if len(out) != len(rows):
                    raise ValueError("incomplete answer")
            except Exception:
                out = []
                for r in rows:
                    for k in range(attempts):
                        try:
                            out += decide([r])
                            break
                        except Exception:
                            if k + 1 == attempts:
                                raise
            yield pd.DataFrame(out)

    run.__annotations__ = {}
    return df.mapInPandas(run, schema)


def grounded(evidence: str, text: str) -> Column:
    """Whether the quoted evidence stands in the text."""

    @F.pandas_udf("boolean")
    def run(e: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series([a is None or b is not None and ground(a, b) is not None for a, b in zip(e, t, strict=True)])

    return run(evidence, text)


def invalid_reason(label: Column, confidence: Column, labels: list[str]) -> Column:
    return F.when(~label.isin(labels) | label.isNull(), "label").when(confidence.isNull() | ~confidence.between(0.0, 1.0), "confidence")


def consensus(votes: DataFrame, id: str, passes: int = 2, least: float = 0.8) -> DataFrame:
    """One row an id from votes (label, signature, confidence, valid): accepted, or the first of six reasons."""
    g = votes.groupBy(id).agg(F.count("*").alias("n_votes"), F.bool_and("valid").alias("ok"), F.count_distinct("label").alias("labels"), F.count_distinct("signature").alias("signatures"), F.min("confidence").alias("confidence"), F.min("label").alias("label"))
    why = (
        F.when(F.col("n_votes") < passes, REASONS[0]).when(~F.col("ok"), REASONS[1]).when(F.col("labels") != 1, REASONS[2]).when(F.col("signatures") != 1, REASONS[3])
        .when(F.col("confidence") < least, REASONS[4]).when(F.col("label") == "ambiguous", REASONS[5])
    )
    return g.select(id, "n_votes", "label", "confidence", why.alias("rejection_reason"), why.isNull().alias("accepted"))


def latest_valid(cache: DataFrame, keys: list[str]) -> DataFrame:
    """The newest decision of each key."""
    return cache.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in cache.columns if c not in keys]), F.struct("created_at", *[c for c in cache.columns if c not in keys])).alias("_d")).select(*keys, "_d.*")
