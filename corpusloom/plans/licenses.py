"""License scores by exact-text memo, and their checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules


def detect(text: Column, score: float = 95.0, coverage: float = 95.0, limit: int | None = None) -> dict[str, Column]:
    """The built-in rule detector over whole texts: raw best score, notice, expressions and matches that qualify.

    A detector that only takes ``limit`` characters gets that prefix, and ``truncated`` says so.
    """
    found = rules.matches(text if limit is None else F.left(text, F.lit(limit)))
    good = rules.qualified(found, score, coverage)
    return {
        "best_license_score": rules.best_score(found), "contains_license_notice": F.size(good) > 0, "detected_license_expression": F.nullif(F.array_join(F.array_sort(F.array_distinct(F.transform(good, lambda m: m["expression"]))), " AND "), F.lit("")),
        "n_matches": F.size(good), "truncated": F.coalesce(F.length(text) > limit, F.lit(False)) if limit is not None else F.lit(False),
    }


def scan(df: DataFrame, text: str = "opening_comment", cache: DataFrame | None = None, detector: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``df`` with a detection JSON and a score.  Each distinct text is detected once.

    The built-in rules are cheap expressions and run in place.  An external
    ``detector`` (key, text to key, comment_license_detection,
    comment_license_score) gets distinct texts that ``cache`` lacks.
    """
    if detector is None:
        d = detect(F.col(text))
        return df.withColumns({"comment_license_detection": F.to_json(F.struct(*[c.alias(k) for k, c in d.items()])), "comment_license_score": d["best_license_score"]})
    keyed = df.withColumn("_key", F.sha2(F.coalesce(text, F.lit("")), 256))
    distinct = keyed.groupBy("_key").agg(F.first(text).alias("text")).withColumnRenamed("_key", "key")
    known = cache.select("key", "comment_license_detection", "comment_license_score") if cache is not None else None
    todo = distinct.join(known, "key", "left_anti") if known is not None else distinct
    got = detector(todo)
    results = got if known is None else got.unionByName(known)
    return keyed.join(results.withColumnRenamed("key", "_k"), F.col("_key") == F.col("_k"), "left").drop("_key", "_k")


def prewarm(df: DataFrame, text: str, cache: DataFrame, detector: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Cache rows for the texts that ``cache`` lacks."""
    keyed = df.groupBy(F.sha2(F.coalesce(text, F.lit("")), 256).alias("key")).agg(F.first(text).alias("text"))
    return detector(keyed.join(cache, "key", "left_anti"))


def eligibility(df: DataFrame, by: list[str], threshold: float) -> DataFrame:
    s = F.col("comment_license_score")
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(s < threshold).alias("eligible"), F.count_if(s.isNull()).alias("nulls"), F.min(s).alias("lowest"), F.max(s).alias("highest"))


def verification(df: DataFrame) -> DataFrame:
    """One row of aggregates that should be zero, plus counts."""
    s = F.col("comment_license_score")
    best = F.try_variant_get(F.try_parse_json("comment_license_detection"), "$.best_license_score", "double")
    return df.agg(F.count("*").alias("rows"), F.count_if(s.isNull()).alias("nulls"), F.count_if(~s.between(0, 100)).alias("out_of_range"), F.count_if(F.abs(s - best) > 1e-9).alias("differing"), F.count_if(s > 0).alias("positive"))


def judge_text(text: Column, excerpt: Column, budget: int) -> Column:
    """At most ``budget`` characters for a judge: all of a short text, else its first half of the budget, a quarter around the excerpt and a last quarter."""
    half, quarter = budget // 2, budget // 4
    at = F.greatest(F.position(excerpt, text), F.lit(1))
    around = F.substring(text, F.greatest(at - quarter // 2, F.lit(1)), F.lit(quarter))
    return F.when(F.length(text) <= budget, text).otherwise(F.concat_ws("\n...\n", F.left(text, F.lit(half)), around, F.right(text, F.lit(quarter))))


MATCH = "license_expression string, score double, match_coverage double"
SHAPES = f"licenses array<struct<key string, spdx_license_key string, score double>>, license_detections array<struct<license_expression string, matches array<struct<{MATCH}>>>>"


def normalized_matches(detection: Column) -> Column:
    """One array of (expression, score, coverage) from either shape of a detection JSON.

    The older one has ``licenses`` with keys, the newer one ``license_detections``
    with matches, which inherit the expression of their detection.
    """
    d = F.from_json(detection, SHAPES)
    row = lambda e, s, c: F.struct(e.alias("expression"), s.alias("score"), c.alias("coverage"))
    old = F.transform(d["licenses"], lambda x: row(F.coalesce(x["spdx_license_key"], x["key"]), x["score"], F.lit(100.0)))
    new = F.flatten(F.transform(d["license_detections"], lambda x: F.transform(x["matches"], lambda m: row(F.coalesce(m["license_expression"], x["license_expression"]), m["score"], F.coalesce(m["match_coverage"], F.lit(100.0))))))
    none = F.array().cast("array<struct<expression:string,score:double,coverage:double>>")
    return F.concat(F.coalesce(old, none), F.coalesce(new, none))


def recount(outputs: DataFrame, by: list[str]) -> DataFrame:
    """Rows and notices of finished outputs."""
    return outputs.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(F.col("contains_license_notice")).alias("notices"))


def scan_identity(engine: str, **settings) -> str:
    """A digest of everything that decides a scan's result; another one invalidates its outputs."""
    import hashlib
    import json

    return hashlib.sha256(json.dumps({"engine": engine, **settings}, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
