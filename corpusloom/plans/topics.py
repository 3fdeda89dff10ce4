"""Low-score selection and a seed-guided topic fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import keyword_pattern
from ..functions.text import topic_score


def select_low(df: DataFrame, text: str, score: str, threshold: float = 0.95, keywords: list[str] | None = None) -> DataFrame:
    """``df`` with ``reason``: why a row is dropped, in the order of the tests, or ``selected``."""
    limit = threshold * 100 if threshold <= 1 else threshold
    s = topic_score(F.col(score))
    why = F.when(F.col(score).isNull(), "missing_score").when(s.isNull(), "invalid_score").when(s >= limit, "high_score").when(F.coalesce(F.trim(F.col(text)), F.lit("")) == "", "blank")
    if keywords:
        why = why.when(~F.lower(F.col(text)).rlike(keyword_pattern(keywords)), "no_keyword")
    return df.withColumn("reason", why.otherwise("selected"))


def assign(df: DataFrame, text: str, topics: dict[str, list[str]]) -> DataFrame:
    """Topic with the most seed phrases in the text; -1 when none occurs; probability is its share of hits."""
    low = F.lower(F.coalesce(text, F.lit("")))
    hits = F.array(*[F.struct(sum((F.when(low.contains(p), 1).otherwise(0) for p in ps), F.lit(0)).alias("n"), F.lit(-i).alias("o"), F.lit(name).alias("label")) for i, (name, ps) in enumerate(topics.items())])
    best, total = F.array_max(hits), F.aggregate(hits, F.lit(0), lambda a, h: a + h["n"])
    out = df.withColumns({"_best": best, "_total": total})
    none = F.col("_best.n") == 0
    return out.withColumns({"topic_id": F.when(none, -1).otherwise(-F.col("_best.o")), "topic_label": F.when(none, "Outliers").otherwise(F.col("_best.label")), "probability": F.when(none, 0.0).otherwise(F.col("_best.n") / F.col("_total"))}).drop("_best", "_total")


def summary(df: DataFrame, order: str, text: str, n: int = 3, chars: int = 120) -> DataFrame:
    """Count and the first ``n`` examples of each topic."""
    w = Window.partitionBy("topic_label").orderBy(order)
    top = df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).groupBy("topic_label").agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", F.left(text, F.lit(chars)).alias("t")))), lambda x: x["t"]).alias("examples"))
    return df.groupBy("topic_label").agg(F.count("*").alias("n")).join(top, "topic_label")


def samples(df: DataFrame, topic: str, id: str, text: str, topics: int, rows: int, outlier: str, chars: int = 1200) -> DataFrame:
    """For a judge: the first ``rows`` texts, trimmed, of each of the ``topics`` largest topics without the outliers."""
    n = df.where(F.col(topic) != outlier).groupBy(topic).agg(F.count("*").alias("n")).orderBy(F.desc("n"), topic).limit(topics).select(topic)
    few = df.join(n, topic, "left_semi").withColumn("_r", F.row_number().over(Window.partitionBy(topic).orderBy(id))).where(F.col("_r") <= rows)
    return few.select(F.col(topic).alias("topic"), id, F.left(text, F.lit(chars)).alias("sample"))
