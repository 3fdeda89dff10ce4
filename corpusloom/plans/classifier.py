"""Classifier data: routing, pools, diversity, consensus, conflicts and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.templates import template_of
from ..functions.text import joined_id, ngrams, stable_fraction, text_hash, tokens
from ..operators.allocate import bounded_pool, hash_split
from ..operators.graph import components, conflicts, similar_pairs


def candidates(df: DataFrame, text: str = "opening_comment", lo: int = 12, hi: int = 12_000) -> DataFrame:
    """Texts in the length window with class, priority, hashes and example id."""
    rows = df.where(F.length(text).between(lo, hi)).withColumn("candidate_class", rules.route(F.col(text))).where("candidate_class is not null")
    rows = rows.withColumns({"comment_hash": text_hash(F.col(text)), "template": template_of(F.col(text))})
    rows = rows.withColumn("example_id", joined_id(F.col("dataset"), F.col("record_id"), F.col("comment_hash"), size=24)).withColumn("template_hash", F.sha2("template", 256))
    weight = F.when(F.col("candidate_class") == "sharing", rules.sharing(F.col(text))["score"]).when(F.col("candidate_class") == "missed_license", rules.license_base(rules.license_cues(F.col(text))["score"])).otherwise(1.0)
    return rows.withColumn("priority", weight + stable_fraction(F.col("candidate_class"), F.col("example_id")))


def pools(rows: DataFrame, k: int) -> DataFrame:
    return bounded_pool(rows, ["dataset", "language", "candidate_class"], ["comment_hash", "template_hash"], k, F.desc("priority"), F.desc("example_id"))


def family_pairs(rows: DataFrame, least: float = 0.82) -> DataFrame:
    """Pairs of examples whose template five-grams are contained at ``least``, or whose three-grams (twelve or more) are at 0.80."""
    a = rows.select("example_id", ngrams(tokens(F.col("template")), 5).alias("s"))
    b = rows.select("example_id", ngrams(tokens(F.col("template")), 3).alias("s"))
    return similar_pairs(a, "example_id", "s", least).select("a", "b").unionByName(similar_pairs(b, "example_id", "s", 0.80, 12).select("a", "b")).distinct()


def quarantine(accepted: DataFrame, pairs: DataFrame, label: str = "label") -> DataFrame:
    return conflicts(accepted, pairs, "example_id", label)


def split_groups(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """example_id, group: components over near-duplicates and equal repositories."""
    ids = rows.select("example_id", "repo")
    by_repo = ids.where("repo is not null").groupBy("repo").agg(F.min("example_id").alias("b"))
    edges = ids.join(by_repo, "repo").select(F.col("example_id").alias("a"), "b").unionByName(pairs.select("a", "b"))
    comp = components(edges)
    return ids.join(comp, ids.example_id == comp.node, "left").select("example_id", F.coalesce("component", "example_id").alias("group"))


def simple_split(rows: DataFrame, seed: str = "42") -> DataFrame:
    group = F.coalesce(F.lower(F.trim("repo")), F.col("comment_hash"))
    return rows.withColumn("split", hash_split(stable_fraction(F.lit(seed), group)))


SAFE = ["example_id", "opening_comment", "label", "language", "split", "dataset"]


def training_view(rows: DataFrame) -> DataFrame:
    return rows.select(*SAFE)
