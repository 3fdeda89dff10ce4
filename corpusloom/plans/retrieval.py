"""Seed retrieval: anchors, fuzzy matches, occurrences and candidates."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fuzzy import PhraseSearch
from ..functions.text import joined_id, text_hash, tokens

FAMILIES = {
    "license": ["licensed under the apache license", "released under the mit license", "gnu general public license", "licensed under cc by-nc", "see the license file"],
    "confidential": ["strictly confidential and proprietary", "this file contains trade secrets", "for internal use only", "confidential and proprietary"],
    "permission": ["may not be redistributed", "without prior written permission", "do not share this source code", "redistribution is not permitted"],
    "export": ["subject to export control regulations", "export of this software is restricted"],
    "funding": ["funded by a government grant", "developed under contract number"],
    "unpublished": ["unpublished copyrighted work", "this is an unpublished work", "confidential and proprietary"],
}


def seeds(families: list[str] | None = None) -> list[tuple[str, str]]:
    """(group, phrase) of the families in order; a token sequence that an earlier family has is left out."""
    out, seen = [], set()
    for group in families or list(FAMILIES):
        for phrase in FAMILIES[group]:
            key = tuple(phrase.lower().split())
            if key not in seen:
                seen.add(key)
                out.append((group, phrase))
    return out


def anchor_pairs(df: DataFrame, id: str, text: str, inventory: DataFrame) -> DataFrame:
    """(id, seed) candidates that share an anchor token; the seed table (bounded, one row an anchor) is broadcast."""
    words = df.select(id, F.explode(F.array_distinct(tokens(F.col(text)))).alias("token"))
    return words.join(F.broadcast(inventory.select("token", "seed")), "token").select(id, "seed").distinct()


def fuzzy(df: DataFrame, text: str, seed_list: list[tuple[str, str]], threshold: float = 0.82) -> DataFrame:
    """``df`` with ``matches``: one best window a seed; ASCII texts without any anchor aren't sent to Python.

    Other texts are: what compatibility forms fold to is known there only.  The
    search is marked as not deterministic, so that it runs once a row, and no
    rule moves it below a join that ``df`` has made smaller by.
    """
    search = PhraseSearch(seed_list, threshold)
    shared = df.sparkSession.sparkContext.broadcast(seed_list)
    made: dict = {}

    @F.pandas_udf("array<struct<group:string,phrase:string,score:double,excerpt:string,start:int,end:int,ordinal:int>>")
    def run(s: pd.Series) -> pd.Series:
        m = made.setdefault("m", None) or PhraseSearch(shared.value, threshold)
        made["m"] = m
        return s.map(m.find)

    anchors = sorted(search.by_anchor)
    low = F.lower(F.coalesce(text, F.lit("")))
    near = F.octet_length(F.col(text)) > F.char_length(F.col(text))
    for a in anchors:
        near = near | low.contains(a)
    return df.where(near).withColumn("matches", run.asNondeterministic()(F.col(text))).where(F.size("matches") > 0)


def occurrences(matched: DataFrame, dataset: str, record: str, text: str) -> DataFrame:
    """Occurrence identity, the best match and parallel arrays of all matches."""
    h = text_hash(F.col(text))
    part = lambda k: F.transform("matches", lambda m: m[k])
    best = F.get("matches", 0)
    return matched.select(
        "*", joined_id(F.col(dataset), F.col(record).cast("string"), h).alias("occurrence_id"), F.concat(F.lit("candidate-"), F.substring(h, 1, 24)).alias("candidate_id"),
        part("group").alias("match_groups"), part("phrase").alias("match_phrases"), part("score").alias("match_scores"), part("excerpt").alias("match_excerpts"), best["phrase"].alias("best_phrase"), best["score"].alias("best_score"),
    )


def unique_candidates(found: DataFrame, order: str) -> DataFrame:
    """One row a candidate: its first occurrence, their number and their ids in order."""
    return found.groupBy("candidate_id").agg(F.min_by("occurrence_id", order).alias("first_occurrence"), F.count("*").alias("occurrence_count"), F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), F.col("occurrence_id")))), lambda x: x["occurrence_id"]).alias("occurrence_ids"))
