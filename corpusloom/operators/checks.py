"""Filters, joins and assertions that keep tables of one run consistent with each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def member(col: str, allowed: list[str]) -> Column:
    """Whether a name is among ``allowed``; an empty list allows all, null counts as an empty name."""
    return F.coalesce(F.col(col), F.lit("")).isin(allowed) if allowed else F.lit(True)


def is_true(col: str) -> Column:
    """True only: neither false nor null."""
    return F.col(col).eqNullSafe(True)


def mismatches(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Rows whose column differs from the one that it should equal (null equals null)."""
    bad = F.lit(False)
    for a, b in pairs.items():
        bad = bad | ~F.col(a).eqNullSafe(F.col(b))
    return df.where(bad)


def asserted(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """``df``, whose run fails at the first row that ``mismatches`` would give."""
    for a, b in pairs.items():
        says = F.concat(F.lit(f"{a} differs from {b}: "), F.coalesce(F.col(a).cast("string"), F.lit("null")))
        df = df.where(F.when(F.col(a).eqNullSafe(F.col(b)), True).otherwise(F.raise_error(says).cast("boolean")))
    return df


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join in which each row of ``left`` has exactly one partner; the run fails on another number."""
    each = right.groupBy(key).agg(F.count("*").alias("partners"), *[F.first(c).alias(c) for c in right.columns if c != key])
    both = left.join(each, key, "left")
    fine = F.when(F.col("partners") == 1, True).otherwise(F.raise_error(F.concat(F.lit(f"{key} without one partner: "), F.col(key).cast("string"))).cast("boolean"))
    return both.where(fine).drop("partners")


def fresh(ledger: DataFrame, current: DataFrame, key: str, *marks: str) -> DataFrame:
    """Ledger rows whose key still has the same size, time or other marks; the rest is stale."""
    return ledger.join(current.select(key, *marks), [key, *marks], "left_semi")


def checkpoint_state(ledger: DataFrame, current: DataFrame, key: str, identity: str) -> DataFrame:
    """key, state: ``reuse`` where file marks and scan identity agree, ``rescan`` where one differs, ``new`` without a ledger row."""
    old = ledger.select(key, F.struct("size", "mtime", "identity").alias("was"))
    now = current.select(key, F.struct("size", "mtime", F.lit(identity).alias("identity")).alias("is_now"))
    return now.join(old, key, "left").select(key, F.when(F.col("was").isNull(), "new").when(F.col("was").eqNullSafe(F.col("is_now")), "reuse").otherwise("rescan").alias("state"))


def provenance(claimed: DataFrame, source: DataFrame, keys: list[str], cols: list[str], json_cols: list[str] = ()) -> DataFrame:
    """keys, problem: claimed rows that their place in the source doesn't confirm; JSON columns are compared parsed."""
    same = lambda c: F.try_parse_json(F.col(c)).cast("string") if c in json_cols else F.col(c)
    a = claimed.select(*keys, F.struct(*[same(c).alias(c) for c in cols]).alias("said"))
    b = source.select(*keys, F.struct(*[same(c).alias(c) for c in cols]).alias("found"))
    wrong = F.array_compact(F.array(*[F.when(~F.col(f"said.{c}").eqNullSafe(F.col(f"found.{c}")), F.lit(c)) for c in cols]))
    both = a.join(b, keys, "left").select(*keys, F.when(F.col("found").isNull(), "missing").otherwise(F.nullif(F.array_join(wrong, ","), F.lit(""))).alias("problem"))
    return both.where("problem is not null")


def overlap(a: DataFrame, b: DataFrame, key: str) -> bool:
    """Whether two tables share a key; stops at the first."""
    return not a.select(key).join(b.select(key), key, "left_semi").isEmpty()


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows with how often one side has them more than the other; empty if the multisets are equal."""
    cols = a.columns
    every = a.withColumn("_w", F.lit(1)).unionByName(b.select(*cols).withColumn("_w", F.lit(-1)))
    return every.groupBy(*cols).agg(F.sum("_w").alias("surplus")).where("surplus != 0")


def linked_by(df: DataFrame, id: str, values: Column) -> DataFrame:
    """id, first, value: a star of each value's rows around its smallest id, never all of their pairs."""
    each = df.select(F.col(id), F.explode(F.array_distinct(values)).alias("value"))
    first = each.groupBy("value").agg(F.min(id).alias("first")).select(F.concat("value", F.lit("")).alias("k"), "first")
    return each.join(first, F.col("value") == F.col("k")).where(F.col(id) != F.col("first")).select(id, "first", "value")


def votes_hold(votes: Column, schema: str, least: float) -> Column:
    """Whether stored votes (a JSON array) parse, agree and are all confident."""
    v = F.from_json(votes, f"array<{schema}>")
    return F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: (x["label"] == F.get(v, 0)["label"]) & (x["confidence"] >= least)), F.lit(False))
