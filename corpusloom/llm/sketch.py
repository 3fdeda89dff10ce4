"""Bottom-k document fingerprints, in DataFrame functions only.

The sketch of a text is its ``K`` smallest distinct shingle hashes (five words,
A-Z lower-cased; a shorter text has one shingle, a text without words none).
Sketches of parts merge to the sketch of the whole; two sketches estimate
resemblance and containment, one the number of distinct shingles.

Cases: a null text is empty, with an empty sketch; two empty sketches resemble
each other fully, an empty and another not at all; equal texts have equal
sketches; texts of any length are hashed whole; repeated rows each get a row, and
rows of one doc_id follow each other in the order of a hash of their texts; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_of, lower_ascii

K, WIDTH = 64, 5
ROWS, BOUNDS = 2_000, 16_384


def words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def hashes(text: Column, width: int = WIDTH) -> Column:
    """Distinct shingle hashes: each is a hash over the hashes of its words."""

    def of(h: Column) -> Column:
        n = F.size(h)
        at = F.when(n == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))))
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(width)]))

    return F.array_distinct(F.get(F.transform(F.array(F.transform(words(text), lambda w: F.xxhash64(w))), of), 0))


def sketch(text: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(hashes(text)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_all(sketches: DataFrame, by: list[str], col: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for each group of rows: the smallest distinct hashes of all parts.

    Hashes are made distinct and ranked, so no group is gathered whole.
    """
    each = sketches.select(*by, F.explode(col).alias("_h")).distinct()
    w = Window.partitionBy(*by).orderBy("_h")
    return each.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).groupBy(*by).agg(F.sort_array(F.collect_list("_h")).alias(col))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    u = merge(a, b, k)
    return F.when(F.size(u) == 0, 1.0).otherwise(F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u)).cast("double")


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated distinct shingles: exact below ``k``."""
    share = (F.element_at(a, -1).cast("double") + float(1 << 63)) / float(1 << 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has."""
    j = resemblance(a, b, k)
    na, nb = distinct_count(a, k), distinct_count(b, k)
    return F.when(na == 0, 1.0).otherwise(F.least(F.lit(1.0), j * (na + nb) / (1 + j) / na))


def to_hex(a: Column) -> Column:
    """The sketch as text, 16 digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text: the text of the next document by descending doc_id, after the last the first.

    Ids are cut into ranges at approximate quantiles; the first row of each
    range also goes to the range before it, so each range orders its rows alone
    and texts are shuffled once.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    ids = rows.select(key.alias("k"))
    n = ids.count()
    parts = min(BOUNDS, max(64, n // ROWS)) if n else 1
    cuts = sorted(set(ids.agg(F.percentile_approx("k", [i / parts for i in range(1, parts)], 4 * parts)).first()[0] or [])) if n and parts > 1 else []
    top = {r.b: r.k for r in ids.select(bucket_of(F.col("k"), cuts).alias("b"), "k").groupBy("b").agg(F.max("k").alias("k")).collect()}
    filled = sorted(top)
    before = {top[b]: filled[(i + 1) % len(filled)] for i, b in enumerate(filled)}  # a range's first row also ends the range above it
    k = F.col("_k")
    marks = sorted(before)
    at = bucket_of(k, marks)
    ghost = F.when(F.get(F.array(*[F.lit(m) for m in marks]), at) == k, F.get(F.array(*[F.lit(before[m]) for m in marks]), at)) if marks else F.lit(None).cast("int")
    placed = rows.withColumn("_k", key).withColumn("_b", bucket_of(k, cuts))
    placed = placed.withColumn("_to", F.explode(F.filter(F.array(F.struct(F.col("_b").alias("b"), F.lit(0).alias("g")), F.struct(ghost.cast("int").alias("b"), F.lit(1).alias("g"))), lambda x: x["b"].isNotNull())))
    return placed.select("doc_id", "text", "_k", F.xxhash64("text").alias("_t"), F.col("_to.b").alias("_b"), F.col("_to.g").alias("_g"))


def edited(docs: DataFrame, k: int = K) -> DataFrame:
    """Each document's own, edited and next sketch and its likenesses; see the query for the edit."""
    rows = with_next(docs).repartition("_b").withColumn("sketch", sketch(F.col("text"), k))
    w = Window.partitionBy("_b").orderBy("_g", F.desc("_k"), "_t")
    rows = rows.withColumn("next_text", F.lead("text").over(w)).withColumn("next_sketch", F.lead("sketch").over(w)).where("_g = 0")
    n = F.length("text")
    half = F.expr("n_chars div 2").cast("int")
    rows = rows.withColumn("n_chars", n.cast("long"))
    rows = rows.withColumn("edited", F.concat(F.left("text", (F.col("n_chars") - half).cast("int")), F.left("next_text", half)))
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited"), k))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), to_hex(F.col("sketch")).alias("fingerprint"), to_hex(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"), resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"), distinct_count(F.col("sketch"), k).alias("n_distinct"),
        containment(F.col("sketch"), F.col("edited_sketch"), k).alias("contained_in_edited"),
    )
