"""The queries of this subpackage, with SQL where SQL can express them.

A column named like its contract derives from the operators' own results; the
operators themselves are in the modules beside this one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, html_text, line_dedup, lm_scoring, packing, quality, sharding, simhash, sketch, token_edits
from .common import read

PIECES = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def crc_of_id(col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def op1_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lattice score and base score of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text").withColumn("train", F.pmod(crc_of_id(), F.lit(7)) != 2)
    out = lm_scoring.score(docs, lm_scoring.read_pieces(PIECES), "train")
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by the quadratic discriminant."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.score_documents(docs, read(spark, sf_dir, "labels").select("doc_id", "quality"))
    return out.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near-equal bytes, ranged by doc_id."""
    docs = read(spark, sf_dir, "documents").select("doc_id", sharding.unit_size().alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    out = sharding.shard(docs, F.col("doc_id"), F.col("size"), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = simhash.groups(simhash.fingerprints(docs))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Optimal length buckets and token-budget batches of all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", packing.n_words().alias("n"))
    return packing.pack(docs, F.col("n")).select("doc_id", "n_tokens", "bucket", "padded_to", "batch", "place", "padding", "over_budget")


def op6_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines removed as later occurrences, and what is left, for every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs).select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op7_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k fingerprints of every document and of its edited text."""
    return sketch.edited(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows that occur in every document."""
    found = decontam.find(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("items") >= 2).alias("contaminated"))


def op9_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, before and after a deletion, an insertion and a replacement."""
    n = F.length(F.coalesce("text", F.lit(""))).cast("int")
    edit = lambda at, size, new: F.struct(at.cast("int").alias("start"), F.lit(size).alias("length"), new.alias("text"))
    edits = F.array(edit(F.floor(n / 3), 7, F.lit("")), edit(F.floor(n / 2), 0, F.concat(F.lit(" added "), F.coalesce("lang", F.lit("")))), edit(F.greatest(n - 20, F.lit(0)), 5, F.lit("'ll 42%")))
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", edits.alias("edits"))
    return token_edits.count_edits(docs, RANKS)


def op10_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page, laid out."""
    return html_text.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_subword_lattice, op2_quality, op3_splitters, op4_simhash, op5_length_buckets, op6_line_windows, op7_bottom_k, op8_benchmark_hits, op9_edit_counts, op10_layout_text, pipeline]
    return {f.__name__: f for f in own}


WORDS8 = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP8_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS8} AS w FROM documents),
b AS (SELECT item_id, {WORDS8} AS w FROM benchmark WHERE item_id IS NOT NULL),
g AS (SELECT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS gram
      FROM (SELECT item_id, w, least(8, len(w)) AS k, unnest(range(1, greatest(len(w) - 7, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM g),
p AS (SELECT rid, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS gram
      FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
h AS (SELECT DISTINCT p.rid, p.i, p.k, g.item_id FROM p JOIN g ON p.k = g.k AND p.gram = g.gram),
hit AS (SELECT rid, count(*) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + k)) FROM h) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT rid, item_id::varchar AS item_id FROM h) GROUP BY rid)
SELECT d.doc_id, len(d.w)::bigint AS n_words, coalesce(hit.n_hit, 0)::bigint AS n_hit, coalesce(it.n_items, 0)::bigint AS n_items,
  sha256(coalesce(it.items, '')) AS items_sha256, coalesce(it.n_items, 0) >= 2 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)
"""

LINE_SQL = line_dedup.LINE.replace("\\x0B", "\\v")

OP6_SQL = f"""
WITH d AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '{LINE_SQL}') AS l FROM documents),
k AS (SELECT DISTINCT doc_id, text, list_transform(l, lambda x: lower(trim(replace(x, chr(9), ' '), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '))) AS k, len(l) AS n FROM d WHERE text IS NOT NULL),
w AS (SELECT doc_id, text, i - 1 AS pos, n, k, i, coalesce(k[i], '') AS a, coalesce(k[i + 1], '') AS b, coalesce(k[i + 2], '') AS c
      FROM (SELECT *, unnest(range(1, greatest(n - 2, 1) + 1)) AS i FROM k WHERE n > 0)),
y AS (SELECT doc_id, text, pos, n, CASE WHEN length(a) + length(b) + length(c) >= {line_dedup.LEAST} THEN {line_dedup.WINDOW} WHEN i + {line_dedup.LONG - 1} <= n THEN {line_dedup.LONG} END AS size,
        CASE WHEN length(a) + length(b) + length(c) >= {line_dedup.LEAST} THEN [a, b, c] ELSE list_slice(k, i, i + {line_dedup.LONG - 1}) END AS win FROM w),
x AS (SELECT doc_id, text, pos, n, size, row_number() OVER (PARTITION BY win ORDER BY doc_id NULLS FIRST, text, pos) AS r FROM y WHERE size IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, text, unnest(range(pos, least(pos + size, n))) AS p FROM x WHERE r > 1),
g AS (SELECT doc_id, text, list(p) AS ps FROM gone GROUP BY ALL)
SELECT d.doc_id, len(d.l)::int AS n_lines, coalesce(len(g.ps), 0)::int AS n_removed,
  length(CASE WHEN g.ps IS NULL THEN d.text ELSE array_to_string(list_filter(d.l, lambda y, i: NOT list_contains(g.ps, i - 1)), '') END)::bigint AS kept_chars,
  sha256(CASE WHEN g.ps IS NULL THEN d.text ELSE array_to_string(list_filter(d.l, lambda y, i: NOT list_contains(g.ps, i - 1)), '') END) AS kept_sha256
FROM d LEFT JOIN g ON d.doc_id IS NOT DISTINCT FROM g.doc_id AND d.text = g.text
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_line_windows": OP6_SQL, "op8_benchmark_hits": OP8_SQL}
