"""Queries over the given tables, each with the SQL that gives the same rows.

``documents`` stand for comments: dataset is source, record_id is doc_id,
opening_comment is text, language is lang.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import text as X
from ..functions.comments import html_comments
from ..operators import allocate, graph, judging, relational
from ..session import table
from ..sources.sinks import group_manifest
from ..streaming import events as S
from . import licenses, retrieval, topics

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def docs(spark, d) -> DataFrame:
    return table(spark, d, "documents")


def scored(spark, d) -> DataFrame:
    det = licenses.detect(F.col("text"))
    return docs(spark, d).withColumns({k: v for k, v in det.items()}).withColumn("comment_license_score", F.col("best_license_score"))


LOW = "lower(coalesce(text, ''))"
BEST = "greatest(0.0, " + ", ".join(f"CASE WHEN regexp_matches({LOW}, '{p}') THEN {w} ELSE 0.0 END" for _, _, w, p in rules.LICENSES) + ")::double"
NOTICE = "(" + " OR ".join(f"regexp_matches({LOW}, '{p}')" for _, _, w, p in rules.LICENSES if w >= 95) + ")"
SCORED = f"(SELECT *, {BEST} AS score, {NOTICE} AS notice FROM documents)"
FOLD = "lower(regexp_replace(regexp_replace({}, '\\s+', ' ', 'g'), '^ | $', '', 'g'))"
HASH = f"sha256({FOLD.format('text')})"
FRAC = "('0x' || substr(sha256({}), 1, 16))::ubigint::double / 18446744073709551615.0"


def weighted_sql(rules_) -> str:
    s = " + ".join(f"CASE WHEN regexp_matches(lower(coalesce(text, '')), '{p}') THEN {w} ELSE 0 END" for _, w, p in rules_)
    return f"({s})"


def names_sql(rules_) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN regexp_matches(lower(coalesce(text, '')), '{p}') THEN '{n}' END" for n, _, p in rules_) + ")"


# ---- projections, identity ----
@query("SELECT doc_id, coalesce(nullif(trim(lang), ''), source) AS language, source AS repo, doc_id::varchar AS record_id FROM documents")
def project_fallback_columns(spark, d):
    from ..sources.readers import first_of

    rows = docs(spark, d).withColumn("lang", F.nullif(F.trim("lang"), F.lit("")))
    return rows.select("doc_id", first_of(rows, ["language", "lang", "source"]).alias("language"), first_of(rows, ["repo", "source"]).alias("repo"), first_of(rows, ["record", "doc_id"]).alias("record_id"))


@query("SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, lower(regexp_extract(regexp_replace(url, '[?#].*$', ''), '[^/.][^/]*\\.([^./]+)$', 1)) AS ext FROM pages")
def path_extension(spark, d):
    bare = F.regexp_replace("url", "[?#].*$", "")
    return table(spark, d, "pages").select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), X.extension(bare).alias("ext"))


@query("SELECT doc_id, source || '::row::' || doc_id AS record_id, source AS remote_path, doc_id AS row_index FROM documents")
def record_identity_parse(spark, d):
    rid = F.concat("source", F.lit("::row::"), F.col("doc_id").cast("string"))
    named = docs(spark, d).select("doc_id", rid.alias("record_id"))
    return named.select("doc_id", "record_id", X.record_parts(F.col("record_id")).alias("p")).select("doc_id", "record_id", "p.remote_path", "p.row_index")


@query(f"SELECT doc_id, {HASH} AS comment_hash, substr(sha256(source || chr(0) || doc_id || chr(0) || {HASH}), 1, 24) AS example_id FROM documents")
def comment_normalize_hash(spark, d):
    h = X.text_hash(F.col("text"))
    return docs(spark, d).select("doc_id", h.alias("comment_hash"), X.joined_id(F.col("source"), F.col("doc_id").cast("string"), h, size=24).alias("example_id"))


@query("SELECT doc_id, (192 + b + b // 8)::bigint AS bytes FROM (SELECT doc_id, coalesce(strlen(text), 4) + coalesce(strlen(lang), 4) + coalesce(strlen(source), 4) AS b FROM documents)")
def record_byte_estimate(spark, d):
    return docs(spark, d).select("doc_id", X.byte_estimate(F.col("text"), F.col("lang"), F.col("source")).alias("bytes"))


@query("""SELECT doc_id, CASE WHEN length(text) > 80 THEN rtrim(left(text, 77), ' ') || '...' ELSE text END AS short,
CASE WHEN len(string_split(text, chr(10))) > 3 THEN array_to_string(string_split(text, chr(10))[1:3], chr(10)) || chr(10) ELSE text END AS head FROM documents""")
def truncations(spark, d):
    return docs(spark, d).select("doc_id", X.ellipsis(F.col("text"), 80).alias("short"), X.first_lines(F.col("text"), 3).alias("head"))


@query("SELECT lang, replace(replace(lang, '#', '_sharp'), '++', '_plus_plus') AS split_name, lower(source) AS slug, count(*)::bigint AS n FROM documents GROUP BY ALL")
def group_names(spark, d):
    return docs(spark, d).groupBy("lang", X.split_name(F.col("lang")).alias("split_name"), X.slug(F.col("source")).alias("slug")).agg(F.count("*").alias("n"))


# ---- dedupe, set operations, planning ----
@query(f"SELECT doc_id, comment_hash FROM (SELECT doc_id, {HASH} AS comment_hash, row_number() OVER (PARTITION BY {HASH} ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def dedupe_first_global(spark, d):
    rows = docs(spark, d).select("doc_id", X.text_hash(F.col("text")).alias("comment_hash"))
    return rows.groupBy("comment_hash").agg(F.min("doc_id").alias("doc_id"))


@query(f"SELECT doc_id, source, comment_hash FROM (SELECT doc_id, source, {HASH} AS comment_hash, row_number() OVER (PARTITION BY source, {HASH} ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def dedupe_first_in_group(spark, d):
    rows = docs(spark, d).select("doc_id", "source", X.text_hash(F.col("text")).alias("comment_hash"))
    return relational.first_by(rows, ["source", "comment_hash"], F.col("doc_id"))


@query("SELECT source AS dataset, lang AS language, count(*)::bigint AS rows FROM documents GROUP BY ALL")
def group_manifest_rows(spark, d):
    return group_manifest(docs(spark, d).select(F.col("source").alias("dataset"), F.col("lang").alias("language")), ["dataset", "language"]).drop("shards")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_antijoin(spark, d):
    return relational.pending(docs(spark, d).select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def completed_semijoin(spark, d):
    return relational.completed(docs(spark, d).select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("SELECT path, file_index FROM (SELECT source AS path, (row_number() OVER (ORDER BY source) - 1)::int AS file_index FROM (SELECT DISTINCT source FROM documents)) WHERE file_index % 4 = 1")
def file_partition_modulo(spark, d):
    from ..sources.readers import partition_plan

    listing = docs(spark, d).select(F.col("source").alias("path")).distinct()
    return partition_plan(listing, listing.where(F.lit(False)), count=4, index=1)


@query("SELECT DISTINCT regexp_extract(url, '/([a-z]{2})/', 1) AS language FROM pages WHERE regexp_matches(url, '/[a-z]{2}/')")
def language_discovery(spark, d):
    return table(spark, d, "pages").where(F.col("url").rlike("/[a-z]{2}/")).select(F.regexp_extract("url", "/([a-z]{2})/", 1).alias("language")).distinct()


@query("SELECT 'missing_right' AS problem, count(*)::bigint AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) HAVING count(*) > 0")
def artifact_reconcile(spark, d):
    one = lambda t: table(spark, d, t).select("doc_id", F.lit(1).alias("present"))
    return relational.reconcile(one("documents"), one("labels"), "doc_id").groupBy("problem").agg(F.count("*").alias("n"))


@query("SELECT id, class FROM (SELECT doc_id AS id, 'labelled' AS class FROM labels UNION ALL SELECT doc_id, 'unlabelled' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))")
def accepted_partition_law(spark, d):
    every, lab = docs(spark, d).select("doc_id"), table(spark, d, "labels").select("doc_id")
    return lab.select(F.col("doc_id").alias("id"), F.lit("labelled").alias("class")).unionByName(every.exceptAll(lab).select(F.col("doc_id").alias("id"), F.lit("unlabelled").alias("class")))


# ---- licence scores ----
@query(f"SELECT doc_id, score AS comment_license_score, notice AS contains_license_notice FROM {SCORED}")
def license_detect_scores(spark, d):
    return scored(spark, d).select("doc_id", "comment_license_score", "contains_license_notice")


@query(f"SELECT doc_id, score AS comment_license_score FROM {SCORED}")
def license_memo_join(spark, d):
    def detector(texts):
        det = licenses.detect(F.col("text"))
        return texts.select("key", F.lit("{}").alias("comment_license_detection"), det["best_license_score"].alias("comment_license_score"))

    return licenses.scan(docs(spark, d).select("doc_id", "text"), "text", detector=detector).select("doc_id", "comment_license_score")


QUAL = ["apache-2.0", "mit", "gpl-3.0", "cc-by-nc-4.0", "spdx"]


@query("SELECT expression, count(*)::bigint AS n FROM (" + " UNION ALL ".join(f"SELECT '{e}' AS expression FROM documents WHERE regexp_matches({LOW}, '{p}')" for _, e, w, p in rules.LICENSES if w >= 95) + ") GROUP BY 1")
def license_qualified_matches(spark, d):
    good = rules.qualified(rules.matches(F.col("text")))
    return docs(spark, d).select(F.explode(good).alias("m")).groupBy(F.col("m.expression").alias("expression")).agg(F.count("*").alias("n"))


@query(f"""SELECT l.lang, b.bin::int AS bin, (b.bin * 5.0)::double AS bin_lo, coalesce(h.n, 0)::bigint AS n FROM (SELECT DISTINCT lang FROM documents) l CROSS JOIN range(20) b(bin)
LEFT JOIN (SELECT lang, least(floor(score / 5.0), 19)::int AS bin, count(*) AS n FROM {SCORED} GROUP BY ALL) h ON h.lang IS NOT DISTINCT FROM l.lang AND h.bin = b.bin""")
def license_histogram(spark, d):
    return relational.histogram(scored(spark, d).select("lang", "comment_license_score"), "comment_license_score", 20, 0.0, 100.0, ["lang"])


@query(f"SELECT count(*)::bigint AS records, count(score)::bigint AS scores, 0::bigint AS missing, 0::bigint AS invalid, 0::bigint AS outside, min(score) AS lowest, max(score) AS highest, round(avg(score), 6) AS mean FROM {SCORED}")
def license_histogram_stats(spark, d):
    return relational.histogram_stats(scored(spark, d), "comment_license_score", 0.0, 100.0)


@query(f"SELECT count(*)::bigint AS rows, 0::bigint AS nulls, 0::bigint AS out_of_range, 0::bigint AS differing, count_if(score > 0)::bigint AS positive FROM {SCORED}")
def score_verification(spark, d):
    return licenses.verification(licenses.scan(docs(spark, d), "text"))


@query(f"SELECT lang, count(*)::bigint AS rows, count_if(score < 90)::bigint AS eligible, 0::bigint AS nulls, min(score) AS lowest, max(score) AS highest FROM {SCORED} GROUP BY lang")
def eligibility_counts(spark, d):
    return licenses.eligibility(scored(spark, d), ["lang"], 90.0)


# ---- filters, routing, topics ----
KEYS = ["license", "public license", "version", "mit", "gnu general"]
PATTERN = rules.keyword_pattern(KEYS)


@query(f"""SELECT reason, count(*)::bigint AS n FROM (SELECT CASE WHEN score >= 95 THEN 'high_score' WHEN trim(coalesce(text, ''), ' ') = '' THEN 'blank' ELSE 'selected' END AS reason
FROM (SELECT text, CASE WHEN score <= 1 THEN score * 100 ELSE score END AS score FROM {SCORED})) GROUP BY 1""")
def low_score_select_counts(spark, d):
    return topics.select_low(scored(spark, d), "text", "comment_license_score").groupBy("reason").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id FROM documents WHERE regexp_matches(lower(text), '{PATTERN}')")
def keyword_prefilter(spark, d):
    return docs(spark, d).where(F.lower("text").rlike(PATTERN)).select("doc_id")


@query(f"SELECT doc_id, {weighted_sql(rules.SHARING)}::int AS score, {names_sql(rules.SHARING)} AS names FROM documents WHERE {weighted_sql(rules.SHARING)} > 0")
def weighted_sharing_features(spark, d):
    return docs(spark, d).withColumn("f", rules.sharing(F.col("text"))).where("f is not null").select("doc_id", F.col("f.score").alias("score"), F.array_join("f.names", ",").alias("names"))


@query(f"SELECT doc_id, {weighted_sql(rules.LICENSE_CUES)}::int AS score, {names_sql(rules.LICENSE_CUES)} AS names, least({weighted_sql(rules.LICENSE_CUES)} / 25.0, 4.0)::double AS base FROM documents WHERE {weighted_sql(rules.LICENSE_CUES)} > 0")
def weighted_license_features(spark, d):
    return docs(spark, d).withColumn("f", rules.license_cues(F.col("text"))).where("f is not null").select("doc_id", F.col("f.score").alias("score"), F.array_join("f.names", ",").alias("names"), rules.license_base(F.col("f.score")).alias("base"))


_LT = "lower(coalesce(text, ''))"
_HARD = f"({weighted_sql(rules.BOUNDARY)} > 0 AND (contains({_LT}, 'share') OR contains({_LT}, 'license') OR contains({_LT}, 'permission')) AND NOT regexp_matches({_LT}, '{rules.AFFIRMATIVE}'))"
ROUTE = f"""CASE WHEN {_HARD} AND {weighted_sql(rules.LICENSE_CUES)} > 0 THEN 'missed_license' WHEN {_HARD} THEN 'irrelevant' WHEN {weighted_sql(rules.SHARING)} > 0 THEN 'sharing'
WHEN {weighted_sql(rules.LICENSE_CUES)} > 0 THEN 'missed_license' WHEN NOT contains({_LT}, 'license') AND length(regexp_replace(coalesce(text, ''), '[^\\p{{L}}]', '', 'g')) >= 10 THEN 'irrelevant_random' END"""


@query(f"SELECT doc_id, {ROUTE} AS candidate_class FROM documents")
def candidate_routing(spark, d):
    return docs(spark, d).select("doc_id", rules.route(F.col("text")).alias("candidate_class"))


TOPICS = {"licences": ["licensed under", "public license", "mit license"], "contact": ["@mail", "+1 ("], "keys": ["api_key", "secret", "token="]}


def _hits(ps):
    return " + ".join(f"CASE WHEN contains({_LT}, '{p}') THEN 1 ELSE 0 END" for p in ps)


_TOPIC = f"""(SELECT doc_id, text, {', '.join(f'({_hits(p)}) AS h{i}' for i, p in enumerate(TOPICS.values()))} FROM documents)"""


@query(f"""WITH a AS (SELECT doc_id, text, CASE WHEN h0 + h1 + h2 = 0 THEN 'Outliers' WHEN h0 >= h1 AND h0 >= h2 THEN 'licences' WHEN h1 >= h2 THEN 'contact' ELSE 'keys' END AS topic_label FROM {_TOPIC}),
r AS (SELECT *, row_number() OVER (PARTITION BY topic_label ORDER BY doc_id) AS r FROM a)
SELECT topic_label, count(*)::bigint AS n, string_agg(left(text, 120), '|' ORDER BY doc_id) FILTER (WHERE r <= 3) AS examples FROM r GROUP BY 1""")
def topic_examples_topn(spark, d):
    out = topics.summary(topics.assign(docs(spark, d), "text", TOPICS), "doc_id", "text")
    return out.select("topic_label", "n", F.array_join("examples", "|").alias("examples"))


# ---- ranks, samples, quotas ----
ELIG = f"(SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS ordinal FROM {SCORED} WHERE score < 90)"


def eligible(spark, d):
    return relational.ranged_ordinals(scored(spark, d).where("comment_license_score < 90").select("doc_id", "lang"), "lang", "doc_id")


@query(f"SELECT doc_id, lang, ordinal::int AS ordinal FROM {ELIG}")
def eligible_rank(spark, d):
    return eligible(spark, d)


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS ordinal FROM documents")
def selected_ordinals(spark, d):
    return relational.global_ordinals(docs(spark, d).select("doc_id"), "doc_id")


def _fill(src: str, name: str, total: str) -> str:
    return f"""c AS ({src}), t AS (SELECT least({total}, sum(capacity))::bigint AS t, count(*) AS n FROM c),
r AS (SELECT *, row_number() OVER (ORDER BY capacity, {name}) AS i, coalesce(sum(capacity) OVER (ORDER BY capacity, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c),
f AS (SELECT r.*, capacity * (n - i + 1) <= t - before AS is_full FROM r, t), u AS (SELECT coalesce(sum(capacity) FILTER (is_full), 0) AS used, count(*) FILTER (NOT is_full) AS m FROM f),
q AS (SELECT {name}, capacity::bigint AS capacity, (CASE WHEN is_full THEN capacity ELSE (t - used) // m + CASE WHEN row_number() OVER (PARTITION BY is_full ORDER BY {name}) <= (t - used) % m THEN 1 ELSE 0 END END)::bigint AS quota FROM f, t, u)"""


LANGS = f"SELECT lang, count(*) AS capacity FROM {ELIG} GROUP BY lang"


@query(f"WITH {_fill(LANGS, 'lang', '100')} SELECT lang, capacity, quota FROM q")
def waterfill_languages(spark, d):
    return allocate.water_fill(eligible(spark, d).groupBy("lang").agg(F.count("*").alias("n")), "lang", "n", 100)


@query(f"WITH {_fill('SELECT lang || chr(47) || source AS cell, count(*) AS capacity FROM documents GROUP BY 1', 'cell', '400')} SELECT cell, capacity, quota FROM q")
def waterfill_cells(spark, d):
    cells = docs(spark, d).groupBy(F.concat_ws("/", "lang", "source").alias("cell")).agg(F.count("*").alias("n"))
    return allocate.water_fill(cells, "cell", "n", 400, tolerant=True)


@query(f"""WITH {_fill(LANGS, 'lang', '100')}, p AS (SELECT lang, (2 * i + 1) * capacity // (2 * quota) AS ordinal FROM (SELECT lang, capacity, quota, unnest(range(quota)) AS i FROM q))
SELECT e.doc_id, e.lang, e.ordinal::int AS ordinal FROM {ELIG} e JOIN p USING (lang, ordinal)""")
def systematic_sample(spark, d):
    ranked = eligible(spark, d)
    quotas = allocate.water_fill(ranked.groupBy("lang").agg(F.count("*").alias("n")), "lang", "n", 100)
    return allocate.systematic(ranked, quotas, "lang").select("doc_id", "lang", F.col("ordinal").cast("int").alias("ordinal"))


PRIO = FRAC.format("lang || chr(0) || doc_id")


@query(f"""WITH a AS (SELECT doc_id, lang, source, {HASH} AS h, {PRIO} AS p FROM documents), b AS (SELECT *, row_number() OVER (PARTITION BY lang, source, h ORDER BY p DESC, doc_id DESC) AS r FROM a),
c AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY p DESC, doc_id DESC) AS rank FROM b WHERE r = 1) SELECT doc_id, lang, source, rank::int AS rank FROM c WHERE rank <= 5""")
def topk_pool(spark, d):
    rows = docs(spark, d).select("doc_id", "lang", "source", X.text_hash(F.col("text")).alias("h"), X.stable_fraction(F.col("lang"), F.col("doc_id").cast("string")).alias("p"))
    return allocate.bounded_pool(rows, ["lang", "source"], ["h"], 5, F.desc("p"), F.desc("doc_id")).select("doc_id", "lang", "source", "rank")


_F42 = FRAC.format("'42' || chr(0) || source || doc_id")


@query(f"SELECT doc_id, round({_F42}, 9) AS fraction, CASE WHEN {_F42} < 0.8 THEN 'train' WHEN {_F42} < 0.9 THEN 'validation' ELSE 'test' END AS split FROM documents")
def stable_fraction_split(spark, d):
    f = X.stable_fraction(F.lit("42"), F.concat("source", F.col("doc_id").cast("string")))
    return docs(spark, d).select("doc_id", F.round(f, 9).alias("fraction"), allocate.hash_split(f).alias("split"))


@query("""WITH f AS (SELECT source AS file, count(*) AS n FROM documents GROUP BY 1), c AS (SELECT file, n, coalesce(sum(n) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS "at" FROM f),
p AS (SELECT *, unnest(range((c."at" // 64)::bigint, ((c."at" + n - 1) // 64 + 1)::bigint)) AS package FROM c)
SELECT package::bigint AS package, file, greatest(package * 64 - p."at", 0)::bigint AS start, least((package + 1) * 64 - p."at", n)::bigint AS "end" FROM p""")
def package_packing(spark, d):
    files = docs(spark, d).groupBy(F.col("source").alias("file")).agg(F.count("*").alias("n"))
    return allocate.packages(files, "file", "n", 64)


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE value < before")
def monotonic_violations(spark, d):
    return relational.falls(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "value").select("user_id", "event_id")


@query("SELECT user_id, count_if(event_type IS DISTINCT FROM before)::bigint AS runs FROM (SELECT user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) GROUP BY 1")
def source_run_count(spark, d):
    return relational.runs(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type")


# ---- near duplicates ----
TOK = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"


def grams_sql(n: int) -> str:
    return f"(SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(t) - {n - 1}, 1) + 1), lambda i: array_to_string(t[i:i + {n - 1}], ' '))) AS s FROM (SELECT doc_id, {TOK} AS t FROM documents) WHERE len(t) > 0)"


def pair_sql(n: int, least: float, size: int) -> str:
    return f"""WITH g AS {grams_sql(n)}, c AS (SELECT min(doc_id) AS doc_id, list_sort(s) AS s FROM g GROUP BY list_sort(s)), k AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM c WHERE len(s) >= {size})
SELECT a.doc_id AS a, b.doc_id AS b, count(*)::bigint AS overlap FROM k a JOIN k b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) >= {least} * least(a.n, b.n) - 1e-9"""


def grams(spark, d, n, hashed=False):
    some = docs(spark, d).where(F.lower("text").rlike("[\\p{L}\\p{N}]"))  # a test on the sets would build them twice
    return some.select("doc_id", X.ngrams(X.tokens(F.col("text")), n, hashed).alias("s"))


@query(f"SELECT doc_id, len(s)::int AS n FROM {grams_sql(5)}")
def shingle_sizes(spark, d):
    return grams(spark, d, 5).select("doc_id", F.size("s").alias("n"))


@query(pair_sql(5, 0.82, 1))
def neardup_containment_pairs(spark, d):
    return graph.similar_pairs(grams(spark, d, 5, True), "doc_id", "s", 0.82).select("a", "b", F.col("overlap").cast("long").alias("overlap"))


@query(pair_sql(3, 0.80, 12))
def neardup_trigram_pairs(spark, d):
    return graph.similar_pairs(grams(spark, d, 3, True), "doc_id", "s", 0.80, 12).select("a", "b", F.col("overlap").cast("long").alias("overlap"))


@query(f"WITH g AS {grams_sql(5)} SELECT doc_id, min(doc_id) OVER (PARTITION BY list_sort(s)) AS class_id FROM g")
def neardup_classes(spark, d):
    return graph.members(grams(spark, d, 5, True), "doc_id", "s").select("doc_id", "class_id")


@query(f"""WITH RECURSIVE p AS ({pair_sql(5, 0.82, 1)}), e AS (SELECT a, b FROM p UNION SELECT b, a FROM p), r(a, b) AS (SELECT a, a FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT component, count(*)::bigint AS n FROM (SELECT a, min(b) AS component FROM r GROUP BY a) GROUP BY 1""")
def components_size(spark, d):
    pairs = graph.similar_pairs(grams(spark, d, 5, True), "doc_id", "s", 0.82)
    return graph.components(pairs).groupBy("component").agg(F.count("*").alias("n"))


@query("SELECT marker, count(*)::bigint AS n FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS marker FROM documents WHERE regexp_matches(lower(coalesce(text, '')), '{p}')" for n, p in rules.MARKERS) + ") GROUP BY 1")
def marker_families(spark, d):
    return docs(spark, d).select(F.explode(rules.markers(F.col("text"))).alias("marker")).groupBy("marker").agg(F.count("*").alias("n"))


@query(f"WITH p AS ({pair_sql(5, 0.82, 1)}), bad AS (SELECT a, b FROM p JOIN labels x ON x.doc_id = a JOIN labels y ON y.doc_id = b WHERE x.quality <> y.quality) SELECT DISTINCT doc_id FROM (SELECT a AS doc_id FROM bad UNION ALL SELECT b FROM bad)")
def family_conflicts(spark, d):
    pairs = graph.similar_pairs(grams(spark, d, 5, True), "doc_id", "s", 0.82)
    return graph.conflicts(table(spark, d, "labels"), pairs, "doc_id", "quality")


# ---- retrieval, judging ----
_SEEDS = retrieval.seeds()


def inventory(spark):
    rows = [(i, g, p) for i, (g, p) in enumerate(_SEEDS)]
    return spark.createDataFrame(rows, "seed int, grp string, phrase string")


@query("SELECT * FROM (VALUES " + ", ".join(f"({i}, '{g}', '{p}')" for i, (g, p) in enumerate(_SEEDS)) + ") t(seed, grp, phrase)")
def seed_inventory(spark, d):
    return inventory(spark)


@query("SELECT doc_id, phrase FROM documents, (VALUES " + ", ".join(f"('{p}')" for _, p in _SEEDS) + ") t(phrase) WHERE contains(lower(text), phrase)")
def seed_exact_matches(spark, d):
    low = F.lower("text")
    hits = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(p)), F.lit(p)) for _, p in _SEEDS]))
    return docs(spark, d).select("doc_id", F.explode(hits).alias("phrase"))


@query()
def seed_fuzzy_matches(spark, d):
    got = retrieval.fuzzy(docs(spark, d).select("doc_id", "source", "text"), "text", _SEEDS)
    return retrieval.occurrences(got, "source", "doc_id", "text").select("doc_id", "occurrence_id", "candidate_id", "best_phrase", "best_score", F.size("matches").alias("n_matches"))


@query(f"""WITH m AS (SELECT doc_id, source, {HASH} AS h FROM documents WHERE {' OR '.join(f"contains(lower(text), '{p}')" for _, p in _SEEDS)})
SELECT 'candidate-' || substr(h, 1, 24) AS candidate_id, count(*)::bigint AS occurrence_count, min(doc_id) AS first_doc FROM m GROUP BY 1""")
def candidate_occurrences(spark, d):
    low = F.lower("text")
    any_ = F.lit(False)
    for _, p in _SEEDS:
        any_ = any_ | F.contains(low, F.lit(p))
    rows = docs(spark, d).where(any_).select("doc_id", F.concat(F.lit("candidate-"), F.substring(X.text_hash(F.col("text")), 1, 24)).alias("candidate_id"))
    return rows.groupBy("candidate_id").agg(F.count("*").alias("occurrence_count"), F.min("doc_id").alias("first_doc"))


@query("SELECT CASE WHEN r IS NULL OR l IS NULL THEN 'ambiguous' WHEN r AND l THEN 'licensed_with_limits' WHEN r THEN 'limits_only' WHEN l THEN 'license_only' ELSE 'neither' END AS label, count(*)::bigint AS n FROM (SELECT d.doc_id, quality = 0 AS r, toxic = 0 AS l FROM documents d LEFT JOIN labels USING (doc_id)) GROUP BY 1")
def judge_two_axis_labels(spark, d):
    j = docs(spark, d).select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return j.select(rules.two_axes(F.col("quality") == 0, F.col("toxic") == 0).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


@query("""SELECT doc_id, count(*)::bigint AS n_votes, min(label) AS label, min(confidence)::double AS confidence,
CASE WHEN count(*) < 2 THEN 'missing_pass' WHEN count(DISTINCT label) <> 1 THEN 'label_disagreement' WHEN min(confidence) < 0.8 THEN 'low_confidence' END AS rejection_reason,
(count(*) >= 2 AND count(DISTINCT label) = 1 AND min(confidence) >= 0.8) AS accepted
FROM (SELECT doc_id, quality::varchar AS label, 0.9 AS confidence FROM labels UNION ALL SELECT doc_id, (1 - toxic)::varchar, CASE WHEN doc_id % 5 = 0 THEN 0.5 ELSE 1.0 END FROM labels WHERE doc_id % 11 <> 0) GROUP BY doc_id""")
def judge_consensus(spark, d):
    lab = table(spark, d, "labels")
    one = lab.select("doc_id", F.col("quality").cast("string").alias("label"), F.lit(0.9).alias("confidence"))
    two = lab.where("doc_id % 11 <> 0").select("doc_id", (1 - F.col("toxic")).cast("string").alias("label"), F.when(F.col("doc_id") % 5 == 0, 0.5).otherwise(1.0).alias("confidence"))  # the second judge leaves some out, as the SQL does
    votes = one.unionByName(two).withColumns({"signature": F.lit("s"), "valid": F.lit(True)})
    return judging.consensus(votes, "doc_id")


@query("SELECT lang, count_if(quality = 0)::bigint AS q0, count_if(quality = 1)::bigint AS q1 FROM documents JOIN labels USING (doc_id) GROUP BY lang")
def label_matrix_pivot(spark, d):
    j = docs(spark, d).select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id")
    return relational.label_matrix(j, ["lang"], "quality", [0, 1]).select("lang", F.col("0").alias("q0"), F.col("1").alias("q1"))


@query("SELECT lang, (300 - count(*))::bigint AS shortfall FROM documents JOIN labels USING (doc_id) GROUP BY lang HAVING count(*) < 300")
def quota_shortfalls(spark, d):
    j = docs(spark, d).select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id")
    return j.groupBy("lang").agg((F.lit(300) - F.count("*")).alias("shortfall")).where("shortfall > 0")


# ---- extraction, sequences, vectors ----
@query("SELECT page_id, (i - 1)::int AS idx, trim(c[i], ' ') AS comment FROM (SELECT page_id, c, unnest(range(1, len(c) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?s)<!--(.*?)-->', 1) AS c FROM pages))")
def html_comment_extract(spark, d):
    return table(spark, d, "pages").select("page_id", F.posexplode(html_comments(F.col("html"))).alias("idx", "comment"))


@query()
def opening_comment_records(spark, d):
    from ..functions.comments import opening_comments

    rows = table(spark, d, "pages").select("page_id", F.inline(opening_comments(F.col("html"), F.lit("html"), F.col("url"))))
    return rows.select("page_id", "index", "start_line", X.trimmed(F.col("text")).alias("opening_comment"))


@query("SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1)::int AS ordinal, count(*) OVER (PARTITION BY conv_id)::bigint AS turns FROM conversations")
def conversation_ordinals(spark, d):
    c = relational.ordinals(table(spark, d, "conversations"), ["conv_id"], F.col("turn"), F.col("role"), F.col("text"))
    return c.select("conv_id", "turn", "ordinal", F.count("*").over(Window.partitionBy("conv_id")).alias("turns"))


@query("SELECT label, count(*)::bigint AS n, max(len(embedding))::int AS dim, sum(4 * len(embedding))::bigint AS bytes, round(max(list_max(embedding))::double, 6) AS top FROM embeddings GROUP BY label")
def embedding_shape_bytes(spark, d):
    return table(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim"), F.sum(4 * F.size("embedding")).alias("bytes"), F.round(F.max(F.array_max("embedding")).cast("double"), 6).alias("top"))


# ---- events ----
_PAIRS = """(SELECT user_id, before_ts AS started, ts AS finished FROM (SELECT *, lag(event_type) OVER w AS before_type, lag(ts) OVER w AS before_ts FROM events WHERE event_type IN ('view', 'purchase')
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE event_type = 'purchase' AND before_type = 'view')"""


@query(f"SELECT user_id, started, finished FROM {_PAIRS}")
def event_pairing(spark, d):
    return relational.event_pairs(table(spark, d, "events"), "user_id", "ts", "event_type", "view", "purchase")


@query(f"SELECT count(*)::bigint AS n, round(avg(s), 6) AS mean, round(stddev_pop(s), 6) AS sd, round(median(s), 6) AS median, round(quantile_cont(s, 0.1), 6) AS p10, round(quantile_cont(s, 0.9), 6) AS p90 FROM (SELECT (epoch_us(finished) // 1000000 - epoch_us(started) // 1000000)::double AS s FROM {_PAIRS})")
def duration_stats(spark, d):
    p = relational.event_pairs(table(spark, d, "events"), "user_id", "ts", "event_type", "view", "purchase")
    return S.durations(p.select((F.unix_seconds(F.col("finished").cast("timestamp")) - F.unix_seconds(F.col("started").cast("timestamp"))).cast("double").alias("s")), "s")


@query("SELECT event_type, round(count_if(ts > TIMESTAMP '2024-01-30' - INTERVAL 6 HOUR AND ts <= TIMESTAMP '2024-01-30') / 6.0, 6)::double AS per_hour FROM events GROUP BY 1")
def trailing_rates(spark, d):
    end = F.lit("2024-01-30").cast("timestamp_ntz")
    inside = (F.col("ts") > end - F.expr("INTERVAL 6 HOURS")) & (F.col("ts") <= end)
    return table(spark, d, "events").groupBy("event_type").agg(F.round(F.count_if(inside) / 6.0, 6).alias("per_hour"))


_DAY = "(SELECT event_type, date_trunc('day', ts) AS day, count(*)::double AS n FROM events GROUP BY ALL)"


@query(f"""WITH RECURSIVE o AS (SELECT event_type, n, row_number() OVER (PARTITION BY event_type ORDER BY day) AS i FROM {_DAY}),
r AS (SELECT event_type, i, n AS e FROM o WHERE i = 1 UNION ALL SELECT o.event_type, o.i, CASE WHEN r.e = 0 THEN o.n ELSE r.e * 0.65 + o.n * 0.35 END FROM r JOIN o ON o.event_type = r.event_type AND o.i = r.i + 1)
SELECT event_type, round(e::double, 6) AS ema FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY i DESC) AS k FROM r) WHERE k = 1""")
def ema_fold(spark, d):
    daily = table(spark, d, "events").groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg(F.count("*").alias("n"))
    return S.ema(daily, ["event_type"], "day", "n").select("event_type", F.round("ema", 6).alias("ema"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*)::bigint AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling_counts(spark, d):
    out = S.tumbling(S.timed(table(spark, d, "events")), "1 hour", ["event_type"])
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 1 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 1 HOUR AS "end", count(*)::bigint AS n FROM s GROUP BY user_id, k""")
def session_counts(spark, d):
    out = S.sessions(S.timed(table(spark, d, "events")), "1 hour", ["user_id"])
    return out.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@query("SELECT event_id, (props->>'k')::bigint AS k FROM events")
def json_property(spark, d):
    return table(spark, d, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "long").alias("k"))


@query("SELECT event_type, max(hi)::double AS progress FROM (SELECT event_type, max(value) AS hi FROM events GROUP BY 1) GROUP BY 1")
def monotone_progress(spark, d):
    return S.latest_progress(table(spark, d, "events"), "event_type", "ts", "value").withColumnRenamed("value", "progress")


# ---- relational sanity ----
@query("SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(DISTINCT o_orderkey)::bigint AS orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE l_returnflag = 'R' GROUP BY n_name")
def returned_revenue(spark, d):
    li, o, c, n = (table(spark, d, t) for t in ("lineitem", "orders", "customer", "nation"))
    j = li.where("l_returnflag = 'R'").join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count_distinct("o_orderkey").alias("orders"))


from . import more  # noqa: E402, F401  registers further queries
