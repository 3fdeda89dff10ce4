"""More queries over the given tables: checks, orders, text families, planning and progress."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import families, rules
from ..functions import text as X
from ..operators import allocate, checks, relational, selection
from ..session import table
from ..sources import planning
from ..streaming import events as S
from . import licenses, retrieval
from .queries import _LT, _SEEDS, HASH, NOTICE, ROUTE, TOK, docs, eligible, query, scored


# ---- filters and assertions ----
@query("SELECT doc_id FROM documents WHERE coalesce(lang, '') IN ('de', 'fr')")
def membership_filter(spark, d):
    return docs(spark, d).where(checks.member("lang", ["de", "fr"])).select("doc_id")


@query("SELECT doc_id, lang FROM documents WHERE lang IS DISTINCT FROM 'en'")
def partition_mismatches(spark, d):
    return checks.mismatches(docs(spark, d).withColumn("folder", F.lit("en")), {"folder": "lang"}).select("doc_id", "lang")


@query("SELECT count(*)::bigint AS n FROM documents WHERE text IS NOT NULL")
def partition_assertion(spark, d):
    rows = docs(spark, d).withColumn("folder", F.col("lang"))
    return checks.asserted(rows, {"folder": "lang"}).where("text is not null").agg(F.count("*").alias("n"))


@query("SELECT d.doc_id FROM documents d JOIN labels l USING (doc_id) WHERE l.toxic = 1")
def subset_true(spark, d):
    marked = docs(spark, d).select("doc_id").join(table(spark, d, "labels"), "doc_id", "left").withColumn("toxic", F.col("toxic") == 1)
    return marked.where(checks.is_true("toxic")).select("doc_id")


@query("SELECT doc_id, coalesce(length(text), 0) BETWEEN 200 AND 12000 AS kept, CASE WHEN coalesce(length(text), 0) < 200 THEN 'short' WHEN length(text) > 12000 THEN 'long' END AS reason FROM documents")
def length_window(spark, d):
    n = F.coalesce(F.length("text"), F.lit(0))
    return docs(spark, d).select("doc_id", n.between(200, 12000).alias("kept"), F.when(n < 200, "short").when(n > 12000, "long").alias("reason"))


# ---- detections ----
_HITS = "[" + ", ".join(f"CASE WHEN regexp_matches({_LT}, '{p}') THEN {{'e': '{e}', 's': {w}::double}} END" for _, e, w, p in rules.LICENSES) + "]"


@query(f"SELECT doc_id, m.e AS expression, m.s AS score, 100.0::double AS coverage FROM (SELECT doc_id, unnest(list_filter({_HITS}, lambda x: x IS NOT NULL)) AS m FROM documents)")
def detection_shapes(spark, d):
    """Both shapes of a detection, made from the rules and read back as one: even ids the older, odd ones the newer."""
    found = rules.matches(F.col("text"))
    old = F.to_json(F.struct(F.transform(found, lambda m: F.struct(m["expression"].alias("key"), m["score"].alias("score"))).alias("licenses")))
    new = F.to_json(F.struct(F.transform(found, lambda m: F.struct(m["expression"].alias("license_expression"), F.array(F.struct(m["score"].alias("score"), m["match_coverage"].alias("match_coverage"))).alias("matches"))).alias("license_detections")))
    rows = docs(spark, d).select("doc_id", F.when(F.col("doc_id") % 2 == 0, old).otherwise(new).alias("j"))
    return rows.select("doc_id", F.explode(licenses.normalized_matches(F.col("j"))).alias("m")).select("doc_id", "m.*")


@query("""SELECT doc_id, CASE WHEN length(text) <= 400 THEN text ELSE concat_ws(chr(10) || '...' || chr(10), left(text, 200), substr(text, greatest(greatest(instr(text, 'the'), 1) - 50, 1), 100), right(text, 100)) END AS judged,
length(text) > 400 AS truncated FROM documents WHERE text IS NOT NULL""")
def judge_text(spark, d):
    rows = docs(spark, d).where("text is not null")
    return rows.select("doc_id", licenses.judge_text(F.col("text"), F.lit("the"), 400).alias("judged"), (F.length("text") > 400).alias("truncated"))


@query(f"SELECT source, count(*)::bigint AS rows, count_if({NOTICE})::bigint AS notices FROM documents GROUP BY source")
def detection_recount(spark, d):
    return licenses.recount(scored(spark, d), ["source"])


# ---- joins ----
@query("SELECT doc_id, quality, toxic, length(text)::int AS n FROM documents JOIN labels USING (doc_id)")
def candidate_decisions(spark, d):
    lab = table(spark, d, "labels")
    have = docs(spark, d).join(lab.select("doc_id"), "doc_id", "left_semi").select("doc_id", F.length("text").alias("n"))
    return checks.one_to_one(have, lab.select("doc_id", "quality", "toxic"), "doc_id")


@query(f"WITH h AS (SELECT doc_id, {HASH} AS h FROM documents), c AS (SELECT h, min(doc_id) AS first_doc FROM h GROUP BY h) SELECT doc_id, first_doc FROM h JOIN c ON h.h IS NOT DISTINCT FROM c.h WHERE h.h IS NOT NULL")
def occurrence_decisions(spark, d):
    h = docs(spark, d).select("doc_id", X.text_hash(F.col("text")).alias("h"))
    return h.join(h.groupBy("h").agg(F.min("doc_id").alias("first_doc")), "h").select("doc_id", "first_doc")


@query("SELECT doc_id FROM documents WHERE doc_id % 7 <> 0 AND n_chars IS NOT NULL")
def stale_prune(spark, d):
    now = docs(spark, d).select("doc_id", F.col("n_chars").alias("size"))
    ledger = now.withColumn("size", F.when(F.col("doc_id") % 7 == 0, F.col("size") + 1).otherwise(F.col("size")))
    return checks.fresh(ledger, now, "doc_id", "size").select("doc_id")


@query("SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'new' WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 THEN 'rescan' ELSE 'reuse' END AS state FROM documents")
def scan_checkpoints(spark, d):
    me, other = (licenses.scan_identity("rules", score=s) for s in (95, 90))
    now = docs(spark, d).select("doc_id", F.coalesce("n_chars", F.lit(0)).alias("size"), F.lit("t0").alias("mtime"))
    old = now.where("doc_id % 5 != 0").select("doc_id", F.when(F.col("doc_id") % 7 == 0, F.col("size") + 1).otherwise(F.col("size")).alias("size"), "mtime", F.when(F.col("doc_id") % 11 == 0, other).otherwise(me).alias("identity"))
    return checks.checkpoint_state(old, now, "doc_id", me)


_MARKED = " UNION ALL ".join(f"SELECT doc_id, '{n}' AS value FROM documents WHERE regexp_matches({_LT}, '{p}')" for n, p in rules.MARKERS)


@query(f"SELECT doc_id, first, value FROM (SELECT doc_id, value, min(doc_id) OVER (PARTITION BY value) AS first FROM ({_MARKED})) WHERE doc_id <> first")
def marker_links(spark, d):
    return checks.linked_by(docs(spark, d), "doc_id", rules.markers(F.col("text")))


@query("SELECT doc_id, source, CASE WHEN doc_id % 50 = 1 THEN 'missing' ELSE 'n_chars' END AS problem FROM documents WHERE doc_id % 50 IN (0, 1)")
def provenance_mismatches(spark, d):
    found = docs(spark, d).where("doc_id % 50 != 1").select("doc_id", "source", "lang", F.coalesce("n_chars", F.lit(0)).alias("n_chars"))
    said = docs(spark, d).select("doc_id", "source", "lang", (F.coalesce("n_chars", F.lit(0)) + F.when(F.col("doc_id") % 50 == 0, 1).otherwise(0)).alias("n_chars"))
    return checks.provenance(said, found, ["doc_id", "source"], ["lang", "n_chars"])


# ---- sets ----
@query("SELECT lang AS name FROM documents UNION SELECT source FROM documents")
def distinct_union(spark, d):
    return docs(spark, d).select(F.col("lang").alias("name")).union(docs(spark, d).select("source")).distinct()


@query("SELECT EXISTS (SELECT 1 FROM documents JOIN labels USING (doc_id)) AS labelled, EXISTS (SELECT 1 FROM documents WHERE lang IN (SELECT source FROM documents)) AS mixed")
def set_intersections(spark, d):
    a, lab = docs(spark, d), table(spark, d, "labels")
    both = [checks.overlap(a, lab, "doc_id"), checks.overlap(a.select(F.col("lang").alias("x")), a.select(F.col("source").alias("x")), "x")]
    return spark.createDataFrame([tuple(both)], "labelled boolean, mixed boolean")


@query("SELECT lang, source, (count(*) FILTER (doc_id % 3 = 0) - count(*) FILTER (doc_id % 3 = 1))::bigint AS surplus FROM documents GROUP BY ALL HAVING count(*) FILTER (doc_id % 3 = 0) <> count(*) FILTER (doc_id % 3 = 1)")
def multiset_difference(spark, d):
    part = lambda k: docs(spark, d).where(F.col("doc_id") % 3 == k).select("lang", "source")
    return checks.multiset_difference(part(0), part(1))


# ---- orders ----
@query(f"""SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY (c = 'irrelevant') DESC, (CASE WHEN c = 'irrelevant_random' THEN least(n, 800) ELSE 0 END) DESC, n_chars DESC, doc_id)::int AS rank
FROM (SELECT doc_id, lang, coalesce(n_chars, 0) AS n_chars, coalesce(length(text), 0) AS n, coalesce({ROUTE}, '') AS c FROM documents)""")
def ranking_key(spark, d):
    rows = docs(spark, d).select("doc_id", "lang", F.coalesce("n_chars", F.lit(0)).alias("p"), F.coalesce(F.length("text"), F.lit(0)).alias("n"), F.coalesce(rules.route(F.col("text")), F.lit("")).alias("c"))
    key = selection.rank_key(F.col("c"), F.col("n"), F.col("p"), F.col("doc_id"))
    return rows.select("doc_id", F.row_number().over(Window.partitionBy("lang").orderBy(*key)).alias("rank"))


_CELLS = "(SELECT DISTINCT source || chr(47) || lang AS cell FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL)"


def cells(spark, d):
    return docs(spark, d).select(F.concat("source", F.lit("/"), "lang").alias("cell")).where("cell is not null").distinct()


@query(f"SELECT cell, row_number() OVER (ORDER BY r % 3, r)::int AS place FROM (SELECT cell, row_number() OVER (ORDER BY cell) - 1 AS r FROM {_CELLS})")
def interleaved_packages(spark, d):
    ranked = cells(spark, d).withColumn("r", F.row_number().over(Window.orderBy("cell")) - 1)  # one row a package
    return ranked.select("cell", F.row_number().over(Window.orderBy(*selection.interleaved(ranked, "r", 3))).alias("place"))


@query(f"SELECT cell, row_number() OVER (ORDER BY sha256('42' || chr(0) || cell), cell)::int AS place FROM {_CELLS}")
def seeded_shuffle(spark, d):
    return cells(spark, d).select("cell", F.row_number().over(Window.orderBy(*selection.shuffled(F.col("cell"), 42))).alias("place"))  # one row a package


@query("SELECT doc_id FROM documents ORDER BY doc_id LIMIT 10")
def record_limit(spark, d):
    return docs(spark, d).select("doc_id").orderBy("doc_id").limit(10)  # the limit is the feature


@query("""WITH s AS (SELECT source AS file, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx FROM documents WHERE source IS NOT NULL), f AS (SELECT file, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT file, n, coalesce(sum(n) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM f)
SELECT ((before + idx) // 64)::bigint AS package, file, count(*)::bigint AS n, min(idx)::bigint AS first_row FROM s JOIN c USING (file) GROUP BY 1, 2""")
def package_rows(spark, d):
    rows = docs(spark, d).where("source is not null").select(F.col("source").alias("file"), "doc_id")
    rows = relational.ordinals(rows, ["file"], F.col("doc_id"), name="idx").withColumn("idx", F.col("idx").cast("long"))
    segments = allocate.packages(rows.groupBy("file").agg(F.count("*").alias("n")), "file", "n", 64)
    return selection.package_rows(segments, rows, "file", "idx").groupBy("package", "file").agg(F.count("*").alias("n"), F.min("idx").alias("first_row"))


@query("SELECT doc_id FROM documents WHERE doc_id < 50")
def prefix_scan(spark, d):
    rows = docs(spark, d).select("doc_id", F.lit("one path").alias("path"))
    return selection.prefix(rows, "path", "doc_id", 50).select("doc_id")


@query()
def greedy_selection(spark, d):
    """Diverse rows of a bounded pool a language: no text hash and no boilerplate marker twice."""
    marks = F.concat(F.array(X.text_hash(F.col("text"))), rules.markers(F.col("text")))
    pool = docs(spark, d).where("text is not null").select("doc_id", "lang", marks.alias("marks"), X.stable_fraction(F.col("doc_id").cast("string")).alias("p"))
    pool = allocate.bounded_pool(pool, ["lang"], ["doc_id"], 200, F.desc("p"), F.col("doc_id"))
    return selection.greedy_diverse(pool, "lang", "doc_id", "marks", 20, "rank").select("doc_id", "lang", "rank", "decision")


# ---- text families ----
_SEG = "list_filter(regexp_split_to_array(coalesce(text, ''), '[.!?]\\s+|\\n+'), lambda s: trim(s, ' ') <> '')"
_CUE = " OR ".join(f"contains(lower(s), '{c}')" for c in families.CUES)
_SEM = f"(SELECT doc_id, CASE WHEN len(g) > 0 THEN array_to_string(g, ' ') ELSE coalesce(text, '') END AS text FROM (SELECT doc_id, text, list_filter({_SEG}, lambda s: {_CUE}) AS g FROM documents))"


@query(f"SELECT doc_id, len(list_distinct(list_transform(range(1, greatest(len(t) - 4, 1) + 1), lambda i: array_to_string(t[i:i + 4], ' '))))::int AS n FROM (SELECT doc_id, {TOK} AS t FROM {_SEM}) WHERE len(t) > 0")
def semantic_shingles(spark, d):
    return docs(spark, d).select("doc_id", families.semantic_shingles(F.col("text")).alias("s")).where("size(s) > 0").select("doc_id", F.size("s").alias("n"))


_FT = "trim(lower(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')), ' ')"
_V = f"regexp_extract(t, '{families.VERSION}', 1)"
_VER = f"CASE WHEN {_V} = '' THEN '' WHEN contains({_V}, '.') THEN '-' || {_V} ELSE '-' || {_V} || '.0' END"
_GNU = f"CASE WHEN {_V} = '' THEN '' WHEN regexp_matches(t, '{families.LATER}') THEN '-or-later' ELSE '-only' END"


@query(f"SELECT * FROM (SELECT doc_id, CASE {' '.join(f'''WHEN regexp_matches(t, '{p}') THEN '{n}' || ({_VER}) || {f'({_GNU})' if g else chr(39) * 2}''' for n, g, p in families.FAMILIES)} END AS license FROM (SELECT doc_id, {_FT} AS t FROM documents)) WHERE license IS NOT NULL")
def license_canonical(spark, d):
    return docs(spark, d).select("doc_id", families.canonical(F.col("text")).alias("license")).where("license is not null")


@query(f"SELECT doc_id, coalesce(nullif(lower(trim(regexp_replace(source, '\\s+', ' ', 'g'), ' ')), ''), {HASH}) AS split_group FROM documents")
def split_groups_key(spark, d):
    return docs(spark, d).select("doc_id", families.split_group(F.col("source"), X.text_hash(F.col("text"))).alias("split_group"))


# ---- planning and progress ----
@query("SELECT page_id, url FROM pages WHERE url LIKE '%/%a%' AND url NOT LIKE '%e1%' ORDER BY url")
def glob_listing(spark, d):
    return table(spark, d, "pages").where(planning.globbed(F.col("url"), ["*/*a*"], ["*e1*"])).select("page_id", "url").orderBy("url")


_FILES = "(SELECT DISTINCT lang AS language, source AS path FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL)"


@query(f"""SELECT language, path, file_index::int AS file_index FROM (SELECT *, dense_rank() OVER (ORDER BY language) AS l FROM (SELECT *, row_number() OVER (ORDER BY language, path) - 1 AS file_index FROM {_FILES}) WHERE language <> 'de')
WHERE l <= 2 ORDER BY file_index LIMIT 5""")
def bucket_plan(spark, d):
    files = docs(spark, d).select(F.col("lang").alias("language"), F.col("source").alias("path")).where("language is not null and path is not null").distinct()
    return selection.first_languages(files, "language", "path", exclude=["de"], languages=2, shards=5)


@query("SELECT lang, count(*)::bigint AS total, count_if(doc_id IN (SELECT doc_id FROM labels))::bigint AS completed, count_if(doc_id % 9 = 0)::bigint AS active FROM documents GROUP BY lang")
def language_progress(spark, d):
    a = docs(spark, d).select("lang", "doc_id")
    return S.group_progress(a, checks.fresh(a, table(spark, d, "labels"), "doc_id"), a.where("doc_id % 9 = 0"), "lang", "doc_id")


@query("""WITH l AS (SELECT value AS v, ts, event_id FROM events WHERE value IS NOT NULL ORDER BY ts DESC, event_id DESC LIMIT 100)
SELECT count(v)::bigint AS n, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS sd, round(median(v), 6) AS median, round(quantile_cont(v, 0.1), 6) AS p10, round(quantile_cont(v, 0.9), 6) AS p90, list(v ORDER BY ts DESC, event_id DESC)[1:5] AS latest FROM l""")
def latest_durations(spark, d):
    return S.latest_durations(table(spark, d, "events"), "ts", "event_id", "value")


@query("SELECT role, count(*)::bigint AS calls, coalesce(sum(length(text)), 0)::bigint AS tokens, coalesce(sum(turn), 0)::bigint AS retries FROM conversations GROUP BY role")
def token_usage(spark, d):
    return S.usage(table(spark, d, "conversations").select("role", F.length("text").alias("tokens"), F.col("turn").alias("retries")), ["role"], "tokens", "retries")


@query("""WITH c AS (SELECT user_id, max_by(event_id, ts) AS done FROM (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) AS r FROM events) WHERE r = 1 GROUP BY user_id),
s AS (SELECT user_id, count(*) * 100 AS size FROM events GROUP BY user_id)
SELECT count(*)::bigint AS shards, count(done)::bigint AS begun, coalesce(sum(done), 0)::bigint AS done, sum(greatest(size - coalesce(done, 0), 0))::bigint AS "left", round(sum(greatest(size - coalesce(done, 0), 0)) / 250.0, 3)::double AS eta_seconds FROM s LEFT JOIN c USING (user_id)""")
def completion_metrics(spark, d):
    ev = table(spark, d, "events")
    points = ev.groupBy("user_id", "ts").agg(F.min("event_id").alias("event_id"))
    return S.completion(points, ev.groupBy("user_id").agg((F.count("*") * 100).alias("size")), "user_id", "ts", "event_id", "size", 250.0)


@query("""SELECT doc_id, count(*) = 2 AND count(DISTINCT label) = 1 AND min(confidence) >= 0.8 AS holds FROM (SELECT doc_id, quality AS label, 0.9 AS confidence FROM labels
UNION ALL SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 1 - quality ELSE quality END, CASE WHEN doc_id % 5 = 0 THEN 0.5 ELSE 0.85 END FROM labels) GROUP BY doc_id""")
def consensus_recheck(spark, d):
    vote = lambda label, c: F.struct(label.cast("string").alias("label"), c.alias("confidence"))
    q, i = F.col("quality"), F.col("doc_id")
    votes = F.to_json(F.array(vote(q, F.lit(0.9)), vote(F.when(i % 3 == 0, 1 - q).otherwise(q), F.when(i % 5 == 0, 0.5).otherwise(0.85))))
    return table(spark, d, "labels").select("doc_id", checks.votes_hold(votes, "struct<label:string,confidence:double>", 0.8).alias("holds"))


@query(f"SELECT doc_id, s AS setup, sha256('[\"' || s || '\",\"' || {HASH} || '\"]') AS memo_key FROM documents, (VALUES ('direct'), ('cautious')) t(s) WHERE text IS NOT NULL")
def two_pass_batches(spark, d):
    from ..operators.judging import cache_key

    rows = docs(spark, d).where("text is not null").select("doc_id", F.explode(F.array(F.lit("direct"), F.lit("cautious"))).alias("setup"), X.text_hash(F.col("text")).alias("h"))
    return rows.select("doc_id", "setup", cache_key(F.col("setup"), F.col("h")).alias("memo_key"))


@query("""WITH t AS (SELECT lang, count(*) AS n FROM documents WHERE lang <> 'es' GROUP BY 1), top AS (SELECT lang FROM (SELECT lang, row_number() OVER (ORDER BY n DESC, lang) AS r FROM t) WHERE r <= 2)
SELECT lang AS topic, doc_id, left(text, 1200) AS sample FROM (SELECT lang, doc_id, text, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents WHERE lang IN (SELECT lang FROM top)) WHERE r <= 3""")
def cluster_samples(spark, d):
    from .topics import samples

    return samples(docs(spark, d), "lang", "doc_id", "text", topics=2, rows=3, outlier="es")


# ---- the stratified scan, end to end ----
def stratified(spark, d, total: int = 100):
    """Eligible rows by language, fair quotas, an evenly spaced sample of each, fuzzy seeds, unique candidates."""
    ranked = eligible(spark, d)
    quota = allocate.water_fill(ranked.groupBy("lang").agg(F.count("*").alias("n")), "lang", "n", total)
    picked = allocate.systematic(ranked, quota, "lang").select("doc_id")
    rows = docs(spark, d).join(picked, "doc_id", "left_semi").select("doc_id", "source", "text")
    return retrieval.occurrences(retrieval.fuzzy(rows, "text", _SEEDS), "source", "doc_id", "text")


@query()
def stratified_scan(spark, d):
    return retrieval.unique_candidates(stratified(spark, d), "doc_id").select("candidate_id", "occurrence_count")
