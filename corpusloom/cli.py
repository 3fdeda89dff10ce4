"""Command line: one sub-command a task; all data work is done by the library's plans.

Exit status: 0 done, 1 a run that failed, 2 input that is wrong.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import text as X
from .operators import allocate, checks, relational
from .plans import classifier, encoding, licenses, mining, retrieval, topics
from .session import session
from .sources import planning, readers, sinks

COMMANDS: dict[str, tuple[Callable, str, list[tuple]]] = {}


def command(name: str, *options: tuple):
    def add(f):
        COMMANDS[name] = (f, f.__doc__.splitlines()[0], list(options))
        return f

    return add


def opt(flag: str, default=None, kind=str, required: bool = False, text: str = "") -> tuple:
    return flag, {"default": default, "type": kind, "required": required, "help": text}


IN, OUT = opt("--input", required=True, text="Parquet path or comment tree"), opt("--output", required=True, text="target folder")
TEXT, SCORE = opt("--text-column", "opening_comment"), opt("--score-column", "comment_license_score")
SPLIT = [opt("--datasets", text="comma-separated"), opt("--languages", text="comma-separated")]


def spark():
    return session("command line")


def chosen(a) -> DataFrame:
    df = spark().read.parquet(a.input)
    for col, names in (("dataset", a.datasets), ("language", a.languages)):
        if names and col in df.columns:
            df = df.where(checks.member(col, planning.names(names)))
    return df


def show(df: DataFrame) -> None:
    for r in df.toLocalIterator():
        print(json.dumps(r.asDict(recursive=True), default=str))


def configured(a) -> dict:
    with open(a.config, encoding="utf-8") as f:
        return planning.config(f.read())


@command("validate-config", opt("--config", required=True))
def validate_config(a):
    """Checks a configuration file."""
    print(f"{len(configured(a)['datasets'])} datasets")


@command("dump-config", opt("--config", required=True))
def dump_config(a):
    """Prints a configuration with all defaults."""
    print(json.dumps(configured(a), indent=2))


@command("list-languages", opt("--listing", required=True, text="text file of paths, one a line"), opt("--level", 1, int, text="path part that names the language"))
def list_languages(a):
    """Languages that a listing's folders name."""
    paths = spark().read.text(a.listing).select(F.get(F.split("value", "/"), F.lit(a.level)).alias("language"))
    show(paths.where("language is not null").distinct().orderBy("language"))


PLAN = [opt("--listing", required=True), opt("--done", text="text file of finished paths"), opt("--include"), opt("--exclude"), opt("--start"), opt("--stop"), opt("--count", 1, int), opt("--index", 0, int), opt("--limit", None, int)]


def planned(a) -> DataFrame:
    if not 0 <= a.index < planning.whole(a.count, "count", 1):
        raise ValueError("index must be below count")
    s = spark()
    listing = s.read.text(a.listing).select(F.trim("value").alias("path")).where("path != ''")
    done = s.read.text(a.done).select(F.trim("value").alias("path")) if a.done else listing.where(F.lit(False))
    listing = listing.where(planning.globbed(F.col("path"), planning.names(a.include), planning.names(a.exclude)))
    return readers.partition_plan(listing, done, a.start, a.stop, a.count, a.index, a.limit)


@command("plan-download", *PLAN)
def plan_download(a):
    """Paths that a download would fetch."""
    show(planned(a))


@command("download", *PLAN, opt("--root", required=True, text="store that holds the paths"), OUT)
def download(a):
    """Copies the planned Parquet files of a store that Spark reads."""
    for r in planned(a).toLocalIterator():
        sinks.copy(spark(), f"{a.root}/{r.path}", f"{a.output}/{r.path}")
        print(r.path)


MINE = [IN, OUT, opt("--dataset", "dataset"), opt("--source", "parquet"), opt("--limit", None, int), opt("--records-per-file", 100_000, int)]


def mined(a, df: DataFrame) -> None:
    rows = mining.comments(readers.records(df if a.limit is None else df.limit(planning.whole(a.limit, "limit", 1)), a.dataset))
    sinks.write_tree(rows.withColumn("language", F.coalesce("language", F.lit("unknown"))), a.output, rows=a.records_per_file)


@command("mine-dataset", *MINE)
def mine_dataset(a):
    """Opening comments of source files as a dataset/language tree."""
    if a.source not in readers.READERS:
        raise ValueError(f"source must be one of {sorted(readers.READERS)}")
    mined(a, readers.READERS[a.source](spark(), a.input))


@command("mine-config", opt("--config", required=True), opt("--root", required=True), OUT, opt("--languages"), opt("--skip-errors", "false"))
def mine_config(a):
    """mine-dataset for each dataset and language of a configuration."""
    conf, wanted = configured(a), planning.names(a.languages)

    def one(name: str, lang: str):
        d = next(x for x in conf["datasets"] if x["name"] == name)
        paths = [f"{a.root}/{planning.filled(p, d['languages'], lang or None, d['splits'][0])}" for p in d["patterns"]]
        df = spark().read.parquet(*paths) if d["source"] == "parquet" else spark().read.json(paths)
        mined(argparse.Namespace(dataset=name, limit=d["limit"], output=f"{a.output}/{name}-{lang or 'all'}", records_per_file=100_000), df)

    done, failed = planning.matrix(one, [d["name"] for d in conf["datasets"]], wanted or [""], planning.flag(a.skip_errors, "skip-errors"))
    print(json.dumps({"done": [list(k) for k in done], "failed": {"/".join(k): v for k, v in failed.items()}}))
    return 1 if failed else 0


@command("mine-stack-v2-packages", *MINE, opt("--package-rows", 100_000, int), opt("--package", None, int))
def mine_packages(a):
    """mine-dataset over packages of equal numbers of rows, or one of them."""
    df = readers.parquet(spark(), a.input)
    files = df.groupBy("_file").agg(F.count("*").alias("n"))
    segments = allocate.packages(files, "_file", "n", planning.whole(a.package_rows, "package-rows", 1))
    if a.package is not None:
        segments = segments.where(F.col("package") == a.package)
    from .operators.selection import package_rows

    mined(a, package_rows(segments, df, "_file", "_row").drop("package", "start", "end"))


@command("mine-stack-v3-shards", *MINE, opt("--done", text="Parquet table of finished paths"))
def mine_shards(a):
    """mine-dataset over content shards that aren't finished."""
    rows = readers.bucket(spark(), a.input, a.dataset)
    rows = rows if a.limit is None else rows.limit(a.limit)
    found = mining.comments(rows.select("dataset", "record_id", "content", "language", F.lit(None).cast("string").alias("path"), F.get("repo_ids", 0).cast("string").alias("repo"), F.lit("{}").alias("metadata")))
    if a.done:
        found = relational.pending(found, spark().read.parquet(a.done), "record_id")
    sinks.write_shards(found, a.output, a.records_per_file)


@command("scan-hf-comment-licenses", IN, OUT, TEXT, *SPLIT, opt("--cache", text="Parquet memo of earlier detections"))
def scan_licenses(a):
    """Adds licence detections and scores."""
    df = licenses.scan(chosen(a).drop("comment_license_detection", "comment_license_score"), a.text_column)
    sinks.write_shards(df, a.output)


@command("prewarm-hf-license-cache", IN, OUT, TEXT, *SPLIT, opt("--cache"))
def prewarm(a):
    """Memo rows of distinct texts that the cache lacks."""
    def detector(texts):
        return licenses.scan(texts, "text").select("key", "comment_license_detection", "comment_license_score")

    df = chosen(a)
    cache = df.sparkSession.read.parquet(a.cache) if a.cache else df.sparkSession.createDataFrame([], "key string")
    sinks.write_shards(licenses.prewarm(df, a.text_column, cache.select("key"), detector), a.output)


@command("license-score-histogram", IN, SCORE, *SPLIT, opt("--bins", 20, int), opt("--low", 0.0, float), opt("--high", 100.0, float))
def histogram(a):
    """Text histogram of the scores."""
    if a.high <= a.low:
        raise ValueError("high must be above low")
    df = chosen(a)
    print(relational.render_histogram(relational.histogram(df, a.score_column, planning.whole(a.bins, "bins", 1), a.low, a.high).orderBy("bin").collect()))
    show(relational.histogram_stats(df, a.score_column, a.low, a.high))


@command("topic-model-low-scancode", IN, OUT, TEXT, SCORE, *SPLIT, opt("--threshold", 0.95, float), opt("--topics", required=True, text="JSON: topic to phrases"))
def topic_model(a):
    """Guided topics of texts with low scores."""
    rows = topics.select_low(chosen(a), a.text_column, a.score_column, a.threshold).where("reason = 'selected'").drop("reason")
    sinks.write_shards(topics.assign(rows, a.text_column, json.loads(a.topics)), a.output)


@command("build-redistribution-candidate-dataset", IN, OUT, TEXT, SCORE, *SPLIT, opt("--families"), opt("--threshold", 0.82, float), opt("--score-below", 90.0, float), opt("--rows", None, int))
def build_candidates(a):
    """Fuzzy seed matches of eligible comments, by fair language quotas if ``rows`` is given."""
    df = chosen(a).where(F.col(a.score_column) < a.score_below)
    if a.rows is not None:
        ranked = relational.ordinals(df, ["language"], F.col("record_id"))
        quota = allocate.water_fill(ranked.groupBy("language").agg(F.count("*").alias("n")), "language", "n", a.rows)
        df = allocate.systematic(ranked, quota, "language").drop("ordinal", "capacity", "quota")
    found = retrieval.fuzzy(df, a.text_column, retrieval.seeds(planning.names(a.families) or None), a.threshold)
    sinks.write_shards(retrieval.occurrences(found, "dataset", "record_id", a.text_column), a.output)


@command("verify-redistribution-candidate-dataset", IN, opt("--source", required=True, text="the comments that were searched"), TEXT)
def verify_candidates(a):
    """Problems of a candidate dataset: repeated occurrences, texts that the source doesn't have."""
    s = spark()
    rows, src = s.read.parquet(a.input), s.read.parquet(a.source)
    twice = rows.groupBy("occurrence_id").count().where("count > 1").select("occurrence_id")
    lost = checks.provenance(rows.select("record_id", a.text_column), src.select("record_id", a.text_column), ["record_id"], [a.text_column]).select("record_id")
    return problems(relational.violations(repeated=twice, unconfirmed=lost))


@command("build-classifier-dataset", IN, OUT, TEXT, *SPLIT, opt("--per-cell", None, int), opt("--per-class", None, int), opt("--min-chars", 12, int), opt("--max-chars", 12_000, int), opt("--seed", "42"))
def build_classifier(a):
    """Candidates in the length window, bounded pools and splits."""
    goal = planning.targets(a.per_cell, a.per_class)
    rows = classifier.candidates(chosen(a), a.text_column, a.min_chars, a.max_chars)
    sinks.write_shards(classifier.simple_split(classifier.pools(rows, max(goal.values())), a.seed), a.output)


@command("verify-classifier-dataset", IN)
def verify_classifier(a):
    """Problems of a classifier dataset: repeated examples, texts in two splits."""
    rows = spark().read.parquet(a.input)
    twice = rows.groupBy("example_id").count().where("count > 1").select("example_id")
    across = rows.groupBy("comment_hash").agg(F.count_distinct("split").alias("n")).where("n > 1").select("comment_hash")
    return problems(relational.violations(repeated=twice, across_splits=across))


def problems(df: DataFrame) -> int:
    found = df.limit(20).collect()
    for r in found:
        print(f"{r.rule}: {r.id}")
    print("no problem" if not found else "problems found")
    return 1 if found else 0


@command("benchmark-encoding-capacity", IN, TEXT, *SPLIT, opt("--start", 128, int), opt("--growth", 2.0, float), opt("--order", "record_id"))
def benchmark_encoding(a):
    """Rates of a hashing encoder over growing prefixes of the texts."""
    def encode(texts: list[str]) -> list[list[float]]:
        return [[float(hash(w) % 97) for w in t.split()[:8]] for t in texts]

    df = chosen(a)
    for row in encoding.measure(df, a.order, a.text_column, encode, encoding.ladder(df.count(), a.start, a.growth)):
        print(json.dumps(row))


@command("export-hf-dataset", IN, OUT, opt("--name", "dataset"), opt("--dedupe", "group", text="group, global or none"), opt("--workers", 1, int))
def export(a):
    """A deduplicated dataset/language tree with a manifest and a card."""
    if a.dedupe not in ("group", "global", "none"):
        raise ValueError("dedupe must be group, global or none")
    if a.dedupe == "global" and a.workers > 1:
        raise ValueError("a global dedupe takes one worker")
    df = spark().read.parquet(a.input)
    out = df if a.dedupe == "none" else mining.materialize(df, () if a.dedupe == "global" else ("language",))
    sinks.write_tree(out.withColumn("split", X.split_name(F.col("language"))), f"{a.output}/data")
    groups = sinks.group_manifest(out, ["dataset", "language"])
    sinks.write_text(df.sparkSession, f"{a.output}/README.md", sinks.card(groups, a.name))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusloom", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="command", required=True)
    for name, (f, text, options) in COMMANDS.items():
        one = sub.add_parser(name, help=text)
        for flag, how in options:
            one.add_argument(flag, **how)
        one.set_defaults(run=f)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        return a.run(a) or 0
    except (KeyError, ValueError, FileNotFoundError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    except Exception as e:
        print(f"failed: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
