"""Phrase search by brute force, checks, orders, planning, and each command."""

import difflib
import functools
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from corpusloom import cli
from corpusloom.functions import fuzzy
from corpusloom.operators import checks, graph, relational, selection
from corpusloom.plans import licenses, more, queries, retrieval
from corpusloom.sources import planning, sinks
from corpusloom.streaming import events


def brute_find(phrases, text, threshold):
    """Every window of every phrase by a recursive edit distance."""

    def swap(a, b):
        r = difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()
        return 0.0 if a == b else 1 - r if r >= 0.8 else 1.0

    words = [t for t, _, _ in fuzzy.spans(text)]
    out = []
    for o, (_, phrase) in enumerate(phrases):
        want = [t for t, _, _ in fuzzy.spans(phrase)]
        anchors = {t for t in want if len(t) >= 3 and t not in fuzzy.STOP} or set(want)
        best = None
        for b, size in itertools.product(range(len(words)), range(max(1, len(want) - 1), len(want) + 3)):
            near = any(w in anchors and abs(i - k - b) <= 2 for i, w in enumerate(words) for k, t in enumerate(want) if t == w)
            if b + size > len(words) or not near:
                continue
            win = words[b : b + size]

            @functools.cache
            def d(i, j, win=win, want=want):
                if not i or not j:
                    return i * 1.0 + j * 0.5
                return min(d(i - 1, j) + 1.0, d(i, j - 1) + 0.5, d(i - 1, j - 1) + swap(want[i - 1], win[j - 1]))

            key = (-max(0.0, 1 - d(len(want), size) / max(len(want), size)), size, b)
            best = key if best is None or key < best else best
        if best and -best[0] >= threshold - 1e-12:
            out.append((o, round(-best[0], 6), " ".join(words[best[2] : best[2] + best[1]])))
    return sorted(out, key=lambda x: (-x[1], x[0]))


def test_phrase_search_equals_all_windows():
    rng = random.Random(6)
    vocab = "may not be redistributed redistribute without prior written permission of the owner owners grant granted funded xx".split()
    for _ in range(150):
        phrases = [("g", " ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 6)))) for _ in range(3)]
        text = " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 25)))
        got = fuzzy.PhraseSearch(phrases, 0.6).find(text)
        assert [(m["ordinal"], m["score"], " ".join(t for t, _, _ in fuzzy.spans(m["excerpt"]))) for m in got] == brute_find(phrases, text, 0.6)


def test_phrase_search_where_an_anchor_leaves_no_begin(spark):
    phrases = [("g", "this file contains trade secrets"), ("g", "see the license file")]
    search = fuzzy.PhraseSearch(phrases)
    assert search.find("secrets") == [] == search.find("Secrets of the trade, see the rest")
    text = "Secrets: see the license file"  # one phrase has no begin, the other a window
    assert [(m["phrase"], m["excerpt"]) for m in search.find(text)] == [("see the license file", "see the license file")]
    wide = "\uff33\uff25\uff25 the \uff4c\uff49\uff43\uff45\uff4e\uff53\uff45 \uff46\uff49\uff4c\uff45"  # full-width letters fold to the phrase
    df = spark.createDataFrame([(1, "secrets"), (2, text), (3, None), (4, wide)], "doc_id long, text string")
    assert {r.doc_id: len(r.matches) for r in retrieval.fuzzy(df, "text", phrases).collect()} == {2: 1, 4: 1}


def test_fuzzy_query_equals_all_windows(spark, small):
    want = {}
    for r in queries.docs(spark, small).select("doc_id", "text").collect():
        low = (r.text or "").lower()
        if any(w in low for w in ("redistribut", "confidential", "licensed", "license", "permission", "export", "grant", "unpublished")) and len(low) < 6000:
            hits = brute_find(retrieval.seeds(), r.text, 0.82)
            if hits:
                want[r.doc_id] = (len(hits), hits[0][1])
    got = {r.doc_id: (r.n_matches, r.best_score) for r in queries.seed_fuzzy_matches(spark, small).collect()}
    assert want and {k: v for k, v in got.items() if k in want} == want


def test_stratified_scan_equals_its_parts(spark, small):
    picked = {r.doc_id for r in queries.systematic_sample(spark, small).collect()}
    whole = {r.doc_id for r in queries.seed_fuzzy_matches(spark, small).collect()}
    assert sum(r.occurrence_count for r in more.stratified_scan(spark, small).collect()) == len(picked & whole)


def test_stratified_scan_where_texts_start_with_a_seed_word(spark, tmp_path):
    rows = [(i, "Secrets of row" if i % 2 else f"This file contains trade secrets {i % 6}", "en", "src") for i in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    picked = {r.doc_id for r in queries.systematic_sample(spark, str(tmp_path)).collect()}
    got = more.stratified_scan(spark, str(tmp_path)).collect()
    assert len(picked) == 100 and len(got) == len({i % 6 for i in picked if i % 2 == 0}) and sum(r.occurrence_count for r in got) == sum(i % 2 == 0 for i in picked)


def test_greedy_selection_by_a_walk(spark, small):
    pool = {(r.lang, r["rank"]): r for r in more.greedy_selection(spark, small).collect()}
    assert {r.decision for r in pool.values()} <= {"kept", "duplicate", "quota_excess"}
    df = spark.createDataFrame([("a", 1, ["x"]), ("a", 2, ["x", "y"]), ("a", 3, ["y"]), ("a", 4, ["z"]), ("b", 1, None)], "cell string, rank int, marks array<string>")
    got = {(r.cell, r["rank"]): r.decision for r in selection.greedy_diverse(df, "cell", "rank", "marks", 2, "rank").collect()}
    assert got == {("a", 1): "kept", ("a", 2): "duplicate", ("a", 3): "kept", ("a", 4): "quota_excess", ("b", 1): "kept"}


def test_assertions_fail_the_run(spark):
    df = spark.createDataFrame([(1, "a", "a"), (2, "b", "c")], "id int, x string, y string")
    assert checks.asserted(df.where("id = 1"), {"x": "y"}).count() == 1
    with pytest.raises(Exception, match="x differs"):
        checks.asserted(df, {"x": "y"}).collect()
    with pytest.raises(Exception, match="without one partner"):
        checks.one_to_one(df, df.where("id = 1").select("id", F.lit(1).alias("z")), "id").collect()
    with pytest.raises(Exception, match="without one partner"):
        checks.one_to_one(df, df.union(df).select("id", F.lit(1).alias("z")), "id").collect()
    with pytest.raises(Exception, match="falls to"):
        relational.rising(spark.createDataFrame([("k", 1, 5), ("k", 2, 4)], "k string, t int, v int"), ["k"], ["t"], "v").collect()
    assert checks.multiset_difference(df, df).isEmpty() and not checks.multiset_difference(df, df.limit(1)).isEmpty()


def test_provenance_compares_parsed_json(spark):
    a = spark.createDataFrame([(1, '{"a": 1,  "b": 2}', "x")], "id int, j string, v string")
    b = spark.createDataFrame([(1, '{"b":2,"a":1}', "x")], "id int, j string, v string")
    assert checks.provenance(a, b, ["id"], ["j", "v"], ["j"]).isEmpty() and not checks.provenance(a, b, ["id"], ["j", "v"]).isEmpty()


def test_slots_are_a_maximum():
    rng = random.Random(9)
    for _ in range(60):
        rows = list({(c, h): (c, h, rng.random()) for c in "abc" for h in "uvwxyz" if rng.random() < 0.4}.values())
        limits = {c: rng.randrange(0, 4) for c in "abc"}
        got = selection.slots(rows, limits)
        assert len({h for _, h in got}) == len(got) and all(sum(c == k for c, _ in got) <= n for k, n in limits.items())

        @functools.cache
        def most(hs, left, rows=tuple((c, h) for c, h, _ in rows)):
            if not hs:
                return 0
            rest = most(hs[1:], left)
            for i, c in enumerate("abc"):
                if (c, hs[0]) in rows and left[i]:
                    rest = max(rest, 1 + most(hs[1:], left[:i] + (left[i] - 1,) + left[i + 1 :]))
            return rest

        assert len(got) == most("uvwxyz", tuple(limits[c] for c in "abc"))


def test_budget_grows_caps(spark):
    cells = spark.createDataFrame([("a", 10), ("b", 10)], "c string, n long")
    pick = lambda caps: [("a", i) for i in range(min(caps["a"], 2))] + [("b", i) for i in range(caps["b"])]
    assert len(selection.within_budget(cells, "c", "n", 10, pick)) == 10
    assert len(selection.within_budget(cells, "c", "n", 16, pick)) == 12


def test_ranged_ordinals(spark):
    df = spark.createDataFrame([("a" if i % 3 else None, i * 7 % 101) for i in range(101)], "g string, k long")
    want = {tuple(r) for r in relational.ordinals(df, ["g"], F.col("k")).collect()}
    assert {tuple(r) for r in relational.ranged_ordinals(df, "g", "k", rows=9).collect()} == want


def test_split_components_goes_by_size(spark):
    sizes = spark.createDataFrame([(i, n) for i, n in enumerate([40, 30, 10, 10, 5, 5])], "component long, n long")
    got = {r.component: r.split for r in graph.split_components(sizes, {"train": 0.8, "test": 0.2}).collect()}
    assert len(got) == 6 and got[0] == "train" and 10 <= sum(n for i, n in enumerate([40, 30, 10, 10, 5, 5]) if got[i] == "test") <= 30


def test_jaccard_branch_is_inside_containment():
    for a, b in itertools.product(range(1, 40), repeat=2):
        for c in range(min(a, b) + 1):
            assert c / (a + b - c) < 0.8 or c / min(a, b) >= 0.82


def test_prefix_needs_its_end(spark):
    df = spark.createDataFrame([("p", i) for i in range(5)], "path string, i int")
    assert selection.prefix(df, "path", "i", 3).count() == 3
    for bad, n in ((df, 9), (df.union(spark.createDataFrame([("q", 1)], df.schema)), 2)):
        with pytest.raises(ValueError, match="prefix"):
            selection.prefix(bad, "path", "i", n)


def test_planning_parsers():
    assert planning.names(" a, b,,a") == ["a", "b"] and planning.pairs("a:b,c:d") == [("a", "b"), ("c", "d")] and planning.quotas(["x=2"]) == {"x": 2}
    assert planning.whole(" 7 ", "n") == 7 and planning.flag("Yes", "f") is True and planning.first_option(None, 0, 1) == 0
    for f in (lambda: planning.whole(True, "n"), lambda: planning.whole("1.5", "n"), lambda: planning.whole(-1, "n"), lambda: planning.pairs("a"), lambda: planning.quotas("x"), lambda: planning.flag("maybe", "f"), lambda: planning.targets(1, 2), lambda: planning.targets(None, 9, 3), lambda: planning.epoch("\n"), lambda: planning.filled("{language}", ["a"], "b"), lambda: planning.config('{"datasets": []}'), lambda: planning.config('{"datasets": [{"name": "a", "patterns": "x", "source": "ftp"}]}')):
        with pytest.raises(ValueError):
            f()
    assert planning.targets(None, None) == {"per_cell": 25} and planning.epoch("e1") == "e1" and planning.filled("{language}/{split}/x", [], None) == "*/*/x"
    assert planning.coerced(None) == [] and planning.coerced(["a", " ", {"text": "b"}, None]) == ["a", "b"] and planning.coerced("x") == ["x"]
    assert [planning.human_bytes(x) for x in (None, 5, 2048)] == ["-", "5 B", "2.0 KiB"] and [planning.human_seconds(x) for x in (5, 65, 3700, 90000)] == ["5s", "1m 05s", "1h 01m", "1d 01h"]
    assert planning.bar(1, 2, 4) == "##.." and planning.human_rate(10, 2) == "5.0/s"
    done, failed = planning.matrix(lambda d, lang: 1 / len(lang), ["d"], ["", "x"], skip_errors=True)
    assert done == {("d", "x"): 1.0} and list(failed) == [("d", "")]
    with pytest.raises(ZeroDivisionError):
        planning.matrix(lambda d, lang: 1 / len(lang), ["d"], [""])
    assert licenses.scan_identity("a", x=1) == licenses.scan_identity("a", x=1) != licenses.scan_identity("a", x=2)


def test_plans_listings_and_publish(spark, tmp_path):
    df = spark.range(3).withColumnRenamed("id", "x")
    planning.write_plan(df, str(tmp_path / "p"), {"a": 1})
    assert planning.read_plan(spark, str(tmp_path / "p"), {"a": 1}).count() == 3
    with pytest.raises(ValueError, match="other settings"):
        planning.read_plan(spark, str(tmp_path / "p"), {"a": 2})
    made = []
    for _ in range(2):
        assert planning.cached_listing(spark, str(tmp_path / "l"), lambda: made.append(1) or df, "k").count() == 3
    assert made == [1]
    target = str(tmp_path / "out")
    for n in (3, 2):
        sinks.publish(df.limit(n), target, lambda t: t.where("x < 0"))
        assert spark.read.parquet(target).count() == n
    with pytest.raises(ValueError, match="verification"):
        sinks.publish(df, target, lambda t: t)
    assert spark.read.parquet(target).count() == 2 and not (tmp_path / "out.lock").exists()
    (tmp_path / "out.lock").touch()
    with pytest.raises(ValueError, match="another run"):
        sinks.publish(df, target, lambda t: t.where("x < 0"))


def test_mirror_tree(spark, tmp_path):
    rows = spark.createDataFrame([("a", "en", 1), ("b", "de", 2)], "dataset string, language string, v int")
    for r in rows.collect():
        rows.where(F.col("v") == r.v).write.parquet(str(tmp_path / "in" / r.dataset / r.language))
    sinks.mirror(spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "in")), str(tmp_path / "in"), str(tmp_path / "out"), {"score": F.col("v") * 2.0})
    got = spark.read.parquet(str(tmp_path / "out" / "a" / "en")).collect()
    assert [(r.v, r.score) for r in got] == [(1, 2.0)] and (tmp_path / "out" / "b" / "de").exists()


def test_log_times(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05,678 start",), ("no time",)], "l string").select(events.log_time(F.col("l")).alias("t")).collect()
    assert df[0].t.microsecond == 678000 and df[1].t is None


@pytest.fixture(scope="module")
def comments(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("cli")
    rows = [("d", f"r{i}", t, ["en", "de"][i % 2], f"p{i}.py", f"repo{i}", "", "{}", s) for i, (t, s) in enumerate([("released under the mit license", 98.0), ("this may not be redistributed by anyone", 0.0), ("plain words about a cache of pages", 0.0), ("strictly confidential and proprietary text", 10.0)] * 3)]
    cols = "dataset string, record_id string, opening_comment string, language string, path string, repo string, extracted_at string, metadata string, comment_license_score double"
    spark.createDataFrame(rows, cols).write.parquet(str(root / "comments"))
    spark.createDataFrame([("# a head note\nx = 1\n", "python", "a.py", "r")], "content string, language string, path string, repo string").write.parquet(str(root / "src"))
    spark.createDataFrame([("c1", "# of a shard\ny = 2\n", [1, 2])], "content_id string, content string, repo_ids array<long>").write.parquet(str(root / "shard"))
    (root / "list.txt").write_text("x/en/a.parquet\nx/de/b.parquet\nx/en/c.parquet\n")
    (root / "conf.json").write_text(json.dumps({"datasets": [{"name": "d", "patterns": "src"}]}))
    (root / "bad.json").write_text("{}")
    return root


def test_every_command(spark, comments, capsys):
    root = str(comments)
    ran = set()

    def run(code, name, *args):
        ran.add(name)
        got = cli.main([name, *[str(a) for a in args]])
        out = capsys.readouterr()
        assert got == code, (name, out)
        return out.out

    table = f"{root}/comments"
    assert "1 datasets" in run(0, "validate-config", "--config", f"{root}/conf.json")
    run(2, "validate-config", "--config", f"{root}/bad.json")
    assert '"start_row": 10' in run(0, "dump-config", "--config", f"{root}/conf.json")
    assert run(0, "list-languages", "--listing", f"{root}/list.txt").count("language") == 2
    assert run(0, "plan-download", "--listing", f"{root}/list.txt", "--include", "*/en/*").count("path") == 2
    run(2, "plan-download", "--listing", f"{root}/list.txt", "--count", 2, "--index", 2)
    part = next((comments / "src").glob("*.parquet")).name
    (comments / "one.txt").write_text(f"src/{part}\n")
    run(0, "download", "--listing", f"{root}/one.txt", "--root", root, "--output", f"{root}/copy")
    assert (comments / "copy" / "src" / part).exists()
    run(0, "mine-dataset", "--input", f"{root}/src", "--output", f"{root}/mined")
    assert [r.opening_comment for r in spark.read.parquet(f"{root}/mined").collect()] == ["# a head note"]
    run(0, "mine-config", "--config", f"{root}/conf.json", "--root", root, "--output", f"{root}/by-config")
    run(0, "mine-stack-v2-packages", "--input", f"{root}/src", "--output", f"{root}/packages", "--package-rows", 1, "--package", 0)
    run(0, "mine-stack-v3-shards", "--input", f"{root}/shard", "--output", f"{root}/shards")
    run(0, "scan-hf-comment-licenses", "--input", table, "--output", f"{root}/scored")
    assert spark.read.parquet(f"{root}/scored").where("comment_license_score >= 95").count() == 3
    run(0, "prewarm-hf-license-cache", "--input", table, "--output", f"{root}/memo")
    assert spark.read.parquet(f"{root}/memo").count() == 4
    assert "#" in run(0, "license-score-histogram", "--input", table, "--languages", "en")
    run(2, "license-score-histogram", "--input", table, "--low", 5, "--high", 5)
    run(0, "topic-model-low-scancode", "--input", table, "--output", f"{root}/topics", "--topics", '{"cache": ["cache"]}')
    run(0, "build-redistribution-candidate-dataset", "--input", table, "--output", f"{root}/found")
    assert spark.read.parquet(f"{root}/found").count() == 6
    run(0, "verify-redistribution-candidate-dataset", "--input", f"{root}/found", "--source", table)
    run(1, "verify-redistribution-candidate-dataset", "--input", f"{root}/found", "--source", f"{root}/mined")
    run(0, "build-classifier-dataset", "--input", table, "--output", f"{root}/classes")
    run(0, "verify-classifier-dataset", "--input", f"{root}/classes")
    run(0, "benchmark-encoding-capacity", "--input", table, "--start", 4)
    run(0, "export-hf-dataset", "--input", table, "--output", f"{root}/export", "--dedupe", "global")
    run(2, "export-hf-dataset", "--input", table, "--output", f"{root}/export2", "--dedupe", "global", "--workers", 2)
    assert ran == set(cli.COMMANDS)
