"""Operators on small tables against brute force."""

import itertools
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import comments, fuzzy
from corpusloom.functions import text as X
from corpusloom.operators import allocate, graph, relational
from corpusloom.plans import queries


def fair(capacity, total):
    """Max-min shares, one unit at a time to the lowest share, names in order."""
    share = dict.fromkeys(capacity, 0)
    for _ in range(total):
        name = min((n for n in capacity if share[n] < capacity[n]), key=lambda n: (share[n], n))
        share[name] += 1
    return share


@pytest.mark.parametrize("seed", range(4))
def test_water_fill(spark, seed):
    rng = random.Random(seed)
    capacity = {f"n{i}": rng.randrange(1, 30) for i in range(rng.randrange(1, 8))}
    total = rng.randrange(len(capacity), sum(capacity.values()) + 1)
    df = spark.createDataFrame(list(capacity.items()), "name string, c long")
    assert {r.name: r.quota for r in allocate.water_fill(df, "name", "c", total).collect()} == fair(capacity, total)
    with pytest.raises(ValueError):
        allocate.water_fill(df, "name", "c", sum(capacity.values()) + 1)


@pytest.mark.parametrize("least", [0.8, 0.82, 1.0])
def test_similar_pairs(spark, least):
    rng = random.Random(int(least * 100))
    sets = {i: set(rng.sample(range(40), rng.randrange(1, 15))) for i in range(40)}
    for i in range(40, 60):
        base = list(sets[i - 40])
        sets[i] = set(base[: rng.randrange(max(1, len(base) - 2), len(base) + 1)]) | ({rng.randrange(40)} if i % 2 else set())
    df = spark.createDataFrame([(i, [str(x) for x in s]) for i, s in sets.items()], "id long, s array<string>")
    first = {}
    for i, s in sorted(sets.items()):
        first.setdefault(frozenset(s), i)
    want = {(a, b): len(sets[a] & sets[b]) for a, b in itertools.combinations(sorted(first.values()), 2) if len(sets[a] & sets[b]) >= least * min(len(sets[a]), len(sets[b])) - 1e-9}
    assert {(r.a, r.b): r.overlap for r in graph.similar_pairs(df, "id", "s", least).collect()} == want
    assert {r.id: r.class_id for r in graph.members(df, "id", "s").collect()} == {i: first[frozenset(s)] for i, s in sets.items()}


def test_similar_pairs_keeps_its_result_only(spark):
    sets = [(i, [f"{i // 2} {k}" for k in range(40)] + [f"own {i} {k}" for k in range(5)]) for i in range(200)]
    folder = Path(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    before = {p.parent for p in folder.rglob("part-*")}
    got = graph.similar_pairs(spark.createDataFrame(sets, "id long, s array<string>"), "id", "s", 0.8)
    assert {(r.a, r.b, r.overlap) for r in got.collect()} == {(i, i + 1, 40) for i in range(0, 200, 2)}
    left = {p.parent for p in folder.rglob("part-*")} - before
    assert len(left) == 1 and sum(p.stat().st_size for p in left.pop().glob("part-*")) < 20_000


def shuffled(spark):
    """MB that all stages so far have written for shuffles."""
    sc, gateway = spark.sparkContext._jsc.sc(), spark.sparkContext._gateway
    sc.listenerBus().waitUntilEmpty()
    stages = sc.statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size())) / 1e6


def test_similar_pairs_send_sets_to_few_places(spark, monkeypatch, tmp_path):
    near = "transform(sequence(0, 5999), i -> if(i % 40 = id % 100 and i < 400, xxhash64(id % 100, i), xxhash64(cast(i as bigint))))"
    few = "transform(sequence(0, 9), i -> xxhash64(i + 1000 * (id - 200)))"
    ids = spark.createDataFrame([(i,) for i in (*range(40), 100, 101, 102, 200, 201, 202)], "id long")  # near copies, copies, small sets
    ids.selectExpr("id", f"if(id < 200, {near}, {few}) as s").write.parquet(f"{tmp_path}/sets")
    df = spark.read.parquet(f"{tmp_path}/sets")
    want = {(a, b): 5980 for a, b in itertools.combinations(range(40), 2)} | {(i, 200 + k): 10 if k or i > 9 else 9 for i in range(40) for k in range(3)}
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        before = shuffled(spark)
        got = {(r.a, r.b): r.overlap for r in graph.similar_pairs(df, "id", "s", 0.82).collect()}
        assert got == want
        assert (mb := shuffled(spark) - before) < 25, mb
        for cell in (1, 20_000):  # a cell for each set; some cells for a group
            monkeypatch.setattr(graph, "CELL", cell)
            assert {(r.a, r.b): r.overlap for r in graph.similar_pairs(df.where("id < 12 or id > 99"), "id", "s", 0.82).collect()} == {k: n for k, n in want.items() if k[0] < 12 and (k[1] < 12 or k[1] > 99)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


def test_classes_build_their_sets_once(spark, small):
    plan = queries.neardup_classes(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(500, 400)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 140)} | {400: 400, 500: 400}


def test_global_ordinals(spark):
    ids = random.Random(1).sample(range(10_000), 500)
    got = relational.global_ordinals(spark.createDataFrame([(i,) for i in ids], "k long"), "k", 7).collect()
    assert [r.k for r in sorted(got, key=lambda r: r.ordinal)] == sorted(ids)
    assert sorted(r.ordinal for r in got) == list(range(500))


def test_histogram_edges(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 4.999, 5.0, 100.0, 100.1, -0.1, float("nan"), float("inf"), None)], "s double")
    got = {r.bin: r.n for r in relational.histogram(df, "s", 20, 0, 100).collect()}
    assert got == {i: 0 for i in range(20)} | {0: 2, 1: 1, 19: 1}
    r = relational.histogram_stats(df, "s", 0, 100).first()
    assert (r.records, r.scores, r.missing, r.invalid, r.outside) == (9, 6, 1, 2, 2)


def test_matching_needs_alternating_paths():
    links = {i: [i, i + 1] for i in range(500)} | {500: [0]}
    got = allocate.match_pairs(links, list(links))
    assert len(got) == 501 and len(set(got.values())) == 501


def test_flow_takes_scarce_labels_first():
    rows = [("common", "a", f"h{i}", 10 - i) for i in range(5)] + [("rare", "a", "h0", 1)]
    got = allocate.allocate_labels(rows, {"common": 4, "rare": 1}, {("common", "a"): 5, ("rare", "a"): 1})
    assert ("rare", "a", "h0") in got and len(got) == 5 and len({h for *_, h in got}) == 5


def test_opening_comments():
    source = "#!/bin/sh\n# one\n# two\n\n\n# three\ncode\n# other\n"
    assert [(c["text"], c["start_line"]) for c in comments.opening(source, "shell")] == [("# one\n# two\n\n\n# three", 2), ("# other", 8)]
    assert comments.opening('s = "// no"; // yes', "java")[0]["text"] == "// yes"
    far = "\n" * 10 + "// too late"
    assert comments.opening(far, "java") == [] and comments.opening(far[1:], "java") != []
    assert comments.opening("/* a /* b */ c */ x", "rust")[0]["text"] == "/* a /* b */ c */"
    assert comments.opening(None, "java") == [] and comments.opening("", None) == []


def test_blank_lines_between_comments():
    assert len(comments.opening("# a" + "\n" * 6 + "# b", "python")) == 1
    assert len(comments.opening("# a" + "\n" * 7 + "# b", "python")) == 2


def test_fuzzy_matches():
    m = fuzzy.PhraseSearch([("g", "may not be redistributed"), ("g", "funded by a government grant")])
    assert m.find("This MAY not be  redistributed at all.")[0]["score"] == 1.0
    assert m.find("it may not be ever redistributed")[0]["score"] >= 0.82
    assert m.find("nothing of that kind") == [] and m.find(None) == []


def test_scalar_functions(spark):
    df = spark.createDataFrame([("a.B.TXT", "22M", " x\r\ny "), ("dir.d/none", "0.6B", ""), (".rc", "9", None)], "p string, n string, t string")
    got = df.select(X.extension(F.col("p")), X.parameter_count(F.col("n")), X.trimmed(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("txt", 22_000_000, "x\ny"), ("", 600_000_000, None), ("", None, None)]
