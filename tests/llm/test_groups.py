"""SimHash groups, sharding, packing and the pipeline against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

import corpus_pipeline
from corpusloom.llm import near, packing, quality, queries, sharding, simhash
from corpusloom.llm.common import read

from .test_text_ops import brute_dedup, brute_hits


def brute_print(text, width=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    hs = [xxh64_intdigest(" ".join(w[i : i + width]).encode(), 42) for i in range(max(len(w) - width + 1, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(rows, radius=4):
    """{id: smallest reachable id} by all pairs."""
    f = np.array([p for _, p in rows], np.uint64)
    lead = list(range(len(rows)))

    def root(i):
        while lead[i] != i:
            lead[i] = lead[lead[i]]
            i = lead[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= radius):
            a, b = root(i), root(int(j))
            lead[max(a, b)] = min(a, b)
    low = defaultdict(lambda: 1 << 62)
    for i, (d, _) in enumerate(rows):
        low[root(i)] = min(low[root(i)], d)
    return {d: low[root(i)] for i, (d, _) in enumerate(rows)}


def brute_near(rows, width=5):
    """{id: smallest reachable id} over all pairs of texts whose shingle sets have a Jaccard likeness of 0.8 or more."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set())
    of = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if of[i] != of[j] and (a == b or 5 * len(a & b) >= 4 * len(a | b)):
            of = [of[i] if x == of[j] else x for x in of]
    low = defaultdict(lambda: 1 << 62)
    for (d, _), c in zip(rows, of, strict=True):
        low[c] = min(low[c], d)
    return {d: low[c] for (d, _), c in zip(rows, of, strict=True)}


def planted(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        base = rng.getrandbits(64)
        out.append(base)
        for _ in range(rng.choice([0, 0, 1, 3])):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.choice([0, 2, 4, 5, 6])))
            out.append(base)
    hot = rng.getrandbits(64)
    out += [hot ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3]))) for _ in range(n)]
    return list(enumerate(out))


@pytest.mark.parametrize(("leaf", "cell"), [(3000, 6000), (20, 40)])
def test_groups_equal_all_pairs(spark, monkeypatch, leaf, cell):
    monkeypatch.setattr(simhash.link_edges, "__defaults__", (leaf, cell))
    rows = planted(400, leaf)
    df = spark.createDataFrame([(d, p - (1 << 64) if p >> 63 else p) for d, p in rows], "doc_id long, fp long").repartition(3)
    got = {r.doc_id: r.component_id for r in simhash.groups(df).collect()}
    assert got == brute_groups(rows)


def test_hubs_joined_by_one_bridge_stay_together(spark, monkeypatch):
    monkeypatch.setattr(simhash.link_edges, "__defaults__", (3000, 40))
    rng = random.Random(3)
    a = rng.getrandbits(64)
    apart = rng.sample(range(64), 8)
    flip = lambda f, bits: f ^ sum(1 << b for b in bits)
    rest = [b for b in range(64) if b not in apart]
    near = [rng.sample(rest, 2) for _ in range(200)]
    b, bridge = flip(a, apart), flip(a, apart[:4])
    prints = list(dict.fromkeys([a, b, bridge] + [flip(a, x) for x in near[:100]] + [flip(b, x) for x in near[100:]]))
    rows = list(enumerate(prints))
    assert set(brute_groups(rows).values()) == {0}
    df = spark.createDataFrame([(d, p - (1 << 64) if p >> 63 else p) for d, p in rows], "doc_id long, fp long").repartition(3)
    assert {r.doc_id: r.component_id for r in simhash.groups(df).collect()} == brute_groups(rows)


def test_simhash_query(spark, small):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op4_simhash(spark, small).collect()}
    rows = [(r.doc_id, brute_print(r.text)) for r in read(spark, small, "documents").collect()]
    want = brute_groups(rows)
    assert got == {d: (f"{p:016x}", want[d]) for d, p in rows}
    assert len(set(want.values())) < len(want)


def test_simhash_of_odd_rows(spark):
    df = spark.createDataFrame([(4, None, 0), (2, "", 1), (3, " \n", 2), (9, "one two", 3), (8, "One  TWO", 4), (8, "One  TWO", 5), (7, "z " * 100_000, 6)], "doc_id long, text string, fp int")
    got = simhash.groups(simhash.fingerprints(df)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(2, 2), (3, 2), (4, 2), (7, 7), (8, 8), (8, 8), (9, 8)]
    kept = near.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 7, 8, 8]
    assert simhash.groups(simhash.fingerprints(df.limit(0))).count() == 0


def near_copies(seed):
    """Texts of few and many words, copies with some words changed about the limit of 0.8, and passages many texts share."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    shared = [[word() for _ in range(30)] for _ in range(3)]
    texts = []
    for _ in range(60):
        base = [word() for _ in range(rng.choice([1, 4, 5, 6, 9, 30, 120, 400]))] + rng.choice([[], *shared])
        texts.append(base)
        for _ in range(rng.choice([0, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, max(1, len(copy) // 60), max(1, len(copy) // 45), max(1, len(copy) // 25)])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(copy if rng.random() < 0.8 else copy + shared[0][: rng.randrange(20)])
    texts += [shared[0] + shared[1] + [word() for _ in range(k % 4)] for k in range(12)] + [[], []]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("seed", "drawn"), [(1, 8192), (2, 0)])
def test_keep_one_equals_all_pairs(spark, monkeypatch, seed, drawn):
    monkeypatch.setattr(near, "DRAWN", drawn)  # the order never decides what is found
    rows = near_copies(seed)
    want = set(brute_near(rows).values())
    assert 60 <= len(want) < len(rows)
    got = near.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {r.doc_id for r in got.collect()} == want


def test_listed_stays_bounded(spark, monkeypatch):
    monkeypatch.setattr(near, "LISTED", 4)
    df = spark.createDataFrame([(i, "a b c d e f g" + " z y x w v u" * (i % 2)) for i in range(12)], "doc_id long, text string")
    h, n = near.listed(df, 5)
    assert len(h) == 3 and set(n.tolist()) == {12}


def test_keep_one_decides_by_row(spark):
    words = lambda c: " ".join(f"{c}{i}" for i in range(30))
    rows = [(1, words("a")), (2, words("a")), (2, words("b")), (None, words("a")), (None, words("c"))]
    got = near.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.text[:2]) for r in got} == {(1, "a0"), (2, "b0"), (None, "c0")} and len(got) == 3


def held_to_law(rows, shards=8):
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(sizes) <= set(range(shards))
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    total, most = sum(sizes.values()), max((r.size for r in rows), default=0)
    assert all(abs(sizes[k] - total / shards) <= 2 * most for k in range(shards))


def test_shards(spark, small):
    rows = queries.op3_splitters(spark, small).collect()
    docs = {r.doc_id: r.text for r in read(spark, small, "documents").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "bytes")
    held_to_law(rows)
    first = defaultdict(list)
    for r in rows:
        first[r.shard].append(r.doc_id)
    assert all(max(first[k]) < min(first[k + 1]) for k in range(7) if first[k] and first[k + 1])  # ranges of the key


@pytest.mark.parametrize("ranges", [4, 64])
def test_shards_with_a_hot_key(spark, ranges):
    rng = random.Random(2)
    data = [(7 if i % 3 else rng.randrange(1000) if i % 7 else None, rng.choice([1, 5, 400]), "x") for i in range(3000)]
    df = spark.createDataFrame(data, "k long, size long, shard string").withColumns({c: F.lit(5) for c in ("key", "uid", "range", "pos", "rank", "_key", "_uid")}).repartition(5)
    rows = sharding.shard(df, F.col("k"), F.col("size"), 8, ranges).collect()
    assert len(rows) == 3000 and {(r["key"], r["uid"], r["pos"], r["_uid"]) for r in rows} == {(5, 5, 5, 5)}
    held_to_law(rows)
    assert sharding.shard(df.limit(0), F.col("k"), F.col("size"), 8).count() == 0


def test_bucket_boundaries_are_optimal():
    rng = random.Random(4)
    for _ in range(30):
        x = sorted(rng.sample(range(60), rng.randrange(1, 9)))
        c = [rng.randrange(1, 20) for _ in x]
        k = rng.randrange(1, 5)

        def padding(cuts, x=x, c=c):
            return sum(n * (min(b for b in cuts if b >= v) - v) for v, n in zip(x, c, strict=True))

        best = min(padding((*s, x[-1])) for m in range(min(k, len(x))) for s in itertools.combinations(x[:-1], m))
        got = packing.boundaries(np.array(x), np.array(c), k)
        assert len(got) <= k and padding(got) == best


def held_to_budget(rows, budget):
    batches = defaultdict(list)
    for r in rows:
        assert r.n_tokens <= r.padded_to and r.padding == r.padded_to - r.n_tokens
        batches[r.bucket, r.batch].append(r)
    buckets = defaultdict(set)
    for (b, k), rs in batches.items():
        assert sorted(r.place for r in rs) == list(range(len(rs)))
        assert len(rs) * rs[0].padded_to <= budget or len(rs) == 1
        buckets[b].add(k)
    for ks in buckets.values():
        assert ks == set(range(len(ks)))
    for b, ks in buckets.items():  # all but the last batch of a bucket are full
        assert len({len(batches[b, k]) for k in ks if k != max(ks)}) <= 1


def test_packing(spark, small):
    rows = queries.op5_length_buckets(spark, small).collect()
    docs = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in read(spark, small, "documents").collect()}
    assert {r.doc_id: r.n_tokens for r in rows} == docs
    held_to_budget(rows, 16_384)
    n = np.unique(list(docs.values()), return_counts=True)
    assert sorted({r.padded_to for r in rows}) == packing.boundaries(*n, 8)


def test_packing_of_odd_rows(spark):
    df = spark.createDataFrame([(None, None, 1), (1, "", 1), (1, "", 1), (2, "w " * 70_000, 1)] + [(i, "same length here", 1) for i in range(500)], "doc_id long, text string, bucket int")
    rows = packing.pack(df.select("doc_id", "bucket", packing.n_words().alias("n")), F.col("n"), 3, 1000).collect()
    assert len(rows) == 504
    held_to_budget(rows, 1000)
    assert [r.over_budget for r in rows if r.n_tokens == 70_000] == [True]
    assert packing.pack(df.limit(0).select("doc_id", F.lit(1).alias("n")), F.col("n")).count() == 0


def test_packing_of_long_texts_is_exact(spark):
    lens = [3, 40_001, 32_768, 32_769, 50_003, 90_001, 90_002]
    df = spark.createDataFrame([(i, n, 7, 8) for i, n in enumerate(lens) for _ in range(i + 1)], "doc_id long, n long, pack_part int, _len int")
    rows = packing.pack(df, F.col("n"), 3, 100_000).collect()
    assert sorted({r.padded_to for r in rows}) == packing.boundaries(np.array(lens), np.arange(1, 8), 3)
    assert {(r.pack_part, r._len) for r in rows} == {(7, 8)}
    held_to_budget(rows, 100_000)


def text_rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_pipeline_stages_equal_brute_force(spark, small):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "simhash", "decontamination", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    docs = read(spark, small, "documents")
    a = stage["quality"](spark, docs, small).cache()
    score = {r.doc_id: r.score for r in quality.score_documents(docs, read(spark, small, "labels")).collect()}
    assert {d for d, _ in text_rows(a)} == {d for d, s in score.items() if s >= 0.5}
    b = stage["line_dedup"](spark, a, small).cache()
    want = {d: kept for (d, t), (_, kept) in brute_dedup(text_rows(a)).items() if kept == t or kept.strip()}
    assert dict(text_rows(b)) == want
    c = stage["simhash"](spark, b, small).cache()
    assert {d for d, _ in text_rows(c)} == set(brute_near(text_rows(b)).values())
    e = stage["decontamination"](spark, c, small).cache()
    hits = brute_hits(text_rows(c), [tuple(r) for r in read(spark, small, "benchmark").select("item_id", "text").collect()])
    assert {d for d, _ in text_rows(e)} == {h[0] for h in hits if h[2] == 0}
    assert docs.columns == a.columns == b.columns == c.columns == e.columns
    out = stage["packing"](spark, e, small).collect()
    assert {r.doc_id for r in out} == {d for d, _ in text_rows(e)}
    held_to_budget(out, 16_384)
    assert {(r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, small).collect()} == {(r.doc_id, r.n_tokens) for r in out}


def test_pipeline_stages_on_odd_tables(spark, small):
    docs = read(spark, small, "documents")
    extra = docs.limit(20).withColumns({k: F.lit(1) for k in ("_d", "_uid", "_len", "_drop", "gone_d", "rest", "pack_part", "h", "d", "th", "drop", "comp", "fp", "leaf", "x", "y", "n", "key", "rep", "label", "batch")})
    nulls = extra.limit(3).select(*[F.lit(None).cast(t).alias(c) for c, t in extra.dtypes])
    for start in (extra.limit(0), extra.union(nulls).union(extra.limit(5))):
        out = start
        for name, f in corpus_pipeline.STAGES:
            out = f(spark, out, small)
            if name != "packing":
                assert out.columns == start.columns
        out.collect()
