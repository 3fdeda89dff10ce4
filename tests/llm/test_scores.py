"""LM scoring, quality and token counts against brute force."""

import math
import random
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import lm_scoring, quality, queries, token_edits
from corpusloom.llm.common import read

DOCS = [(0, "the cat sat on the mat"), (1, "The dog\tsat"), (2, None), (3, ""), (4, "zebra cat éa"), (5, "the cat the cat"), (None, "mat mat"), (0, "the cat sat on the mat")]
SCHEMA = "doc_id long, text string"


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def brute_lm(rows, train, pieces, discount=0.6):
    counts = Counter(w for (_, t), k in zip(rows, train, strict=True) if k for w in words(t))
    ends = sum(train)
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    logp, stop = lm_scoring.fit_pieces(pieces, greedy(counts, pieces))
    weight = dict(zip(pieces, logp, strict=True))

    @lru_cache(None)
    def paths(w):
        return 1.0 if not w else sum(math.exp(weight[w[:k]]) * paths(w[k:]) for k in range(1, len(w) + 1) if w[:k] in weight)

    out = []
    for _, t in rows:
        base = math.log10((ends + 1) / (n + v + 1))
        score = math.log10(max(ends - discount, 0.5) / n)
        for w in words(t):
            base += math.log10((counts[w] + 1) / (n + v + 1))
            score += math.log10(max(counts[w] - discount, 0) / n + discount * v / n * math.exp(stop) * paths(b" " + w))
        out.append((len(words(t)) + 1, sum(counts[w] > 0 for w in words(t)) + 1, n, base, score))
    return out


def greedy(counts, pieces):
    index, n = {p: i for i, p in enumerate(pieces)}, np.zeros(len(pieces) + 1)
    for w in counts:
        w, at = b" " + w, 0
        while at < len(w):
            k = next((k for k in range(len(w) - at, 0, -1) if w[at : at + k] in index), 1)
            if w[at : at + k] in index:
                n[index[w[at : at + k]]] += 1
            at += k
        n[-1] += 1
    return n


@pytest.mark.parametrize("heavy", [1, 1 << 18])
def test_lattice_equals_all_segmentations(spark, heavy):
    pieces = [bytes([c]) for c in range(33, 256)] + [b" ", b" the", b" ca", b"at", b" c", b"t", b" d", b"og", b"he"]
    pieces = list(dict.fromkeys(pieces))
    train = [i % 3 != 1 for i in range(len(DOCS))]
    df = spark.createDataFrame([(*r, t) for r, t in zip(DOCS, train, strict=True)], SCHEMA + ", train boolean")
    got = lm_scoring.score(df, pieces, "train", heavy=heavy, discount=0.6).toPandas()
    want = brute_lm(DOCS, train, pieces)
    a = sorted(zip(got.n_tokens, got.n_known, got.train_tokens, got.base_score.round(6), got.score.round(6), strict=True))
    b = sorted((x, k, n, round(s, 6), round(t, 6)) for x, k, n, s, t in want)
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert x == pytest.approx(y, abs=2e-6)


def test_lattice_sums_to_one_at_most():
    pieces = [b" ", b" a", b" ab", b"a", b"b"]
    logp, stop = lm_scoring.fit_pieces(pieces, np.array([3.0, 2, 1, 5, 4, 6]))
    lat = lm_scoring.Lattice(pieces, logp)
    level, total = [b" "], 0.0
    for _ in range(9):
        total += np.exp(lat.logprob(level) + stop).sum()
        level = [w + c for w in level for c in (b"a", b"b")]
    assert 0.5 < total <= 1 + 1e-9


def test_lm_query_covers_all_documents(spark, small):
    got = queries.op1_subword_lattice(spark, small).toPandas()
    docs = read(spark, small, "documents").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    assert dict(zip(got.doc_id, got.held_out, strict=True)) == {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs.doc_id}
    assert (got.score < 0).all() and (got.n_known <= got.n_tokens).all()


def test_lm_prefers_text_to_scrambled_text(spark, small):
    docs = read(spark, small, "documents").select("doc_id", "text", (F.pmod(queries.crc_of_id(), F.lit(7)) != 2).alias("train"))
    held = docs.where("not train and text is not null")
    upset = held.select((F.col("doc_id") + 1_000_000).alias("doc_id"), F.reverse("text").alias("text"), "train")
    got = lm_scoring.score(docs.union(upset), lm_scoring.read_pieces(queries.PIECES), "train").toPandas()
    got = got[~got.train]
    assert got[got.doc_id < 1_000_000].score.sum() > 0.8 * got[got.doc_id >= 1_000_000].score.sum()


def test_lm_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA + ", train boolean")
    assert lm_scoring.score(df, [b" a", b"b"], "train").count() == 0


def test_quality_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    got = queries.op2_quality(spark, d).toPandas().merge(read(spark, d, "labels").toPandas(), on="doc_id")
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    held = got[got.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.85


def test_quality_scores_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "x " * 200_000, "c")], "doc_id long, text string, x string")
    labels = spark.createDataFrame([(1, 1), (2, None), (2, 3), (None, 0)], "doc_id long, quality int")
    got = quality.score_documents(docs, labels).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert quality.score_documents(docs.limit(0), labels).count() == 0
    none = quality.score_documents(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


@pytest.mark.parametrize("n", [1, 2, 15, 16, 40])
def test_discriminant_uses_few_rows(n):
    rng = np.random.default_rng(n)
    d = len(quality.NAMES)
    a, b = rng.normal(0, 1, (n, d)), rng.normal(4, 1, (60, d))
    m = quality.Discriminant(np.array([n, 60.0]), np.stack([a.sum(0), b.sum(0)]), np.stack([a.T @ a, b.T @ b]))
    assert m.ready and (m.score(a) < 0.5).all() and (m.score(b) > 0.5).mean() > 0.9


def test_discriminant_is_the_density_ratio():
    rng = np.random.default_rng(1)
    d = len(quality.NAMES)
    a, b = rng.normal(0, 1, (400, d)), rng.normal(0.5, 1.5, (300, d))
    n = np.array([len(a), len(b)], float)
    s = np.stack([a.sum(0), b.sum(0)])
    ss = np.stack([a.T @ a, b.T @ b])
    m = quality.Discriminant(n, s, ss)
    x = np.concatenate([a[:20], b[:20]])
    cov = [np.cov(z.T, bias=True) for z in (a, b)]
    pooled = (400 * cov[0] + 300 * cov[1]) / 700
    z = np.full(40, math.log(301 / 401))
    for k, sign in ((0, -1), (1, 1)):
        c = 0.85 * cov[k] + 0.15 * pooled
        c = 0.9 * c + 0.1 * np.diag(np.diag(c)) + 1e-3 * np.diag(np.diag(pooled)) + 1e-9 * np.eye(d)
        y = x - (a, b)[k].mean(0)
        z += sign * -0.5 * (np.einsum("ij,jk,ik->i", y, np.linalg.inv(c), y) + np.linalg.slogdet(c)[1])
    assert np.allclose(m.score(x), 1 / (1 + np.exp(-z)))


def test_token_counts_after_random_edits():
    counter = token_edits.Counter(open(queries.RANKS, "rb").read())
    rng = random.Random(3)
    chars = "abc XYZ  12\n\t'll.,é漢 "
    for size in (0, 1, 5, 300, 4000):
        text = "".join(rng.choice(chars) for _ in range(size))
        tree = token_edits.Tree(text, counter)
        assert tree.total == counter.whole(text)
        for _ in range(25):
            a, n = rng.randrange(-2, len(text) + 3), rng.choice([0, 1, 3, 40])
            new = "".join(rng.choice(chars) for _ in range(rng.choice([0, 1, 2, 30, 700])))
            lo = max(0, min(a, len(text)))
            text = text[:lo] + new + text[max(lo, min(lo + n, len(text))) :]
            assert tree.edit(a, n, new) == counter.whole(text) == tree.total
            assert tree.text == text


def test_edits_re_encode_little():
    counter = token_edits.Counter(open(queries.RANKS, "rb").read())
    tree = token_edits.Tree("plain words here. " * 5000, counter)
    tree.edit(45_000, 3, "new")
    assert tree.reencoded < 50


def test_token_query_and_odd_rows(spark, small):
    got = queries.op9_edit_counts(spark, small).toPandas()
    docs = read(spark, small, "documents").toPandas()
    counter = token_edits.Counter(open(queries.RANKS, "rb").read())
    want = {}
    for r in docs.itertuples():
        t = r.text or ""
        n = len(t)
        u = t[: n // 3] + t[n // 3 + 7 :]
        u = u[: n // 2] + " added " + (r.lang or "") + u[n // 2 :]
        at = min(max(n - 20, 0), len(u))
        u = u[:at] + "'ll 42%" + u[at + 5 :]
        want[r.doc_id] = (counter.whole(t), counter.whole(u))
    assert {r.doc_id: (r.n_tokens, r.n_tokens_edited) for r in got.itertuples()} == want
    kind = "doc_id long, text string, edits array<struct<start:int,length:int,text:string>>, n_tokens int"
    odd = spark.createDataFrame([(1, None, None, 1), (1, None, None, 1), (None, "a b", [(9, 9, None), None], 2)], kind)
    assert sorted((r.n_tokens, r.n_edits, r.n_tokens_edited) for r in token_edits.count_edits(odd, queries.RANKS).collect()) == [(0, 0, 0), (0, 0, 0), (2, 1, 2)]
    assert token_edits.count_edits(odd, queries.RANKS).count() == 3
    assert token_edits.count_edits(odd.where(F.lit(False)), queries.RANKS).count() == 0
