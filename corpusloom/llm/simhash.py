"""SimHash near-duplicates by vantage-point trees.

Whole 64-bit distances of unrelated fingerprints crowd around 32, where a
triangle bound of 4 prunes next to nothing.  So the fingerprint is cut into
``BLOCKS`` bit blocks: two fingerprints within ``radius`` bits are within
``radius // BLOCKS`` bits in one block at least, and one vantage-point tree per
block (Hamming distance in that block, itself a metric) with that small radius
finds every pair.  A node sends a fingerprint inside (d <= mu) or outside, and
those in the boundary ring (d > mu - r) to both, so each linked pair meets in a
leaf.  Trees come from a hash sample of about ``SAMPLE`` distinct fingerprints.

Equal fingerprints are one row.  Within a leaf, links are found by blocks of
bit counts and reported as a spanning forest, never as all pairs.  A leaf too
large for one task is cut into cells: fingerprints near one of the sampled
dense hubs already are linked through that hub, and hubs of one sampled
component through the sample's spanning links, so they need no comparison with
each other and are dealt over cells, while the others visit every cell
(pairwise cells if there are many).  Components come from alternating large and
small stars over written edge tables.

Cases: null and empty texts have fingerprint zero and link like any other;
fewer than ``width`` words make one shingle; repeated rows and ids keep their
rows; an empty table gives none; texts are read whole; ``groups`` and
``fingerprints`` return their own columns only.  A null doc_id never names a component unless all of its
members are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import bound_batches, chunks, discard, stored, text_bytes

BLOCKS, SAMPLE, LEAF, CELL = 3, 16_384, 3_000, 6_000
SIGN = 1 << 63


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """The hash of each word shingle of ``text`` in order, repeats included; fewer words make one, no words none."""
    words = text.lower().split()
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxh64_intdigest(joined, 42)] if words else [], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - width + 1].tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    return np.fromiter([xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)], np.uint64, len(starts))


def folded(h: np.ndarray) -> int:
    """The bits set in over half of the hashes; 0 for none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 4096):
        ones += np.unpackbits(h[at : at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "big")


def fingerprint(text: bytes, width: int = 4) -> int:
    """64-bit SimHash of the word shingles of ``text``, repeats included; 0 without words."""
    return folded(shingle_hashes(text, width))


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """doc_id and ``fp`` (the fingerprint as a signed long) of each row."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 1024):
            f = np.array([fingerprint(t, width) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(f)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), text_bytes().alias("t")).mapInArrow(run, "doc_id long, fp long")


def masks(blocks: int) -> list[np.uint64]:
    bits = np.array_split(np.arange(64), blocks)
    return [np.uint64(sum(1 << int(i) for i in b)) for b in bits]


def grow(sample: np.ndarray, mask: np.uint64, r: int, leaf: int, seed: int = 1, depth: int = 0):
    """A vantage-point tree over masked fingerprints: None for a leaf, else (vantage, mu, inside, outside)."""
    if len(sample) <= leaf or depth > 24:
        return None
    rng = np.random.default_rng(seed)
    best = None
    for v in rng.choice(sample, min(6, len(sample)), replace=False):
        d = np.bitwise_count((sample ^ v) & mask)
        n = np.bincount(d, minlength=66)
        below = np.cumsum(n)
        for mu in range(64):
            small = min(below[mu], len(sample) - below[mu])
            if small >= len(sample) * 0.15:
                ring = n[max(0, mu - r + 1) : mu + 1].sum()
                cost = ring + 0.3 * abs(len(sample) - 2 * below[mu])
                if best is None or cost < best[0]:
                    best = (cost, v, mu, d)
    if best is None:
        return None
    _, v, mu, d = best
    return (v, mu, grow(sample[d <= mu], mask, r, leaf, seed * 2, depth + 1), grow(sample[d > mu - r], mask, r, leaf, seed * 2 + 1, depth + 1))


def route(tree, f: np.ndarray, mask: np.uint64, r: int) -> list[np.ndarray]:
    """For each leaf, left to right, the positions in ``f`` that visit it."""
    out = []

    def down(node, idx: np.ndarray) -> None:
        if node is None:
            out.append(idx)
            return
        v, mu, inside, outside = node
        d = np.bitwise_count((f[idx] ^ v) & mask).astype(np.int64)
        down(inside, idx[d <= mu])
        down(outside, idx[d > mu - r])

    down(tree, np.arange(len(f)))
    return out


def forest(f: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Positions (a, b) of a spanning forest over all pairs of ``f`` within ``radius`` bits."""
    edges, left = [], np.arange(len(f))
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            some, front = front[:64], front[64:]
            near = np.bitwise_count(f[some][:, None] ^ f[left][None, :]) <= radius
            hit = near.any(0)
            if hit.any():
                who = some[near[:, hit].argmax(0)]
                edges += zip(who.tolist(), left[hit].tolist(), strict=True)
                front = np.concatenate([front, left[hit]])
                left = left[~hit]
    return edges


def local_links(f: np.ndarray, radius: int, mask: np.uint64, r: int, leaf: int = 2048, depth: int = 0) -> Iterator[tuple[int, int]]:
    """Spanning links among ``f`` in memory, by further vantage-point splits while they are large."""
    if len(f) > leaf and depth < 20:
        tree = grow(f, mask, r, max(leaf, len(f) // 2), seed=depth + 3)
        if tree is not None:
            for idx in route(tree, f, mask, r):
                if len(idx) < 0.9 * len(f):
                    for a, b in local_links(f[idx], radius, mask, r, leaf, depth + 1):
                        yield int(idx[a]), int(idx[b])
                else:
                    for a, b in forest(f[idx], radius):
                        yield int(idx[a]), int(idx[b])
            return
    yield from forest(f, radius)


def hubs_of(sample: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Sampled fingerprints with many sampled neighbours, at most 512, their component among the sample, and links that span these components."""
    parent, joined = np.arange(len(sample)), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    m = masks(BLOCKS)
    for k in m:
        for a, b in local_links(sample, radius, k, radius // BLOCKS):
            x, y = root(a), root(b)
            if x != y:
                joined.append((a, b))
            parent[max(x, y)] = min(x, y)
    comp = np.array([root(i) for i in range(len(sample))])
    ids, inv, n = np.unique(comp, return_inverse=True, return_counts=True)
    big = set(ids[n >= max(16, len(sample) // 256)].tolist())
    picked = [i for i in range(len(sample)) if comp[i] in big]
    degree = sorted(picked, key=lambda i: (-int((np.bitwise_count(sample[picked] ^ sample[i]) <= radius).sum()), i))[:512]
    kept = np.array([(a, b) for a, b in joined if comp[a] in big], np.int64).reshape(-1, 2)
    return sample[degree], comp[degree], sample[kept].view(np.int64).tolist()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """node, comp (the smallest node reachable) for the nodes of ``edges`` (a, b), by large and small stars."""
    e = stored(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.expr("u ^ 0L").alias("k"), F.least("m", "u").alias("m"))  # a key of its own: the join may then split hot keys
        large = both.join(low, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("m")).select(F.expr("u ^ 0L").alias("k"), "m")
        small = large.join(floor, F.col("u") == F.col("k")).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        before, e = e, stored(small)
        discard(before)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp"))


def link_edges(distinct: DataFrame, radius: int, leaf: int = LEAF, cell: int = CELL) -> DataFrame:
    """a, b: links between the distinct fingerprints of ``distinct`` (fp) that join all within ``radius`` bits."""
    sc = distinct.sparkSession.sparkContext
    blocks = masks(BLOCKS)
    r = radius // BLOCKS
    n = distinct.count()
    # All rows whose hash is below a threshold: about SAMPLE of them, taken where they lie.
    below = -SIGN + (2 * SIGN * SAMPLE // n if n > SAMPLE else 2 * SIGN - 1)
    drawn = distinct.where(F.xxhash64("fp", F.lit(5)) <= F.lit(below)).select("fp").collect()
    sample = np.array([x.fp for x in drawn], np.int64).view(np.uint64)
    in_leaf = max(8, int(leaf * len(sample) / max(1, n)))
    trees = [grow(sample, m, r, in_leaf, seed=7 + i) for i, m in enumerate(blocks)]
    hub, comp, spans = hubs_of(sample, radius) if len(sample) else (sample, np.zeros(0, int), [])
    shared = sc.broadcast((trees, hub, comp))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, hub, comp = shared.value
        for b in chunks(batches, 65536):
            f = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            label = np.full(len(f), -1, np.int64)
            at = np.zeros(len(f), np.uint64)
            for h, c in zip(hub[::-1], comp[::-1], strict=True):
                near = np.bitwise_count(f ^ h) <= radius
                label[near], at[near] = c, h
            tied = np.flatnonzero(label >= 0)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(tied), pa.int64()), pa.array(f[tied].view(np.int64)), pa.array(label[tied]), pa.array(at[tied].view(np.int64))], ["leaf", "fp", "label", "hub"])
            for k, (tree, m) in enumerate(zip(trees, blocks, strict=True)):
                for i, idx in enumerate(route(tree, f, m, r)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(idx), (k << 32) + i)), pa.array(f[idx].view(np.int64)), pa.array(label[idx]), pa.nulls(len(idx), pa.int64())], ["leaf", "fp", "label", "hub"])

    visits = stored(distinct.select("fp").mapInArrow(spread, "leaf long, fp long, label long, hub long"))
    homes = visits.where("leaf is not null")
    plan = []
    by_leaf = homes.groupBy("leaf", "label").agg(F.count("*").alias("n")).groupBy("leaf").agg(F.sum("n").alias("n"), F.max(F.struct(F.when(F.col("label") >= 0, F.col("n")).otherwise(0).alias("n"), "label")).alias("top"))
    for x in by_leaf.where(F.col("n") > cell).collect():
        hot = x.top.n if x.top.label >= 0 else 0
        plan.append((x.leaf, x.top.label if hot else -2, max(1, -(-hot // (cell // 2))), max(1, -(-(x.n - hot) // (cell // 2)))))
    h = lambda k: F.pmod(F.xxhash64("fp", F.lit(3)), F.greatest(F.coalesce(F.col(k), F.lit(1)), F.lit(1))).cast("int")
    if plan:
        table = distinct.sparkSession.createDataFrame(plan, "leaf long, top long, kd int, ko int")
        homes = homes.join(F.broadcast(table), "leaf", "left").withColumns({"hd": h("kd"), "ho": h("ko")})
        cells = (
            F.when(F.col("top").isNull(), F.array(F.lit("")))
            .when(F.col("label") == F.col("top"), F.transform(F.sequence(F.lit(0), F.col("ko") - 1), lambda g: F.concat_ws("_", F.col("hd"), g)))
            .otherwise(F.concat(
                F.transform(F.sequence(F.lit(0), F.col("kd") - 1), lambda c: F.concat_ws("_", c, F.col("ho"))),
                F.transform(F.filter(F.sequence(F.lit(0), F.col("ko") - 1), lambda g: g != F.col("ho")), lambda g: F.concat_ws("_", F.lit("o"), F.least(g, F.col("ho")), F.greatest(g, F.col("ho")))),
            ))
        )
        homes = homes.select("leaf", F.explode(cells).alias("cell"), "fp")
    else:
        homes = homes.select("leaf", F.lit("").alias("cell"), "fp")

    def links(key, group):
        f = np.unique(group.column("fp").to_numpy()).view(np.uint64)
        got = np.array(list(local_links(f, radius, blocks[int(key[0].as_py()) >> 32], r)), np.int64).reshape(-1, 2)
        return pa.table({"a": f[got[:, 0]].view(np.int64), "b": f[got[:, 1]].view(np.int64)})

    found = homes.groupBy("leaf", "cell").applyInArrow(links, "a long, b long")
    # Equal labels are not compared everywhere: these links join each fingerprint to its hub, and all hubs of a label.
    ties = visits.where("hub is not null and hub != fp").select(F.col("fp").alias("a"), F.col("hub").alias("b"))
    return found.unionByName(ties).unionByName(distinct.sparkSession.createDataFrame(spans, "a long, b long"))


def labels(reps: DataFrame, radius: int = 4) -> DataFrame:
    """fp, component_id (the smallest rep reachable) for the distinct fingerprints ``reps`` (fp, rep)."""
    comp = components(link_edges(reps, radius))
    # Components of fingerprints, then the smallest id in each.
    of = reps.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    low = of.groupBy("comp").agg(F.min("rep").alias("component_id")).select(F.expr("comp ^ 0L").alias("k"), "component_id")  # a key of its own, as above
    return of.join(low, F.col("comp") == F.col("k")).select("fp", "component_id")


def groups(prints: DataFrame, radius: int = 4) -> DataFrame:
    """``prints`` (doc_id, fp) with component_id: the smallest doc_id reachable by links of at most ``radius`` bits."""
    fixed = stored(prints)
    named = labels(stored(fixed.groupBy("fp").agg(F.min("doc_id").alias("rep"))), radius)
    return fixed.join(named, "fp").select("doc_id", "fp", "component_id")
