"""Near-duplicate texts: SimHash proposes, word shingles decide.

Two texts are linked if the sets of their ``WIDTH``-word shingles have a Jaccard
likeness of 0.8 or more.  There 64-bit fingerprints differ by about 10 bits, out
of reach of any radius at which vantage-point trees prune, so links come from
two sources and each is verified on whole shingle sets:

* SimHash groups (``simhash.labels``): each member with the group's centre.
* Rare shingles: put in one fixed order, two sets of that likeness share one of
  their first n - ceil(0.8 n) + 1 shingles, so comparing texts that share one is
  exact.  The order sets shingles frequent in a drawn sample last.  It decides
  only how much is compared, never what is found.

Texts that share a shingle are first compared with one centre a shingle; what
then is in one component needs no comparison inside it, and only pairs across
components that sizes and positions leave possible follow.  Whole sets are
fetched only for pairs whose first shingles have enough in common (``likely``).

Cases: equal shingle sets are one node, so copies are never paired; null and
empty texts are one group; fewer words than ``WIDTH`` make one shingle; texts
are read whole; an empty table gives none; all columns return whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import bound_batches, chunks, discard, spare, stored, text_bytes
from .simhash import components, folded, labels, shingle_hashes

WIDTH, DRAWN, LISTED = 5, 8192, 1 << 20


def distinct_hashes(text: bytes, width: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, width))


def listed(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several of about ``DRAWN`` rows hold, ascending, and in how many; at most ``LISTED`` of the most frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 64):
            h = [distinct_hashes(t, width).view(np.int64) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h))], ["h"])

    n = docs.count()
    drawn = docs.select(text_bytes().alias("t")).where(F.rand(5) < min(1.0, DRAWN / max(1, n)))
    seen = stored(drawn.mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 2"))
    least, total = 3, 0
    for x in sorted(seen.groupBy("n").count().collect(), key=lambda x: -x["n"]):
        total += x["count"]
        if total > LISTED:
            least = x["n"] + 1
            break
    got = seen.where(F.col("n") >= least).toPandas()
    discard(seen)
    h = got["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], got["n"].to_numpy(np.int64)[order]


def rarest(s: np.ndarray, known: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The first n - ceil(0.8 n) + 1 of the set ``s`` (ascending), by listed frequency, then hash."""
    if not len(s):
        return s
    n = np.zeros(len(s), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
        n = np.where(known[at] == s, times[at], 0)
    return s[np.argsort(n, kind="stable")[: len(s) - -(-4 * len(s) // 5) + 1]]


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """Each row's doc_id, th (text hash), fp (SimHash), node (hash of the shingle set), n (its size) and sig (its rarest shingles)."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(listed(docs, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times = shared.value
        for b in chunks(batches, 256):
            fp, node, n, sig = [], [], [], []
            for t in b.column(2).to_pylist():
                h = shingle_hashes(t, width)
                s = np.unique(h)
                fp.append(folded(h))
                node.append(xxh64_intdigest(s.tobytes(), 7))
                n.append(len(s))
                sig.append(rarest(s, known, times).view(np.int64))
            signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), signed(fp), signed(node), pa.array(n, pa.int64()), pa.array(sig, pa.list_(pa.int64()))], ["doc_id", "th", "fp", "node", "n", "sig"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), text_bytes().alias("t"))
    return rows.mapInArrow(run, "doc_id long, th long, fp long, node long, n long, sig array<long>")


def likely(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The ``pairs`` that their rarest shingles leave possible.

    In the one order, a common shingle stands in both prefixes or behind the end
    of the prefix that ends first, so two sets have at most as many in common as
    their prefixes have, plus the longer of the two tails.
    """
    sig = lambda x: nodes.select(F.col("node").alias(f"k{x}"), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}"))
    both = pairs.join(sig("a"), F.col("a") == F.col("ka")).join(sig("b"), F.col("b") == F.col("kb"))
    tail = F.floor((4 * F.greatest("na", "nb") + 4) / 5) - 1
    return stored(both.where(9 * (F.size(F.array_intersect("sa", "sb")) + tail) >= 4 * (F.col("na") + F.col("nb"))).select("a", "b"))


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """The ``pairs`` (a, b) of nodes whose whole shingle sets are alike to 0.8 or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 256):
            sets = [distinct_hashes(t, width).view(np.int64) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "s"])

    pairs = likely(nodes, pairs)
    need = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    at = nodes.join(need, "node").select("node", F.col("at.doc_id").alias("d"), F.col("at.th").alias("t"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), text_bytes().alias("text"))
    found = texts.join(at, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))).groupBy("node").agg(F.first("text").alias("text"))  # repeated rows are one; texts shuffle in less than sets
    sets = stored(found.mapInArrow(run, "node long, s array<long>"))
    left = sets.select(F.col("node").alias("ka"), F.col("s").alias("sa"))
    right = sets.select(F.col("node").alias("kb"), F.col("s").alias("sb"))
    both = pairs.join(left, F.col("a") == F.col("ka")).join(right, F.col("b") == F.col("kb"))
    out = stored(both.where(F.size(F.array_intersect("sa", "sb")) * 9 >= (F.size("sa") + F.size("sb")) * 4).select("a", "b"))
    discard(sets, pairs)
    return out


def possible(n: Column, pos: Column, m: Column, qos: Column) -> Column:
    """Whether sets of sizes n and m whose first common shingle stands at these positions can be alike to 0.8."""
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (9 * (F.least(n - pos, m - qos)) >= 4 * (n + m))


def node_links(docs: DataFrame, rows: DataFrame, radius: int, width: int) -> DataFrame:
    """a, b: verified links between nodes of ``rows`` that join all that are alike."""
    nodes = stored(rows.groupBy("node").agg(F.first("n").alias("n"), F.first("sig").alias("sig"), F.min("fp").alias("fp"), F.min(F.struct("doc_id", "th")).alias("at")))
    named = labels(stored(nodes.groupBy("fp").agg(F.min("node").alias("rep"))), radius).withColumnRenamed("fp", "f")
    stars = nodes.join(named, F.col("fp") == F.col("f")).where("node != component_id").select(F.col("component_id").alias("a"), F.col("node").alias("b"))

    pieces = nodes.select("node", "n", F.posexplode("sig").alias("pos", "h"))
    often = pieces.groupBy("h").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo != hi").select(F.expr("h ^ 0L").alias("k"))  # a key of its own: the join may then split hot keys
    shared = stored(pieces.join(often, F.col("h") == F.col("k")).select("h", "node", "n", "pos"))
    centre = shared.groupBy("h").agg(F.min(F.struct("node", "n", "pos")).alias("c")).select(F.expr("h ^ 0L").alias("k"), "c")
    to_centre = shared.join(centre, F.col("h") == F.col("k")).where("node != c.node").where(possible(F.col("n"), F.col("pos"), F.col("c.n"), F.col("c.pos")))
    first = stored(stars.unionByName(to_centre.select(F.col("c.node").alias("a"), F.col("node").alias("b"))).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    links = verified(docs, nodes, first, width)

    comp = components(links).select(F.col("node").alias("k"), "comp")
    placed = stored(shared.join(comp, F.col("node") == F.col("k"), "left").select("h", "node", "n", "pos", F.coalesce("comp", "node").alias("comp")))
    discard(shared)
    split = placed.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select(F.expr("h ^ 0L").alias("k"))
    open_ = stored(placed.join(split, F.col("h") == F.col("k")).drop("k"))
    discard(placed)
    x, y = open_.alias("x"), open_.select(F.expr("h ^ 0L").alias("k"), F.struct("node", "n", "pos", "comp").alias("y"))
    across = x.join(y, (F.col("h") == F.col("k")) & (F.col("node") < F.col("y.node")) & (F.col("comp") != F.col("y.comp")) & possible(F.col("n"), F.col("pos"), F.col("y.n"), F.col("y.pos")))
    rest = across.select(F.col("node").alias("a"), F.col("y.node").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    rest = stored(rest)
    discard(open_, first)
    out = links if rest.isEmpty() else links.unionByName(verified(docs, nodes, rest, width))
    discard(nodes, rest)
    return out


def keep_one(docs: DataFrame, radius: int = 4, width: int = WIDTH) -> DataFrame:
    """``docs`` with one row for each group of near-duplicates: the one with the smallest doc_id.

    Rows are told apart by doc_id and text, so a row goes with its own group only;
    equal rows stay together. A row with a null doc_id goes if its group has an id.
    """
    d, t = spare(docs, "gone_d", "gone_t")
    rows = stored(sketches(docs, width))
    comp = components(node_links(docs, rows, radius, width)).select(F.col("node").alias("k"), "comp")
    of = stored(rows.groupBy("node").agg(F.min("doc_id").alias("low")).join(comp, F.col("node") == F.col("k"), "left").select("node", "low", F.coalesce("comp", "node").alias("comp")))
    low = of.groupBy("comp").agg(F.min("low").alias("component_id")).select(F.expr("comp ^ 0L").alias("k"), "component_id")
    named = of.join(low, F.col("comp") == F.col("k")).where("component_id is not null").select(F.col("node").alias("k"), "component_id")
    marked = rows.join(named, F.col("node") == F.col("k")).where("doc_id is null or doc_id != component_id")
    gone = marked.select(F.col("doc_id").alias(d), F.col("th").alias(t)).distinct()
    return docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(t)), "left_anti").select(*docs.columns)
