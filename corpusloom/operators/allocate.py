"""Quotas, samples and matchings."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def water_fill(cells: DataFrame, name: str, capacity: str, total: int, tolerant: bool = False) -> DataFrame:
    """Max-min fair shares of ``total`` over cells with capacities; the remainder goes to the first names.

    A small table (one row a cell), so its window runs in one task.
    """
    base = cells.where(F.col(capacity) > 0).select(F.col(name), F.col(capacity).cast("long").alias("capacity"))
    sums = base.agg(F.sum("capacity").alias("s"), F.count("*").alias("n")).first()
    if not tolerant and ((sums.s or 0) < total or total < (sums.n or 0)):
        raise ValueError(f"{total} rows can't be dealt over {sums.n} cells of {sums.s} rows")
    total = min(total, sums.s or 0)
    asc = Window.orderBy("capacity", name)
    ranked = base.withColumn("_i", F.row_number().over(asc)).withColumn("_before", F.coalesce(F.sum("capacity").over(asc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    n = sums.n or 0
    full = ranked.withColumn("_full", F.col("capacity") * (F.lit(n) - F.col("_i") + 1) <= F.lit(total) - F.col("_before"))
    rest = full.agg(F.sum(F.when(F.col("_full"), F.col("capacity"))).alias("used"), F.count_if(~F.col("_full")).alias("m")).first()
    left, m = total - (rest.used or 0), rest.m or 0
    order = F.row_number().over(Window.partitionBy("_full").orderBy(name))
    share = F.lit(left // m if m else 0) + F.when(order <= (left % m if m else 0), 1).otherwise(0)
    return full.select(name, "capacity", F.when(F.col("_full"), F.col("capacity")).otherwise(share).cast("long").alias("quota"))


def systematic(ranked: DataFrame, quotas: DataFrame, key: str, rank: str = "ordinal") -> DataFrame:
    """Rows at ranks floor((2i + 1) * capacity / (2 * quota)) of each key."""
    picks = quotas.where("quota > 0").select(F.col(key), F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1), lambda i: F.call_function("div", (2 * i + 1) * F.col("capacity"), 2 * F.col("quota")))).alias(rank))
    return ranked.join(picks, [key, rank])


def bounded_pool(df: DataFrame, cell: list[str], pair: list[str], k: int, *order: Column) -> DataFrame:
    """At most ``k`` rows a cell with distinct ``pair``, the best of each pair first."""
    best = df.withColumn("_p", F.row_number().over(Window.partitionBy(*cell, *pair).orderBy(*order))).where("_p = 1").drop("_p")
    return best.withColumn("rank", F.row_number().over(Window.partitionBy(*cell).orderBy(*order))).where(F.col("rank") <= k)


def packages(ranges: DataFrame, file: str, rows: str, size: int) -> DataFrame:
    """(package, file, start, end): exact runs of ``size`` rows over the files in order, cut at file borders.

    One row a file, so the running sum is a small window.
    """
    w = Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    cum = ranges.where(F.col(rows) > 0).select(F.col(file), F.col(rows).cast("long").alias("_n"), F.coalesce(F.sum(rows).over(w), F.lit(0)).cast("long").alias("_at"))
    parts = cum.withColumn("package", F.explode(F.sequence(F.expr(f"_at div {size}"), F.expr(f"(_at + _n - 1) div {size}"))))
    return parts.select("package", file, F.greatest(F.col("package") * size - F.col("_at"), F.lit(0)).cast("long").alias("start"), F.least((F.col("package") + 1) * size - F.col("_at"), F.col("_n")).cast("long").alias("end"))


def hash_split(fraction: Column) -> Column:
    return F.when(fraction < 0.8, "train").when(fraction < 0.9, "validation").otherwise("test")


def match_pairs(left_of: dict, order: list) -> dict:
    """Maximum bipartite matching; ``left_of`` gives each left node's right nodes, best first; no recursion."""
    taken: dict = {}
    for start in order:
        parent, queue, seen, end = {}, [start], set(), None
        while queue and end is None:
            u = queue.pop(0)
            for v in left_of[u]:
                if v in seen:
                    continue
                seen.add(v)
                parent[v] = u
                if v not in taken:
                    end = v
                    break
                queue.append(taken[v])
        back = {v: u for u, v in ((u, v) for v, u in taken.items())}
        while end is not None:
            u = parent[end]
            before = back.get(u)
            taken[end] = u
            end = before
    return {u: v for v, u in taken.items()}


def diverse(df: DataFrame, cell: str, left: str, right: str, limit: int, *order: str) -> DataFrame:
    """Rows of a cell such that no ``left`` and no ``right`` value repeats, as many as a maximum matching has, at most ``limit``.

    Cells come from ``bounded_pool``, so a group's size is bounded.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order), ascending=False, kind="stable").drop_duplicates([left, right])
        links: dict = {}
        for a, b in zip(pdf[left], pdf[right], strict=True):
            links.setdefault(a, []).append(b)
        got = match_pairs(links, list(links))
        keep = [got.get(a) == b for a, b in zip(pdf[left], pdf[right], strict=True)]
        return pdf[keep].head(limit)

    run.__annotations__ = {}
    return df.groupBy(cell).applyInPandas(run, df.schema)


class Flow:
    """Dinic's maximum flow over a bounded graph on the driver; insertion order breaks ties."""

    def __init__(self):
        self.ids: dict = {}
        self.adj: list[list[int]] = []
        self.to: list[int] = []
        self.cap: list[int] = []

    def node(self, name) -> int:
        if name not in self.ids:
            self.ids[name] = len(self.adj)
            self.adj.append([])
        return self.ids[name]

    def edge(self, a, b, capacity: int) -> int:
        u, v, k = self.node(a), self.node(b), len(self.to)
        self.to += [v, u]
        self.cap += [capacity, 0]
        self.adj[u].append(k)
        self.adj[v].append(k + 1)
        return k

    def run(self, a, b) -> int:
        s, t, total = self.node(a), self.node(b), 0
        while True:
            level = [-1] * len(self.adj)
            level[s], queue = 0, [s]
            for u in queue:
                for k in self.adj[u]:
                    if self.cap[k] and level[self.to[k]] < 0:
                        level[self.to[k]] = level[u] + 1
                        queue.append(self.to[k])
            if level[t] < 0:
                return total
            at = [0] * len(self.adj)
            path: list[int] = []
            u = s
            while True:
                if u == t:
                    pushed = min(self.cap[k] for k in path)
                    for k in path:
                        self.cap[k] -= pushed
                        self.cap[k ^ 1] += pushed
                    total += pushed
                    cut = next(i for i, k in enumerate(path) if not self.cap[k])
                    path, u = path[:cut], self.to[path[cut] ^ 1]
                    continue
                while at[u] < len(self.adj[u]):
                    k = self.adj[u][at[u]]
                    if self.cap[k] and level[self.to[k]] == level[u] + 1:
                        path.append(k)
                        u = self.to[k]
                        break
                    at[u] += 1
                else:
                    if u == s:
                        break
                    k = path.pop()
                    u = self.to[k ^ 1]
                    at[u] += 1


def allocate_labels(rows: list[tuple[str, str, str, int]], label_quota: dict[str, int], cell_quota: dict[tuple[str, str], int]) -> list[tuple[str, str, str]]:
    """(label, cell, hash) picks of a maximum flow source, label, cell, hash, sink; scarce labels first.

    ``rows``: label, cell, hash, priority of a bounded pool; each hash is used once.
    """
    flow, marks = Flow(), []
    supply: dict[str, int] = {}
    for label, *_ in rows:
        supply[label] = supply.get(label, 0) + 1
    for label in sorted(label_quota, key=lambda x: (supply.get(x, 0), x)):
        flow.edge("s", ("l", label), label_quota[label])
    for (label, cell), n in sorted(cell_quota.items()):
        flow.edge(("l", label), ("c", label, cell), n)
    hashes = set()
    for label, cell, h, p in sorted(rows, key=lambda r: (-r[3], r)):
        marks.append((flow.edge(("c", label, cell), ("h", h), 1), label, cell, h))
        if h not in hashes:
            hashes.add(h)
            flow.edge(("h", h), "t", 1)
    flow.run("s", "t")
    return [(a, b, c) for k, a, b, c in marks if not flow.cap[k]]
