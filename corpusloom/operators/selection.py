"""Orders, slots and greedy choices over bounded pools."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .allocate import Flow, water_fill


def rank_key(kind: Column, length: Column, priority: Column, id: Column, first: str = "irrelevant", long: str = "irrelevant_random", cap: int = 800) -> list[Column]:
    """Sort columns: boundary negatives first, then the longer random ones (up to ``cap``), then priority, then id."""
    return [F.desc(kind == first), F.desc(F.when(kind == long, F.least(length, F.lit(cap))).otherwise(0)), F.desc(priority), id.asc()]


def interleaved(df: DataFrame, rank: str, every: int) -> list[Column]:
    """Sort columns that take every ``every``-th row, then the next ones: round robin."""
    return [F.pmod(F.col(rank), F.lit(every)), F.col(rank)]


def shuffled(id: Column, seed: int) -> list[Column]:
    """Sort columns of a seeded shuffle that any engine can repeat."""
    return [F.sha2(F.concat_ws("\0", F.lit(str(seed)), id), 256), id]


def slots(rows: list[tuple[str, str, float]], limits: dict[str, int]) -> list[tuple[str, str]]:
    """(cell, hash) picks: each hash at most once, each cell up to its limit, as many as can be; scarce cells choose first.

    ``rows``: cell, hash, priority of a bounded pool.
    """
    supply: dict[str, int] = {}
    for cell, *_ in rows:
        supply[cell] = supply.get(cell, 0) + 1
    flow, marks, ends = Flow(), [], set()
    for cell in sorted(limits, key=lambda c: (supply.get(c, 0) - limits[c], c)):
        flow.edge("s", ("c", cell), limits[cell])
        for _, h, _ in sorted((r for r in rows if r[0] == cell), key=lambda r: (-r[2], r[1])):
            marks.append((flow.edge(("c", cell), ("h", h), 1), cell, h))
            if h not in ends:
                ends.add(h)
                flow.edge(("h", h), "t", 1)
    flow.run("s", "t")
    return [(c, h) for k, c, h in marks if not flow.cap[k]]


def within_budget(cells: DataFrame, name: str, capacity: str, total: int, pick: Callable[[dict[str, int]], list]) -> list:
    """Picks under a global budget: caps by water-filling, then raised by what is missing, doubling, until nothing more is found.

    ``pick`` gets a cap a cell and returns its picks; the cells are a small table.
    """
    size = {r[0]: r[1] for r in cells.select(name, capacity).collect()}
    caps = {r[0]: r[2] for r in water_fill(cells, name, capacity, total, tolerant=True).collect()}
    got, step = pick(caps), 1
    while len(got) < total:
        grown = {c: min(size[c], n + step * (total - len(got))) for c, n in caps.items()}
        if grown == caps:
            break
        caps, step, more = grown, step * 2, pick(grown)
        got = more if len(more) > len(got) else got
    return got[:total]


def greedy_diverse(df: DataFrame, cell: str, id: str, marks: str, limit: int, *order: str) -> DataFrame:
    """``df`` with ``decision``: in rank order a row is kept unless one of its ``marks`` (hashes, markers, classes of near copies) was kept before, up to ``limit`` a cell.

    Cells come from a bounded pool, so a group's size is bounded.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order), kind="stable")
        seen: set = set()
        kept, out = 0, []
        for m in pdf[marks]:
            m = set(m if m is not None else ())
            if m & seen:
                out.append("duplicate")
            elif kept >= limit:
                out.append("quota_excess")
            else:
                out.append("kept")
                kept += 1
                seen |= m
        return pdf.assign(decision=out)

    run.__annotations__ = {}
    return df.groupBy(cell).applyInPandas(run, T.StructType([*(f for f in df.schema if f.name != "decision"), T.StructField("decision", T.StringType())]))


def first_languages(listing: DataFrame, language: str, path: str, include: list[str] = (), exclude: list[str] = (), languages: int | None = None, shards: int | None = None) -> DataFrame:
    """A bucket's plan: shards numbered before any filter, then named languages, the first ``languages`` of them and the first ``shards`` files.

    One row a file, so the numbering is a small window.
    """
    df = listing.withColumn("file_index", F.row_number().over(Window.orderBy(language, path)) - 1)
    df = df.where(F.col(language).isin(list(include))) if include else df
    df = df.where(~F.col(language).isin(list(exclude))) if exclude else df
    if languages is not None:
        df = df.withColumn("_l", F.dense_rank().over(Window.orderBy(language))).where(F.col("_l") <= languages).drop("_l")
    return df.orderBy("file_index").limit(shards) if shards is not None else df


def package_rows(segments: DataFrame, rows: DataFrame, file: str, index: str) -> DataFrame:
    """Rows of each (package, file, start, end) segment, with its bounds: a range join within one file.

    Segments are cut at multiples of a grid, so the join is on (file, grid cell)
    and each row meets the few segments of its cell.
    """
    grid = 4096
    cells = segments.withColumn("_g", F.explode(F.sequence(F.expr(f"start div {grid}"), F.expr(f"(`end` - 1) div {grid}"))))
    at = rows.withColumn("_g", F.expr(f"`{index}` div {grid}"))
    return at.join(cells, [file, "_g"]).where((F.col(index) >= F.col("start")) & (F.col(index) < F.col("end"))).drop("_g")


def prefix(df: DataFrame, path: str, index: str, n: int) -> DataFrame:
    """Rows of the first ``n`` source files of one remote path; the run fails if paths change or the end isn't reached."""
    seen = df.agg(F.count_distinct(path).alias("paths"), F.max(index).alias("last")).first()
    if seen.paths > 1 or seen.last is None or seen.last < n - 1:
        raise ValueError(f"a prefix of {n} files needs one path that reaches it, not {seen.paths} up to {seen.last}")
    return df.where(F.col(index) < n)
