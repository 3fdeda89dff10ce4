"""Encoder capacity ladder with an injected encoder."""

from __future__ import annotations

import math
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ladder(total: int, start: int = 128, growth: float = 2.0, steps: list[int] | None = None) -> list[int]:
    """Sample counts: given ones up to the total, or growing by at least one, the last the total."""
    if steps:
        return sorted({s for s in steps if 0 < s <= total})
    out, n = [], start
    while n < total:
        out.append(n)
        n = max(n + 1, math.ceil(n * growth))
    return [*out, total] if total else []


def measure(df: DataFrame, order: str, text: str, encode: Callable[[list[str]], list[list[float]]], counts: list[int]) -> list[dict]:
    """Time of each prefix of the texts; stops at the first failure and reports it."""
    import pyarrow as pa

    def run(parts):
        for b in parts:
            v = encode(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(map(len, v)), pa.int32())], ["dim"])

    out = []
    for n in counts:
        began = time.perf_counter()
        try:
            r = df.where(F.trim(text) != "").orderBy(order).limit(n).select(text).mapInArrow(run, "dim int").agg(F.count("*").alias("n"), F.max("dim").alias("d")).first()
        except Exception as e:
            out.append({"samples": n, "error": str(e)[:200]})
            break
        s = time.perf_counter() - began
        out.append({"samples": r.n, "dimensions": r.d, "bytes": 4 * r.n * (r.d or 0), "seconds": s, "per_second": r.n / s})
    return out
