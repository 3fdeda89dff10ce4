"""Listings, options and run configuration on the driver."""

from __future__ import annotations

import fnmatch
import hashlib
import json
import re
from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def globbed(path: Column, include: list[str] = (), exclude: list[str] = ()) -> Column:
    """Whether a path matches one of ``include`` (all without any) and none of ``exclude``; shell patterns, ``*`` crosses slashes."""
    any_of = lambda ps: F.lit(False) if not ps else path.rlike("|".join(fnmatch.translate(p).replace("\\z", "$").replace("\\Z", "$") for p in ps))
    return (any_of(include) if include else F.lit(True)) & ~any_of(exclude)


def cached_listing(spark, snapshot: str, make: Callable[[], DataFrame], key: str) -> DataFrame:
    """A listing kept as Parquet under its key (dataset, repository, revision); made and written once."""
    where = f"{snapshot}/{hashlib.sha256(key.encode()).hexdigest()[:24]}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where + "/_SUCCESS")
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        make().write.mode("overwrite").parquet(where)
    return spark.read.parquet(where)


def first_option(*values, default=None):
    """The first value that is not null."""
    return next((v for v in values if v is not None), default)


def whole(value, name: str, least: int = 0) -> int:
    """A whole number of at least ``least``, from a number or text; booleans are none."""
    if isinstance(value, bool) or not re.fullmatch(r"\s*[+-]?[0-9]+\s*", str(value)) or int(value) < least:
        raise ValueError(f"{name} must be a whole number of at least {least}, not {value!r}")
    return int(value)


def flag(value, name: str) -> bool:
    if isinstance(value, bool):
        return value
    known = {"true": True, "1": True, "yes": True, "on": True, "false": False, "0": False, "no": False, "off": False}
    if str(value).strip().lower() not in known:
        raise ValueError(f"{name} must be true or false, not {value!r}")
    return known[str(value).strip().lower()]


def names(value: str | Iterable[str] | None) -> list[str]:
    """Comma-separated or listed names, trimmed, without blanks and repeats, in order."""
    parts = value.split(",") if isinstance(value, str) else value or []
    return list(dict.fromkeys(p.strip() for p in parts if p and p.strip()))


def pairs(value: str | Iterable[str] | None) -> list[tuple[str, str]]:
    """``A:B`` items as pairs, without repeats, in order."""
    out = [tuple(x.strip() for x in p.split(":", 1)) for p in names(value)]
    if any(len(p) != 2 or not all(p) for p in out):
        raise ValueError(f"expected A:B, got {value!r}")
    return list(dict.fromkeys(out))


def quotas(value: str | Iterable[str] | None) -> dict[str, int]:
    """``LABEL=N`` items as a mapping."""
    out = {}
    for p in names(value):
        label, mark, n = p.partition("=")
        if not mark or not label.strip():
            raise ValueError(f"expected LABEL=N, got {p!r}")
        out[label.strip()] = whole(n, label, 1)
    return out


def targets(per_cell: int | None, per_class: int | None, total: int | None = None) -> dict[str, int]:
    """Exactly one of a target a cell (25 without any) and one a class; a total may not be below the latter."""
    if per_cell is not None and per_class is not None:
        raise ValueError("give a target a cell or one a class, not both")
    if per_class is not None:
        if total is not None and whole(total, "total", 1) < per_class:
            raise ValueError("the total is below the target of a class")
        return {"per_class": whole(per_class, "per class", 1)}
    return {"per_cell": whole(first_option(per_cell, default=25), "per cell", 1)}


KINDS = ("parquet", "jsonl")


def config(text: str) -> dict:
    """A run's configuration: datasets with a source kind, patterns and languages; the error names what is wrong."""
    raw = json.loads(text)
    if not isinstance(raw.get("datasets"), list) or not raw["datasets"]:
        raise ValueError("datasets must be a list with an entry")
    out = []
    for d in raw["datasets"]:
        if d.get("source", "parquet") not in KINDS:
            raise ValueError(f"source must be one of {KINDS}, not {d.get('source')!r}")
        if not d.get("name") or not d.get("patterns"):
            raise ValueError("each dataset needs a name and patterns")
        out.append({"name": d["name"], "source": d.get("source", "parquet"), "patterns": names(d["patterns"]), "languages": names(d.get("languages")), "splits": names(d.get("splits")) or ["train"], "limit": whole(d["limit"], "limit", 1) if d.get("limit") is not None else None})
    return {"datasets": out, "start_row": whole(raw.get("start_row", 10), "start_row", 1), "output": raw.get("output")}


def filled(pattern: str, known: list[str], language: str | None = None, split: str = "*", subset: str = "*") -> str:
    """A pattern with ``{language}``, ``{split}`` and ``{subset}`` put in; a language has to be known, none is any."""
    if language is not None and known and language not in known:
        raise ValueError(f"unknown language {language!r}")
    return pattern.replace("{language}", language or "*").replace("{split}", split or "*").replace("{subset}", subset or "*")


def matrix(run: Callable[[str, str], object], datasets: list[str], languages: list[str], skip_errors: bool = False) -> tuple[dict, dict]:
    """Results and errors of ``run`` over datasets times languages; without ``skip_errors`` the first error ends it."""
    done, failed = {}, {}
    for d in datasets:
        for lang in languages:
            try:
                done[d, lang] = run(d, lang)
            except Exception as e:
                if not skip_errors:
                    raise
                failed[d, lang] = str(e)
    return done, failed


def epoch(given: str | None = None, today: date | None = None) -> str:
    """A cache epoch: the day, or up to 128 printable characters of the user's own."""
    if given is None:
        return (today or date.today()).isoformat()
    if not 0 < len(given) <= 128 or not given.isprintable():
        raise ValueError("an epoch has 1 to 128 printable characters")
    return given


def write_plan(df: DataFrame, path: str, settings: dict) -> None:
    """A candidate plan: its rows as Parquet, its settings and their digest in one more row set beside them."""
    df.write.mode("overwrite").parquet(f"{path}/rows")
    digest = hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()
    df.sparkSession.createDataFrame([(json.dumps(settings, sort_keys=True), digest)], "settings string, digest string").coalesce(1).write.mode("overwrite").json(f"{path}/plan")


def read_plan(spark, path: str, settings: dict) -> DataFrame:
    """The rows of a plan that was written under the same settings."""
    want = hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()
    if [r.digest for r in spark.read.schema("settings string, digest string").json(f"{path}/plan").collect()] != [want]:
        raise ValueError("the plan was made under other settings")
    return spark.read.parquet(f"{path}/rows")


def coerced(result) -> list[str]:
    """What an extractor returned, as texts: nothing, one text, an object with a text, or several; blanks go."""
    if result is None:
        return []
    if isinstance(result, str) or hasattr(result, "text") or isinstance(result, dict):
        result = [result]
    texts = [r if isinstance(r, str) else r.get("text") if isinstance(r, dict) else getattr(r, "text", None) for r in result if r is not None]
    return [t for t in texts if t is not None and t.strip()]


def human_bytes(n: float | None) -> str:
    if n is None:
        return "-"
    units = ["B", "KiB", "MiB", "GiB", "TiB", "PiB"]
    k = 0
    while abs(n) >= 1024 and k < len(units) - 1:
        n, k = n / 1024, k + 1
    return f"{n:.0f} {units[k]}" if not k else f"{n:.1f} {units[k]}"


def human_seconds(s: float | None) -> str:
    if s is None or s < 0:
        return "-"
    s = int(s)
    d, h, m = s // 86400, s // 3600 % 24, s // 60 % 60
    return f"{d}d {h:02d}h" if d else f"{h}h {m:02d}m" if h else f"{m}m {s % 60:02d}s" if m else f"{s}s"


def human_rate(n: float, seconds: float) -> str:
    return f"{n / seconds:,.1f}/s" if seconds > 0 else "-"


def bar(done: float, total: float, width: int = 20) -> str:
    full = round(width * min(1.0, max(0.0, done / total))) if total > 0 else 0
    return "#" * full + "." * (width - full)
