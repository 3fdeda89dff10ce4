"""Scalar text, identity and score functions as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TWO64 = 18446744073709551615.0


def trimmed(c: Column) -> Column:
    """CRLF to LF, outer white space off; empty is null."""
    return F.nullif(F.regexp_replace(F.regexp_replace(c, "\\r\\n?", "\n"), "^\\s+|\\s+$", ""), F.lit(""))


def folded(c: Column) -> Column:
    """White space runs collapsed, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, "\\s+", " "), "^ | $", ""))


@F.pandas_udf(T.StringType())
def folded_nfkc(s: pd.Series) -> pd.Series:
    """Compatibility form, full case fold, white space collapsed: the exact identity of candidate texts."""
    return s.map(lambda x: None if x is None else " ".join(unicodedata.normalize("NFKC", x).casefold().split()))


def text_hash(c: Column) -> Column:
    return F.sha2(folded(c), 256)


def joined_id(*parts: Column, size: int = 64) -> Column:
    """Leading hex digits of the sha256 of NUL-separated parts."""
    return F.substring(F.sha2(F.concat_ws("\0", *parts), 256), 1, size)


def stable_fraction(*parts: Column) -> Column:
    """0 to 1 from the first eight bytes of a sha256."""
    return F.conv(joined_id(*parts, size=16), 16, 10).cast("decimal(20,0)").cast("double") / TWO64


def slug(c: Column, default: str = "dataset") -> Column:
    s = F.regexp_replace(F.lower(F.regexp_replace(c, "[^A-Za-z0-9]+", "-")), "^-+|-+$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(default))


def path_segment(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F"))


def split_name(c: Column) -> Column:
    """A language as the name of a split."""
    s = F.replace(F.replace(F.replace(c, F.lit("#"), F.lit("_sharp")), F.lit("++"), F.lit("_plus_plus")), F.lit("*"), F.lit("_star"))
    return F.regexp_replace(s, "[^A-Za-z0-9_.]+", "_")


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, "[^/.][^/]*\\.([^./]+)$", 1))


def optional(c: Column) -> Column:
    return F.when(F.lower(F.trim(c)).isin("", "none", "null", "false"), None).otherwise(c)


def ellipsis(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.rtrim(F.left(c, F.lit(n - 3))), F.lit("..."))).otherwise(c)


def first_lines(c: Column, n: int) -> Column:
    """The first ``n`` lines, the last with its line break."""
    head = F.substring_index(c, "\n", n)
    return F.when(F.length(head) < F.length(c), F.concat(head, F.lit("\n"))).otherwise(c)


def byte_estimate(*cols: Column) -> Column:
    """Bytes of a record in memory: 192 plus nine eighths of its strings, null as four."""
    total = sum((F.coalesce(F.octet_length(c), F.lit(4)) for c in cols[1:]), F.coalesce(F.octet_length(cols[0]), F.lit(4)))
    return (F.lit(192) + total + F.floor(total / 8)).cast("long")


def parameter_count(c: Column) -> Column:
    """``22M``, ``0.6B`` or ``2_000_000`` as a number; outside 2 M to 8 B null."""
    s = F.upper(F.replace(F.trim(c), F.lit("_"), F.lit("")))
    n = F.regexp_extract(s, "^([0-9]+(?:\\.[0-9]+)?)[KMB]?$", 1).try_cast("double")
    unit = F.right(s, F.lit(1))
    v = n * F.when(unit == "K", 1e3).when(unit == "M", 1e6).when(unit == "B", 1e9).otherwise(1.0)
    return F.when((v >= 2e6) & (v <= 8e9), v.cast("long"))


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def topic_score(c: Column) -> Column:
    """Up to one is a ratio; not finite or negative is null."""
    return F.when(finite(c) & (c >= 0), F.when(c <= 1, c * 100).otherwise(c))


def classifier_score(c: Column) -> Column:
    """Unreadable, not finite and negative count as zero."""
    v = c.try_cast("double")
    return F.when(finite(v) & (v >= 0), v).otherwise(0.0)


def key_values(line: Column) -> Column:
    """Map of the ``key=value`` words of a log line; the last of equal keys wins."""
    pairs = F.filter(F.split(line, "\\s+"), lambda w: F.instr(w, "=") > 0)
    pairs = F.transform(pairs, lambda w: F.struct(F.substring_index(w, "=", 1).alias("key"), F.substring(w, F.instr(w, "=") + 1, 1 << 20).alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def json_object(c: Column) -> Column:
    """The outermost braces of a model's answer, null unless they parse."""
    body = F.nullif(F.regexp_extract(c, "(?s)\\{.*\\}", 0), F.lit(""))
    return F.when(F.try_parse_json(body).isNotNull(), body)


def ngrams(tokens: Column, n: int, hashed: bool = False) -> Column:
    """Distinct runs of ``n`` tokens, or their 64-bit hashes; a shorter list is one run."""

    def of(t: Column) -> Column:
        size = F.size(t)
        at = F.when(size == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(size - n, F.lit(0))))
        return F.array_distinct(F.transform(at, lambda i: F.xxhash64(F.slice(t, i + 1, n)) if hashed else F.array_join(F.slice(t, i + 1, n), " ")))

    return F.get(F.transform(F.array(tokens), of), 0)  # bound once: an expression in a lambda is evaluated at each step


def tokens(c: Column) -> Column:
    """Runs of letters and digits, lower case."""
    return F.regexp_extract_all(F.lower(c), F.lit("[\\p{L}\\p{N}]+"), F.lit(0))


def containment(a: Column, b: Column) -> Column:
    n = F.least(F.size(a), F.size(b))
    return F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise(0.0)


def jaccard(a: Column, b: Column) -> Column:
    n = F.size(F.array_union(a, b))
    return F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise(0.0)


def record_parts(record_id: Column, metadata: Column | None = None) -> Column:
    """(remote_path, row_index, comment_index) of a record id; where it has none, ``remote_path`` and ``row_index`` of a metadata JSON."""
    part = lambda k: F.regexp_extract(record_id, "^(.*)::row::([0-9]+)(?:::comment::([0-9]+))?$", k)
    of = lambda k, kind: F.try_variant_get(F.try_parse_json(metadata), f"$.{k}", kind) if metadata is not None else F.lit(None).cast(kind)
    return F.struct(
        F.coalesce(F.nullif(part(1), F.lit("")), of("remote_path", "string")).alias("remote_path"), F.coalesce(F.nullif(part(2), F.lit("")).cast("long"), of("row_index", "long")).alias("row_index"), F.nullif(part(3), F.lit("")).cast("long").alias("comment_index")
    )
