"""Line dedup by overlapping three-line windows, in DataFrame functions only.

A line ends at a line break.  Longer lines are cut behind their fourth word or a
later one where that word says so by itself: its last character, clause marks
behind it aside, is an ASCII consonant other than h, n, r, s, t or one from
U+00E0 to U+00FF, or such marks follow a lower-case letter or digit; 40 further words
without such a place end a line too.  Cuts thus depend on the words around
them, not on what stands before a passage: copies of a passage in unlike
surroundings fall into step after a line or two.

Every run of three lines (all lines of a shorter text) is hashed.  Where three
lines have under ``LEAST`` characters, twelve are taken instead, and nothing
where the text ends before; so text in very short lines is compared as well,
but a few stray short lines are no passage.  Windows that occur more than once
anywhere are found by counts; all occurrences but the first, in order of
(doc_id, text hash, position), are removed, and overlapping removals merge.

Lines are split and hashed once, into an array of numbers a document, written
to the shared folder.  Only window hashes are shuffled to be counted and
joined; texts move once, to meet the positions to remove.  Hot windows are
pre-aggregated for the counts, and the joins are plain equi-joins that adaptive
execution splits.

Cases: a null text stays null; an empty one stays empty; rows that share both
doc_id and text count as one document and get the same result; a null doc_id
sorts first; extra columns are carried through, whatever their names (a column
n_lines or n_removed is replaced by ``dedup``); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, spare, stored

WINDOW, LONG, LEAST = 3, 12, 40
_W = "\\t\\n\\x0B\\f\\r "
_LATIN1 = "".join(map(chr, range(0xE0, 0x100)))
_ENDS = "bcdfgjklmpqvwxyzBCDFGJKLMPQVWXYZ" + _LATIN1
_MARKS, _SMALL = ".!?,;:", "abcdefghijklmnopqrstuvwxyz0123456789" + _LATIN1
#: A line with all white space that follows it; the first line also has what stands before.
LINE = f"[{_W}]*(?:[^{_W}]+[ \\t]+){{0,3}}(?:[^{_W}]*(?:[^{_W}{_MARKS}{_ENDS}]|[^{_W}{_MARKS}{_ENDS}{_SMALL}][{_MARKS}]+)[ \\t]+){{0,40}}[^{_W}]+[{_W}]*"
_TRIM = "\t\n\x0b\f\r "


def lines_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(LINE), F.lit(0))


def line_hashes(text: Column) -> Column:
    """A long for each line: 58 bits of the hash of its key (trimmed, lower-cased, tabs as spaces) and its length, at most ``LEAST``."""
    flat = F.when(F.contains(text, F.lit("\t")), F.replace(text, F.lit("\t"), F.lit(" "))).otherwise(text)

    def of(x: Column) -> Column:
        key = F.lower(F.trim(x, F.lit(_TRIM)))
        return F.shiftleft(F.xxhash64(key), 6).bitwiseOR(F.least(F.length(key), F.lit(LEAST)).cast("long"))

    return F.transform(lines_of(flat), of)


def documents(docs: DataFrame) -> DataFrame:
    """d, t (32 bits of the text's hash) and ``lines`` of each distinct document, written once."""
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return stored(docs.where(F.col("text").isNotNull()).select(d.alias("d"), F.hash("text").alias("t"), line_hashes(F.col("text")).alias("lines")))


def windows(lines: DataFrame) -> DataFrame:
    """d, at (text hash, position and length in one number), h and g (two hashes) of each window."""
    n = F.size("lines")

    def of(x: Column, i: Column) -> Column:
        y, z = (F.coalesce(F.get("lines", i + k), F.lit(0).cast("long")) for k in (1, 2))
        size = x.bitwiseAND(F.lit(63)) + y.bitwiseAND(F.lit(63)) + z.bitwiseAND(F.lit(63))
        three = F.struct((i * 2).alias("p"), F.xxhash64(x, y, z).alias("h"), F.hash(z, x, y).alias("g"))
        some = lambda: F.slice("lines", i + 1, LONG)
        twelve = F.struct((i * 2 + 1).alias("p"), F.xxhash64(some()).alias("h"), F.hash(some()).alias("g"))
        return F.when((i > n - WINDOW) & (i > 0), None).when(size >= LEAST, three).when(i + LONG <= n, twelve)

    out = lines.select("d", "t", F.explode(F.transform("lines", of)).alias("w")).where(F.col("w").isNotNull())
    return out.select("d", F.shiftleft(F.col("t").cast("long"), 32).bitwiseOR(F.col("w.p").cast("long")).alias("at"), "w.h", "w.g")


def repeated(lines: DataFrame) -> DataFrame:
    """The windows whose h occurs more than once."""
    every = windows(lines)
    often = every.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select(F.expr("h ^ 0L").alias("k"))
    return stored(every.join(often, F.col("h") == F.col("k")).select("d", "at", "h", "g"))


def removals(lines: DataFrame, again: DataFrame) -> DataFrame:
    """d, t, n (lines) and ``drop`` (2 * position, plus 1 for a long window, of later occurrences) of each document."""
    first = again.groupBy("h", "g").agg(F.min(F.struct("d", "at")).alias("first")).select(F.expr("h ^ 0L").alias("k"), F.col("g").alias("kg"), "first")
    later = again.join(first, (F.col("h") == F.col("k")) & (F.col("g") == F.col("kg"))).where(F.struct("d", "at") > F.col("first"))
    spots = later.select("d", F.shiftright("at", 32).cast("int").alias("t"), F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("p"), F.lit(None).cast("int").alias("n"))
    whole = lines.select("d", "t", F.lit(None).cast("int").alias("p"), F.size("lines").alias("n"))
    return spots.unionByName(whole).groupBy("d", "t").agg(F.max("n").alias("n"), F.collect_set("p").alias("drop"))


def reduced(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column (its name is returned) of text, n_lines and n_removed."""
    out, d, t, n, drop = spare(docs, "rest", "rest_d", "rest_t", "rest_n", "rest_drop")
    lines = documents(docs)
    again = repeated(lines)
    spots = stored(removals(lines, again))
    discard(lines, again)
    found = spots.select(F.col("d").alias(d), F.col("t").alias(t), F.col("n").alias(n), F.col("drop").alias(drop))
    rows = docs.join(found, (F.coalesce(docs["doc_id"].cast("long"), F.lit(-(1 << 63))) == F.col(d)) & (F.hash(docs["text"]) == F.col(t)) & docs["text"].isNotNull(), "left")

    def rest(lines: Column) -> Column:
        last = F.size(lines) - 1
        spots = F.flatten(F.transform(F.col(drop), lambda p: F.sequence(F.shiftright(p, 1), F.least(F.shiftright(p, 1) + F.when(p % 2 == 1, LONG - 1).otherwise(WINDOW - 1), last))))
        kept = F.array_except(F.sequence(F.lit(0), last), spots)
        return F.struct(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "").alias("text"), F.size(lines).alias("n_lines"), (F.size(lines) - F.size(kept)).alias("n_removed"))

    # Lines are bound once: an expression inside a lambda is evaluated at each step.
    cleaned = F.get(F.transform(F.array(lines_of(F.col("text"))), rest), 0)
    same = F.struct(F.col("text"), F.coalesce(F.col(n), F.lit(0)).alias("n_lines"), F.lit(0).alias("n_removed"))
    return rows.withColumn(out, F.when(F.size(drop) > 0, cleaned).otherwise(same)).drop(d, t, n, drop), out


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with its text reduced, and n_lines, n_removed."""
    rows, rest = reduced(docs)
    return rows.withColumns({k: F.col(rest)[k] for k in ("text", "n_lines", "n_removed")}).drop(rest)


def keep_rest(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated passages, columns unchanged; documents of which nothing is left go."""
    rows, rest = reduced(docs)
    r = F.col(rest)
    out = rows.where((r["n_removed"] == 0) | (F.length(F.trim(r["text"], F.lit(_TRIM))) > 0))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(r["n_removed"] > 0, F.length(r["text"])).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.withColumn("text", r["text"]).select(*docs.columns)
