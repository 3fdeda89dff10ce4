"""Text families: cue segments, their shingles, canonical licence names, split groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import folded, ngrams, tokens

CUES = ["license", "permission", "redistribut", "copyright", "confidential", "warranty"]
#: Fixed names of licence families, most specific first: family, whether it has only/or-later forms, pattern over folded text.
FAMILIES = [
    ("agpl", True, "gnu affero general public license"), ("lgpl", True, "gnu (lesser|library) general public license"), ("gpl", True, "gnu general public license"), ("apache", False, "apache (software )?license"),
    ("mpl", False, "mozilla public license"), ("epl", False, "eclipse public license"), ("mit", False, "mit license"), ("bsd", False, "bsd license|redistribution and use in source and binary"), ("cc-by-nc", False, "cc by-nc|creative commons attribution-noncommercial"),
    ("cc-by", False, "cc by|creative commons attribution"), ("isc", False, "isc license"), ("unlicense", False, "the unlicense"),
]
VERSION = "(?:version|v\\.?) ?([0-9]+(?:\\.[0-9]+)?)"
LATER = "or (any |\\(at your option\\) any )?later"


def segments(text: Column) -> Column:
    """Sentences and lines."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[.!?]\\s+|\\n+"), lambda s: F.trim(s) != "")


def semantic_text(text: Column, cues: list[str] = CUES) -> Column:
    """The segments that hold a cue, or the whole text where none does."""
    has = lambda s: F.exists(F.array(*map(F.lit, cues)), lambda c: F.contains(F.lower(s), c))
    good = F.filter(segments(text), has)
    return F.when(F.size(good) > 0, F.array_join(good, " ")).otherwise(F.coalesce(text, F.lit("")))


def semantic_shingles(text: Column, n: int = 5) -> Column:
    """Distinct word n-grams of the telling segments; a shorter one is one run."""
    return ngrams(tokens(semantic_text(text)), n)


def canonical(text: Column) -> Column:
    """``family-version`` of the licence that a text names first in order of ``FAMILIES``; GNU ones end in -only or -or-later; null without one."""
    t = folded(F.coalesce(text, F.lit("")))
    v = F.regexp_extract(t, VERSION, 1)
    version = F.when(v == "", "").otherwise(F.concat(F.lit("-"), F.when(F.contains(v, F.lit(".")), v).otherwise(F.concat(v, F.lit(".0")))))
    out = F.lit(None).cast("string")
    for name, gnu, pattern in reversed(FAMILIES):
        end = F.when(version == "", "").when(t.rlike(LATER), "-or-later").otherwise("-only") if gnu else F.lit("")
        out = F.when(t.rlike(pattern), F.concat(F.lit(name), version, end)).otherwise(out)
    return out


def split_group(repo: Column, text_hash: Column) -> Column:
    """What must not be split: a repository by its folded name, else the text's hash."""
    return F.coalesce(F.nullif(folded(repo), F.lit("")), text_hash)
