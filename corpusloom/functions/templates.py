"""Template form of a comment: what stays when names, years, links and decoration go."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DECOR = re.compile(r"^[\s/*#;!\-=~_|%.<>+:@\"'`]+|[\s*/#=\-~_|]+$")
_META = re.compile(r"^(author|authors|date|created|file|filename|version|since|maintainer|contact)\b\s*[:=]", re.I)
_LEGAL = re.compile(r"licen[cs]e|copyright|permission|warrant|redistribut|confidential|proprietary", re.I)
_SECTION = re.compile(r"^(description|usage|synopsis|example|examples|changelog|history|todo)\b\s*:?\s*$", re.I)
_SUBS = [
    (re.compile(r"https?://\S+|www\.\S+"), "<url>"), (re.compile(r"[\w.+-]+@[\w-]+\.[\w.]+"), "<email>"), (re.compile(r"\b(?:19|20)\d\d(?:\s*[-,]\s*(?:19|20)?\d\d)*\b"), "<year>"),
    (re.compile(r"\b(?:v|version\s+)?\d+(?:\.\d+)+\b", re.I), "<version>"), (re.compile(r"\b(?=[0-9a-f]*\d)[0-9a-f]{8,}\b", re.I), "<hex>"), (re.compile(r"(copyright\s*(?:\(c\)|©)?\s*(?:<year>\s*)?(?:by\s+)?)[^.<\n]{2,60}", re.I), r"\1<holder>"),
    (re.compile(r"\b\d+\b"), "<number>"),
]


def template(text: str | None) -> str | None:
    """The template form; under 40 characters the plain folded text."""
    if text is None:
        return None
    plain = " ".join(text.casefold().split())
    kept = []
    for line in text.splitlines():
        s = _DECOR.sub("", line)
        if _SECTION.match(s):
            break
        if not s or (_META.match(s) and not _LEGAL.search(s)):
            continue
        for pattern, new in _SUBS:
            s = pattern.sub(new, s)
        kept.append(s)
    out = " ".join(" ".join(kept).casefold().split())
    return out if len(out) >= 40 else plain


@F.pandas_udf(T.StringType())  # a type, not its text: no session is needed to import this
def template_of(s: pd.Series) -> pd.Series:
    return s.map(template)
