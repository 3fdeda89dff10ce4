"""Rule tables: licence phrases, weighted features, boilerplate markers, routing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: name, expression, weight (0 to 100), pattern over the lower-cased text (RE2 and Java agree on these).
LICENSES = [
    ("apache-2.0", "Apache-2.0", 100.0, "licensed under the apache license, version 2\\.0"),
    ("mit", "MIT", 98.0, "released under the mit license"),
    ("gpl-3.0", "GPL-3.0-only", 96.0, "gnu general public license, version 3"),
    ("cc-by-nc-4.0", "CC-BY-NC-4.0", 95.0, "licensed under cc by-nc 4\\.0"),
    ("spdx", "LicenseRef-tag", 100.0, "spdx-license-identifier: *[a-z0-9.+-]+"),
    ("bsd", "BSD-3-Clause", 92.0, "redistribution and use in source and binary forms"),
    ("mention", "unknown-license-reference", 60.0, "see the license file"),
]
SHARING = [
    ("no_redistribution", 8, "(may|must|shall) not be (re)?distributed"), ("confidential", 7, "(strictly )?confidential"), ("internal_use", 7, "for internal use only"), ("trade_secret", 8, "trade secrets?"),
    ("proprietary", 6, "proprietary (and|information|software|code)"), ("no_disclosure", 8, "(do not|not to be) (share|disclosed?|publish(ed)?)"), ("unpublished", 6, "unpublished (work|source)"), ("need_permission", 6, "without (prior |express )?(written )?permission"),
    ("non_commercial", 5, "non-?commercial|by-nc"), ("export_control", 5, "export control"),
]
LICENSE_CUES = [
    ("licensed_under", 10, "licensed under"), ("released_under", 9, "released under"), ("public_license", 8, "public license"), ("version", 5, "version [0-9]"), ("permission_granted", 9, "permission is hereby granted"),
    ("spdx", 10, "spdx-license-identifier"), ("copyright", 5, "copyright (\\(c\\)|[0-9]{4})"), ("public_domain", 8, "public domain"), ("warranty", 6, "without warrant(y|ies)"),
]
BOUNDARY = [("http_share", 12, "share (button|link|token|dialog)"), ("memory_sharing", 11, "shared? (memory|pointer|state|lock)"), ("license_key_code", 11, "license[_ ]key (check|parser|field)"), ("permission_bits", 11, "(file|directory) permissions?")]
AFFIRMATIVE = "(hereby|strictly|expressly) (granted|prohibited|forbidden|confidential)"
MARKERS = [
    ("apache", "apache license"), ("mit", "mit license"), ("gpl", "gnu general public license"), ("creative_commons", "cc by|creative commons"), ("bsd", "redistribution and use in source"), ("warranty", "without warranty"),
    ("hereby", "permission is hereby granted"), ("all_rights", "all rights reserved"), ("generated", "generated by|do not edit"), ("copyright", "copyright"),
]


def matches(text: Column) -> Column:
    """Array of (rule, expression, score, match_coverage) of the licence rules that hit."""
    low = F.lower(F.coalesce(text, F.lit("")))

    def hit(rule):
        name, expr, weight, pattern = rule
        return F.when(low.rlike(pattern), F.struct(F.lit(name).alias("rule"), F.lit(expr).alias("expression"), F.lit(weight).alias("score"), F.lit(100.0).alias("match_coverage")))

    return F.array_compact(F.array(*map(hit, LICENSES)))


def qualified(found: Column, score: float = 95.0, coverage: float = 95.0) -> Column:
    return F.filter(found, lambda m: (m["score"] >= score) & (m["match_coverage"] >= coverage))


def best_score(found: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(found, lambda m: m["score"])), F.lit(0.0))


def features(text: Column, table: list[tuple[str, int, str]], cues: list[str] = ()) -> Column:
    """(score, names) of the weighted patterns that hit, null if none; a cue, where given, has to occur before any pattern is tried."""
    low = F.lower(F.coalesce(text, F.lit("")))
    score = sum((F.when(low.rlike(p), w).otherwise(0) for _, w, p in table), F.lit(0))
    names = F.array_compact(F.array(*[F.when(low.rlike(p), n) for n, _, p in table]))
    ok = F.lit(True)
    if cues:
        ok = low.contains(cues[0])
        for c in cues[1:]:
            ok = ok | low.contains(c)
    return F.when(ok & (score > 0), F.struct(score.alias("score"), names.alias("names")))


def sharing(text: Column) -> Column:
    return features(text, SHARING)


def license_cues(text: Column) -> Column:
    return features(text, LICENSE_CUES)


def license_base(score: Column) -> Column:
    return F.least(score / 25.0, F.lit(4.0))


def boundary(text: Column) -> Column:
    return features(text, BOUNDARY, ["share", "license", "permission"])


def route(text: Column) -> Column:
    """The class of a text: technical wording first, then sharing limits, licences, random negatives."""
    low = F.lower(F.coalesce(text, F.lit("")))
    hard = boundary(text).isNotNull() & ~low.rlike(AFFIRMATIVE)
    letters = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\p{L}]", ""))
    return (
        F.when(hard & license_cues(text).isNotNull(), "missed_license").when(hard, "irrelevant").when(sharing(text).isNotNull(), "sharing")
        .when(license_cues(text).isNotNull(), "missed_license").when(~low.contains("license") & (letters >= 10), "irrelevant_random")
    )


def markers(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.array_compact(F.array(*[F.when(low.rlike(p), n) for n, p in MARKERS]))


def two_axes(restriction: Column, license: Column) -> Column:
    """Label of two three-valued facts; an unknown one makes it ambiguous."""
    return (
        F.when(restriction.isNull() | license.isNull(), "ambiguous").when(restriction & license, "licensed_with_limits").when(restriction, "limits_only").when(license, "license_only").otherwise("neither")
    )


def missed_license(license: Column, noticed: Column) -> Column:
    return F.when(license & (noticed == F.lit(False)), True).when(license == F.lit(False), False)


def keyword_pattern(words: list[str]) -> str:
    """Whole words or phrases of a list, longest first, any white space between words; works in both regex dialects."""
    uniq = sorted({" ".join(w.lower().split()) for w in words if w.strip()}, key=lambda w: (-len(w), w))
    body = "|".join("\\s+".join(p.replace(".", "\\.").replace("+", "\\+") for p in w.split()) for w in uniq)
    return f"(^|[^\\p{{L}}\\p{{N}}_])({body})([^\\p{{L}}\\p{{N}}_]|$)"
