"""Opening comments of source files: grammar tables and the extractor."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Grammar:
    line: tuple[str, ...] = ()
    block: tuple[tuple[str, str], ...] = ()
    strings: tuple[str, ...] = ('"', "'")
    nested: bool = False


C = Grammar(("//",), (("/*", "*/"),))
HASH = Grammar(("#",))
GRAMMARS = {
    **dict.fromkeys("c cpp csharp java javascript typescript go kotlin swift scala dart objective-c groovy php".split(), C),
    "rust": Grammar(("//",), (("/*", "*/"),), ('"',), True), "swift": Grammar(("//",), (("/*", "*/"),), ('"',), True), "php": Grammar(("//", "#"), (("/*", "*/"),)), "css": Grammar((), (("/*", "*/"),)),
    **dict.fromkeys("shell perl r yaml toml makefile dockerfile cmake elixir julia".split(), HASH), "ruby": Grammar(("#",), (("\n=begin", "\n=end"),)), "python": Grammar(("#",), (('"""', '"""'), ("'''", "'''"))),
    "sql": Grammar(("--",), (("/*", "*/"),), ("'",)), "lua": Grammar(("--",), (("--[[", "]]"),)), "haskell": Grammar(("--",), (("{-", "-}"),), ('"',), True), "ada": Grammar(("--",), (), ('"',)), "vhdl": Grammar(("--",), (), ('"',)),
    **dict.fromkeys("html xml markdown vue svg".split(), Grammar((), (("<!--", "-->"),), ())), "lisp": Grammar((";",), (("#|", "|#"),), ('"',), True), "clojure": Grammar((";",), (), ('"',)), "scheme": Grammar((";",), (("#|", "|#"),), ('"',), True),
    "matlab": Grammar(("%",), (("%{", "%}"),)), "tex": Grammar(("%",), (), ()), "erlang": Grammar(("%",), ()), "prolog": Grammar(("%",), (("/*", "*/"),)), "ocaml": Grammar((), (("(*", "*)"),), ('"',), True), "pascal": Grammar(("//",), (("{", "}"), ("(*", "*)")), ("'",)),
    "fortran": Grammar(("!",), ()), "vb": Grammar(("'",), (), ('"',)), "assembly": Grammar((";", "#"), (("/*", "*/"),)), "batch": Grammar(("REM ", "::"), (), ()), "powershell": Grammar(("#",), (("<#", "#>"),)), "fsharp": Grammar(("//",), (("(*", "*)"),), ('"',), True),
}
ALIASES = {"c++": "cpp", "c#": "csharp", "f#": "fsharp", "js": "javascript", "ts": "typescript", "golang": "go", "bash": "shell", "sh": "shell", "zsh": "shell", "py": "python", "rb": "ruby", "rs": "rust", "kt": "kotlin", "objectivec": "objective-c", "objc": "objective-c", "visualbasic": "vb", "common-lisp": "lisp", "latex": "tex", "asm": "assembly", "scss": "css", "jsx": "javascript", "tsx": "typescript"}
EXTENSIONS = {
    "c": ["c"], "h": ["c", "cpp", "objective-c"], "cc": ["cpp"], "cpp": ["cpp"], "hpp": ["cpp"], "cs": ["csharp"], "java": ["java"], "js": ["javascript"], "ts": ["typescript"], "go": ["go"], "kt": ["kotlin"], "swift": ["swift"], "scala": ["scala"], "m": ["objective-c", "matlab"],
    "rs": ["rust"], "php": ["php"], "css": ["css"], "sh": ["shell"], "pl": ["perl", "prolog"], "r": ["r"], "yml": ["yaml"], "yaml": ["yaml"], "toml": ["toml"], "rb": ["ruby"], "py": ["python"], "sql": ["sql"], "lua": ["lua"], "hs": ["haskell"], "html": ["html"], "xml": ["xml"], "md": ["markdown"],
    "lisp": ["lisp"], "clj": ["clojure"], "tex": ["tex"], "ml": ["ocaml"], "pas": ["pascal"], "f90": ["fortran"], "vb": ["vb"], "asm": ["assembly"], "s": ["assembly"], "bat": ["batch"], "ps1": ["powershell"], "fs": ["fsharp"], "ex": ["elixir"], "jl": ["julia"], "vue": ["vue"], "dart": ["dart"],
}
GUESSES = [("<?xml", "xml"), ("<!doctype html", "html"), ("<html", "html"), ("<?php", "php"), ("#!/usr/bin/env python", "python"), ("#!/usr/bin/python", "python"), ("#!/bin/bash", "shell"), ("#!/bin/sh", "shell"), ("#!/usr/bin/env node", "javascript"), ("%yaml", "yaml")]


def canonical(name: str | None) -> str | None:
    """A language name as a key of ``GRAMMARS``, by aliases and by spaces, underscores and hyphens exchanged."""
    if not name:
        return None
    low = name.strip().lower()
    for x in (low, low.replace("_", "-"), low.replace(" ", "-"), re.sub(r"[\s_-]+", "", low)):
        x = ALIASES.get(x, x)
        if x in GRAMMARS:
            return x
    return None


def guess(content: str) -> str | None:
    head = content[:256].lstrip().lower()
    return next((lang for start, lang in GUESSES if head.startswith(start)), None)


def candidates(language: str | None, path: str | None, content: str) -> list[str]:
    """Languages to try, without repeats: the record's, all of the extension, the content's."""
    ext = path.rsplit("/", 1)[-1].rpartition(".")[2].lower() if path and "." in path.rsplit("/", 1)[-1][1:] else ""
    names = [language, *EXTENSIONS.get(ext, []), ext or None]
    found = list(dict.fromkeys(c for c in map(canonical, names) if c))
    return found or [g for g in [guess(content)] if g]


@lru_cache(maxsize=256)
def opener(g: Grammar) -> re.Pattern:
    marks = sorted({b for b, _ in g.block} | set(g.line) | set(g.strings), key=len, reverse=True)
    return re.compile("|".join(map(re.escape, marks)))


def ranges(text: str, g: Grammar, limit: int) -> list[tuple[int, int, bool]]:
    """(start, end, is a line comment) of comments that start before ``limit``; marks inside strings don't count."""
    out, pos = [], 0
    if text.startswith("#!"):
        pos = (text.find("\n") + 1) or len(text)
    body = "\n" + text if any(b.startswith("\n") for b, _ in g.block) else text
    shift = len(body) - len(text)
    pos += 0
    find = opener(g).search
    while (m := find(body, pos)) and m.start() < limit + shift:
        mark, a = m.group(), m.start()
        end_mark = dict(g.block).get(mark)
        if end_mark is not None:
            depth, z = 1, m.end()
            if g.nested and end_mark != mark:
                both = re.compile(re.escape(mark) + "|" + re.escape(end_mark))
                while depth and (k := both.search(body, z)):
                    depth += 1 if k.group() == mark else -1
                    z = k.end()
                if depth:
                    z = len(body)
            else:
                z = body.find(end_mark, z)
                z = len(body) if z < 0 else z + len(end_mark)
            out.append((max(0, a - shift), z - shift, False))
        elif mark in g.line:
            z = body.find("\n", m.end())
            z = len(body) if z < 0 else z
            out.append((max(0, a - shift), z - shift, True))
        else:
            z = m.end()
            while z < len(body) and body[z] != mark and body[z] != "\n":
                z += 2 if body[z] == "\\" else 1
            z += 1
        pos = max(z, m.end())
    return out


def opening(content: str | None, language: str | None = None, path: str | None = None, rows: int = 10, blanks: int = 5) -> list[dict]:
    """Comments that start in the first ``rows`` lines, neighbours merged: (text, start_line, index)."""
    if not content:
        return []
    text = content.replace("\r\n", "\n").replace("\r", "\n")
    limit = -1
    for _ in range(rows):
        limit = text.find("\n", limit + 1)
        if limit < 0:
            limit = len(text)
            break
    found = {}
    for lang in candidates(language, path, text):
        merged: list[list] = []
        for a, z, line in ranges(text, GRAMMARS[lang], limit):
            if merged:
                gap = text[merged[-1][1] : a]
                if not gap.strip() and (gap.count("\n") <= 1 or line and merged[-1][2] and gap.count("\n") <= blanks + 1):
                    merged[-1][1] = z
                    continue
            merged.append([a, z, line])
        for a, z, _ in merged:
            s = text[a:z].strip()
            if s:
                found.setdefault((a, z, s), text.count("\n", 0, a) + 1)
    ordered = sorted(found.items(), key=lambda x: (x[1], x[0][0]))
    return [{"text": k[2], "start_line": line, "index": i} for i, (k, line) in enumerate(ordered)]


COMMENTS = T.ArrayType(T.StructType().add("text", "string").add("start_line", "integer").add("index", "integer"))


@F.pandas_udf(COMMENTS)  # a type, not its text: workers import this module without a session
def opening_comments(content: pd.Series, language: pd.Series, path: pd.Series) -> pd.Series:
    return pd.Series([opening(c, lang, p) for c, lang, p in zip(content, language, path, strict=True)])


@F.pandas_udf(T.StructType().add("content", "string").add("language", "string"))
def notebook_code(s: pd.Series) -> pd.DataFrame:
    """Joined code cells and kernel language of notebook JSON; anything else stays as it is."""
    out = []
    for x in s:
        code = lang = None
        try:
            doc = json.loads(x)
            cells = [c for c in doc["cells"] if c.get("cell_type") == "code"]
            code = "\n\n".join("".join(c["source"]) if isinstance(c["source"], list) else c["source"] for c in cells)
            meta = doc.get("metadata", {})
            lang = meta.get("kernelspec", {}).get("language") or meta.get("language_info", {}).get("name")
        except (TypeError, ValueError, KeyError, AttributeError):
            code = x
        out.append((code, lang))
    return pd.DataFrame(out, columns=["content", "language"])


def html_comments(html: Column) -> Column:
    """Array of the trimmed comments of a page, by a built-in expression."""
    return F.transform(F.regexp_extract_all(html, F.lit("(?s)<!--(.*?)-->"), F.lit(1)), lambda c: F.trim(c))
