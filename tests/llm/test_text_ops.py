"""Line dedup, fingerprints, decontamination and HTML text against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import decontam, html_text, line_dedup, queries, sketch
from corpusloom.llm.common import read

LINE = re.compile(line_dedup.LINE.replace("\\\\", "\\"))


def keys(text):
    lines = LINE.findall(text or "")
    return lines, [x.replace("\t", " ").strip("\t\n\x0b\x0c\r ").lower() for x in lines]


def brute_dedup(rows):
    """{(id, text): (n_lines, kept text)} by a walk in order over all windows."""
    seen, out = set(), {}
    for d, t in sorted({(-(1 << 63) if d is None else d, t) for d, t in rows if t is not None}):
        lines, k = keys(t)
        gone = set()
        for i in range(max(len(k) - 2, 1) if k else 0):
            w = tuple(k[i : i + 3]) + ("",) * (3 - len(k[i : i + 3]))
            if sum(map(len, w)) < line_dedup.LEAST:
                w = tuple(k[i : i + 12])
                if len(w) < 12:
                    continue
            if w in seen:
                gone.update(range(i, min(i + len(w), len(k))))
            seen.add(w)
        out[d, t] = (len(lines), "".join(x for i, x in enumerate(lines) if i not in gone) if gone else t)
    return out


PASSAGE = " ".join(f"shared{i} passage word{i}{'.' if i % 9 == 8 else ''}" for i in range(40))
ROWS = [
    (3, "Start one here. " + PASSAGE + " And the end of it."), (5, "Other begin. " + PASSAGE), (None, PASSAGE), (7, None), (8, ""), (9, "short\nlines\nonly"), (10, "short\nlines\nonly"),
    (11, "repeat of a longer line one\n" * 9), (5, "Other begin. " + PASSAGE), (12, "   \n\t "), (13, "x" * 50_000 + " " + "y " * 3000),
    (14, "own\n" + "\n".join("abcdefghijklmno") + "\nrest"), (15, "\n".join("abcdefghijklmno")), (16, "few\na\nb\nc\nd"),
]


def test_line_dedup_equals_a_walk(spark):
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in ROWS], "doc_id long, text string, d int, h int, drop int, rest int, rest_d int, _drop int")
    got = line_dedup.dedup(df).collect()
    want = brute_dedup(ROWS)
    assert len(got) == len(ROWS)
    both = {}
    for r in got:
        both.setdefault(-(1 << 63) if r.doc_id is None else r.doc_id, []).append(r)
    for (d, t), (n, kept) in want.items():
        assert any(r.n_lines == n and r.text == kept for r in both[d]), (d, t[:40])
    assert both[7][0].text is None and both[8][0].text == ""
    assert {r.d for r in got} == {1} and line_dedup.dedup(df.limit(0)).count() == 0
    assert line_dedup.keep_rest(df).columns == df.columns


@pytest.mark.parametrize("style", ["prose", "no marks", "shouted", "upper"])
def test_passages_are_found_at_every_phase(spark, style):
    rng = random.Random(style)
    word = lambda: "".join(rng.choice("eeeeeettttaaaaoooiiinnnssshhhrrrddllcumwfgypbvk") for _ in range(rng.choice([2, 3, 5, 8])))
    mark = {"prose": lambda: rng.choice(["", "", "", "", "", ",", "."]), "no marks": str, "shouted": lambda: "!!", "upper": str}[style]
    say = (lambda: word().upper() + mark()) if style in ("shouted", "upper") else (lambda: word() + mark())
    rows, n = [], 60
    for k in range(40):
        core = " ".join(say() for _ in range(n))
        for i in range(2):
            rows.append((2 * k + i, " ".join([*(say() for _ in range(20 + (k * 7 if i else k) % 16)), core, *(say() for _ in range(10))])))
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[2 * k] == 0 for k in range(40))
    assert sum(got[2 * k + 1] >= 3 for k in range(40)) >= 39


def test_line_dedup_on_documents(spark, small):
    docs = read(spark, small, "documents").select("doc_id", "text")
    want = brute_dedup([tuple(r) for r in docs.collect()])
    got = {r.doc_id: r.text for r in line_dedup.dedup(docs).collect()}
    for (d, _), (_, kept) in want.items():
        assert got[d] == kept


def grams5(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def test_fingerprints_of_short_texts_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, None if i == 3 else "" if i == 4 else " ".join(rng.choice("abc") for _ in range(rng.choice([1, 3, 5, 9, 30])))) for i in range(40)] + [(None, "null id"), (0, "same id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sketch.edited(df).collect()
    order = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0]), reverse=True)
    assert len(got) == len(rows)
    at = {r[0]: i for i, r in enumerate(order) if r[0]}
    for r in got:
        if not r.doc_id or r.doc_id == 1:  # two rows share id 0; either may follow 1
            continue
        t, u = order[at[r.doc_id]][1] or "", order[(at[r.doc_id] + 1) % len(order)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + u[:half]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        for near, other in ((r.near_edited, e), (r.near_next, u)):
            a, b = grams5(t), grams5(other)
            assert near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert r.n_distinct == len(grams5(t))
    assert sketch.edited(df.limit(0)).count() == 0


def test_fingerprint_query(spark, small):
    docs = {r.doc_id: r.text or "" for r in read(spark, small, "documents").select("doc_id", "text").collect()}
    ids = sorted(docs, reverse=True)
    after = {d: docs[ids[(i + 1) % len(ids)]] for i, d in enumerate(ids)}
    prints = {}
    for r in queries.op7_bottom_k(spark, small).collect():
        t = docs[r.doc_id]
        half = len(t) // 2
        e = t[: len(t) - half] + after[r.doc_id][:half]
        assert r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
        assert prints.setdefault(e, r.edited_fingerprint) == r.edited_fingerprint
        a, b = grams5(t), grams5(e)
        assert abs(r.near_edited - (len(a & b) / len(a | b) if a | b else 1.0)) < 0.3


def test_sketches_merge_and_estimate(spark):
    a = " ".join(f"w{i}" for i in range(3000))
    b = " ".join(f"w{i}" for i in range(1500, 4500))
    df = spark.createDataFrame([(1, a, b)], "k int, a string, b string").select("k", sketch.sketch(F.col("a")).alias("a"), sketch.sketch(F.col("b")).alias("b"), sketch.sketch(F.concat_ws(" ", "a", "b")).alias("ab"))
    r = df.select(sketch.resemblance(F.col("a"), F.col("b")).alias("j"), sketch.containment(F.col("a"), F.col("b")).alias("c"), sketch.distinct_count(F.col("a")).alias("n")).first()
    assert abs(r.j - 1 / 3) < 0.2 and abs(r.c - 0.5) < 0.25 and abs(r.n - 2996) < 1000
    parts = df.select("k", F.explode(F.array("a", "b")).alias("sketch"))
    merged = sketch.merge_all(parts, ["k"]).first().sketch
    assert merged == df.select(sketch.merge(F.col("a"), F.col("b")).alias("m")).first().m


def brute_hits(docs, items):
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    grams = [(i, tuple(w[k : k + 8])) for i, t in items if i is not None and (w := split(t)) for k in range(max(len(w) - 7, 1))]
    out = []
    for d, t in docs:
        w, hit, ids = split(t), set(), set()
        spots = {}
        for k in {len(g) for _, g in grams}:
            for i in range(len(w) - k + 1):
                spots.setdefault(tuple(w[i : i + k]), []).append(i)
        for item, g in grams:
            for i in spots.get(g, ()):
                hit.update(range(i, i + len(g)))
                ids.add(str(item))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(ids), digest, len(ids) >= 2))
    return sorted(out, key=str)


def test_decontamination_equals_brute_force(spark, small, monkeypatch):
    want = brute_hits([tuple(r) for r in read(spark, small, "documents").select("doc_id", "text").collect()], [tuple(r) for r in read(spark, small, "benchmark").select("item_id", "text").collect()])
    assert any(w[2] for w in want)
    assert sorted((tuple(r) for r in queries.op8_benchmark_hits(spark, small).collect()), key=str) == want
    monkeypatch.setattr(decontam, "BOUND", 200)  # many slices
    assert sorted((tuple(r) for r in queries.op8_benchmark_hits(spark, small).collect()), key=str) == want


@pytest.mark.parametrize("bound", [2_000_000, 8])
def test_decontamination_of_odd_rows(spark, monkeypatch, bound):
    monkeypatch.setattr(decontam, "BOUND", bound)
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "Keep This. one two-three FOUR five six seven eight! Tail", 0), (3, "tiny item here", 0), (None, "zzz", 0)], "doc_id long, text string, hit_d int")
    bench = spark.createDataFrame([(1, "one two three four five six seven eight"), (2, "Tiny, item"), (None, "zzz"), (4, None), (5, "...")], "item_id long, text string")
    got = {(r.doc_id, r.n_words): (r.n_hit, r["items"]) for r in decontam.find(docs, bench).collect()}
    assert got == {(1, 0): (0, []), (2, 0): (0, []), (3, 11): (8, ["1"]), (3, 3): (2, ["2"]), (None, 1): (0, [])}
    assert {r.text for r in decontam.clean(docs, bench).collect()} == {None, "", "zzz"}
    assert {r.text for r in decontam.clean(docs, bench, drop=False).collect()} == {None, "", "zzz", "Keep This. ! Tail", " here"}
    assert decontam.find(docs.limit(0), bench).count() == 0 and decontam.clean(docs, bench.limit(0)).count() == 5


PAGES = {
    "<p>One<p>Two": "One\n\nTwo", "<ul><li>a<li>b<ol><li>c</ol></ul>": "- a\n- b\n  1. c", "<div style='display:none'>no</div>yes<script>var a</script>": "yes", "a<br>b": "a\nb", "&lt;b&gt; &amp; x": "<b> & x",
    "<table><tr><th>Name<th>N<tr><td>long name<td>1</table>": "Name      | N\nlong name | 1", "<pre>  a\n    b</pre>": "  a\n    b", "": "", "<b>unclosed": "unclosed", "x</div></p>y": "x\n\ny", "<p hidden>h</p><p>v": "v", "<title>t</title><body>b": "b",
    "<table><tr><td rowspan=2>A<td>B<tr><td>C</table>": "A | B\n    C", "<dialog open>hi</dialog><dialog>no</dialog>": "hi", "<select><option>a<option>b</select>": "a\nb", "<svg><text>t</text><title>x</title></svg>": "t",
    "<div style='visibility:hidden'>a<b style='visibility:visible'>b</b></div>": "b", "<table><tr><td colspan=2>wide one here<td>z<tr><td>a<td>b<td>c</table>": "wide one here | z\na | b         | c", "<q>x</q>": '"x"',
    "<table><tr><td>a<td><table><tr><td>1<td>2<tr><td>33<td>4</table></table>": "a | 1  | 2\n  | 33 | 4", "<ol start=3><li>x<li value=9>y<li>z</ol>": "3. x\n9. y\n10. z", "\u0130<script>x</script>shown": "\u0130shown", "<input type=submit value=Go><input type=hidden value=no>": "Go", "a < b": "a < b",
}


@pytest.mark.parametrize("page", list(PAGES))
def test_html_layout(page):
    assert html_text.text_of(page) == PAGES[page]


def planted_page(rng):
    """A page of random nesting, with the words that it shows and hides by the rules of display and visibility."""
    shown, lost, n = [], [], iter(range(10**6))

    def words(seen):
        out = [f"w{next(n)}x" for _ in range(rng.randrange(1, 4))]
        (shown if seen else lost).extend(out)
        return " ".join(out)

    def block(depth, displayed, seen):
        kind = rng.choice(["text", "text", "p", "div", "b", "ul", "table", "none", "hidden", "vis", "again", "script", "comment", "dialog", "open", "pre", "li", "select"])
        if depth > 5 or kind == "text":
            return words(displayed and seen) + " "
        kids = lambda d=displayed, s=seen: "".join(block(depth + 1, d, s) for _ in range(rng.randrange(1, 4)))
        if kind == "table":
            return "<table>" + "".join("<tr>" + "".join(f"<td{rng.choice(['', ' colspan=2', ' rowspan=2'])}>{kids()}" for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 4))) + "</table>"
        plain = {"p": "p", "div": "div", "b": "b", "pre": "pre"}
        if kind in plain:
            return f"<{plain[kind]}>{kids()}</{plain[kind]}>"
        if kind in ("ul", "li"):
            return "<ul>" + "".join(f"<li>{kids()}" for _ in range(rng.randrange(1, 3))) + "</ul>"
        if kind == "none":
            return f"<div style='color:red; display: none'>{kids(False)}</div>"
        if kind == "hidden":
            return f"<section hidden>{kids(False)}</section>"
        if kind == "vis":
            return f"<div style='visibility:hidden'>{kids(displayed, False)}</div>"
        if kind == "again":
            return f"<div style='visibility:visible'>{kids(displayed, True)}</div>"
        if kind in ("dialog", "open"):
            return f"<dialog{' open' * (kind == 'open')}>{kids(displayed and kind == 'open')}</dialog>"
        if kind == "select":
            return f"<select><option>{words(displayed and seen)}<option>{words(displayed and seen)}</select>"
        return f"<script>{words(False)}</script>" if kind == "script" else f"<!-- {words(False)} -->"

    return "".join(block(0, True, True) for _ in range(6)), shown, lost


def test_html_emits_all_visible_words_and_no_others():
    rng = random.Random(8)
    for _ in range(400):
        page, shown, lost = planted_page(rng)
        got = re.findall(r"w\d+x", html_text.text_of(page))
        assert sorted(got) == sorted(shown), page
        assert not set(got) & set(lost)


def brute_table(cells):
    wide = [max(len(r[k]) for r in cells) for k in range(len(cells[0]))]
    return "\n".join(" | ".join(x.ljust(w) for x, w in zip(r, wide, strict=True)).rstrip() for r in cells)


def test_html_tables_are_aligned():
    rng = random.Random(2)
    for _ in range(60):
        cells = [["x" * rng.randrange(1, 30) for _ in range(4)] for _ in range(rng.randrange(1, 6))]
        page = "<table>" + "".join("<tr>" + "".join(f"<td>{c}" for c in r) for r in cells) + "</table>"
        assert html_text.text_of(page) == brute_table(cells)
    long = "<table><tr><td>" + "word " * 100 + "<td>b<tr><td>" + "y" * 200 + "<td>d</table>"
    lines = html_text.text_of(long).split("\n")
    assert sum(x.count("word") for x in lines) == 100 and lines[-1] == "y" * 200 + " | d" and lines[0].endswith(" | b")


def test_html_takes_hostile_pages_in_time():
    import time

    pages = {
        "tables": "<table><tr><td>" * 10_000 + "deep", "tables2": "<table><tr><td>x<td>" * 10_000 + "deep", "quotes": '<a "' * 250_000, "tags": "<a " * 330_000, "ends": "<b><table><tr><td>" + "<div>" * 40_000 + "</b>" * 80_000 + "x",
        "cell": "<table><tr><td>" + "w " * 250_000 + "<tr><td>a<td>b" * 20_000, "spans": "<table>" + "<tr><td colspan=1000 rowspan=65534>x" * 20_000, "marks": "<" * 1_000_000, "comments": "<!--" * 250_000, "lists": "<ul><li>" * 5_000 + "deep",
    }
    for name, page in pages.items():
        began = time.process_time()
        text = html_text.text_of(page)
        assert time.process_time() - began < 20, name
        assert "deep" not in page or text.split()[-1] == "deep"


def test_html_query_keeps_the_words_of_pages(spark, small):
    from html.parser import HTMLParser

    class Words(HTMLParser):
        def __init__(self):
            super().__init__()
            self.text = []

        def handle_data(self, data):
            self.text.append(data)

    pages = read(spark, small, "pages")
    got = queries.op10_layout_text(spark, small).toPandas().set_index("page_id").text
    for r in pages.collect():
        clean = re.sub(r"(?is)<(script|style|head|template|title|noscript)\b.*?</\1\s*>|<!--.*?-->", " ", r.html or "")
        p = Words()
        p.feed(clean)
        hidden = re.search(r"(?i)display\s*:\s*none|\shidden\b|visibility", clean)
        have = set((got[r.page_id] or "").split())
        lost = [w for w in " ".join(p.text).split() if w not in have and w not in (got[r.page_id] or "")]
        assert hidden or not lost, (r.page_id, lost[:10])


def test_html_odd_rows(spark):
    deep = "<div>" * 5000 + "deep" + "</div>" * 3
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, deep, "y"), (3, "<<>><a <b", "z")], "page_id long, html string, text string")
    got = html_text.extract(df).collect()
    assert len(got) == 4 and sorted(r.text or "" for r in got)[-1] == "deep"
    assert html_text.extract(df.limit(0)).columns == ["page_id", "text"]
    assert html_text.extract(df, out="shown").columns == ["page_id", "text", "shown"]
