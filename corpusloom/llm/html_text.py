"""Layout-aware text of HTML pages.

One left-to-right scan makes a tree, with implied tags (html, head, body, p, li,
dt/dd, options, table parts); rendering walks it by display and visibility
rules.  Not displayed: script, style, head, template, closed dialogs, fallback
content of media and frames, ``hidden`` and ``display:none`` elements; text
under ``visibility:hidden`` is left out until a descendant is visible again.
Only inline styles are read, and closed ``details`` are emitted whole, since a
reader can open them.  Blocks are set apart by line breaks (paragraphs and
headings by an empty line), lists have bullets or numbers indented by depth,
``pre`` keeps its white space, images give their alt text, inputs the value
they show.

Table cells stand in aligned columns.  Cells wrap at ``WRAP`` characters, so
that one long cell doesn't widen all rows; a longer word sticks out of its
column and nothing is cut off.  Columns line up within the first ``WIDE``
characters of a line; cells farther right follow each other.  Spans reach as far as the HTML standard allows
(1,000 columns, 65,534 rows); a cell that spans rows stands in the first of
them.  A table of a single cell is a plain block; other nested tables keep
their lines within their cell.

Time and memory grow with the page: the scan never looks at a character twice
but for one failing search to the end, open elements are found by name, and
nesting needs no recursion.

Cases: a null page gives a null text, an empty one an empty text; unclosed and
misnested tags, stray end tags, deep nesting, very long pages and unknown
entities never fail; a tag that the page's end cuts off is dropped, as browsers
do; repeated rows are rendered each; an empty table gives no rows; extra columns
are carried through, but a column with the result's name (``text``) is replaced.
"""

from __future__ import annotations

import html as _html
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, chunks

OPEN = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*+)|(!--)|[!?/])")
#: What stands in a tag behind its name, up to ``>``; quotes count behind ``=`` only.
REST = re.compile(r"((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
ATTR = re.compile(r"([^\s=/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
COMMENT_END = re.compile(r"--!?>")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("script style head template title desc metadata defs meta link base noscript iframe canvas datalist audio video noframes noembed area param source track rp progress meter annotation annotation-xml".split())
BLOCK = frozenset("html body address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot textarea th thead tr ul caption text".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr".split())
CLOSES_P = BLOCK - frozenset("html body li dd dt td th tr tbody thead tfoot caption legend option optgroup select textarea text".split())
CELL, PARTS = frozenset(("td", "th")), frozenset("tbody thead tfoot tr td th caption colgroup".split())
#: A start tag ends the open elements of its first set, up to one of its second.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "optgroup", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": (CELL, {"tr", "table"}), "th": (CELL, {"tr", "table"}), "tbody": (PARTS, {"table"}), "thead": (PARTS, {"table"}), "tfoot": (PARTS, {"table"}), "body": ({"head"}, {"html"}),
}
HEAD_ONLY = frozenset("base link meta script style title noscript template".split())
SCOPE = frozenset("table td th caption html template button object".split())
HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
TABLE = frozenset("table tr td th tbody thead tfoot caption".split())
SPACE = re.compile(r"[ \t\n\r\f]+")
SHOWN_INPUT = frozenset("text search url tel email number submit reset button date month week time datetime-local".split())
WRAP, COLS, ROWS, WIDE = 80, 1000, 65_534, 2000


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.kids = tag, attrs, []

    def get(self, name: str) -> str | None:
        if name not in self.attrs.lower():
            return None
        for m in ATTR.finditer(self.attrs):
            if m[1].lower() == name:
                return _html.unescape(next((g for g in m.groups()[1:] if g is not None), ""))
        return None

    def number(self, name: str, most: int) -> int | None:
        v = (self.get(name) or "").strip()
        return min(int(v[:12]), most) if v.isascii() and v.isdigit() else None


class Open:
    """The open elements, with the places of each name."""

    def __init__(self, root: Node):
        self.nodes: list[Node] = []
        self.at: dict[str, list[int]] = {}
        self.push(root)

    def push(self, n: Node) -> None:
        self.at.setdefault(n.tag, []).append(len(self.nodes))
        self.nodes.append(n)

    def place(self, names) -> int:
        """The innermost open element of these names, or -1."""
        return max((self.at[t][-1] for t in names if self.at.get(t)), default=-1)

    def close(self, to: int) -> None:
        """Ends all elements from ``to`` on; the root stays."""
        while len(self.nodes) > max(1, to):
            self.at[self.nodes.pop().tag].pop()

    @property
    def top(self) -> Node:
        return self.nodes[-1]


def parse(page: str) -> Node:
    """The element tree of a page; kids are nodes and strings."""
    root = Node("html")
    stack, pos, size = Open(root), 0, len(page)

    def text(s: str) -> None:
        if stack.top.tag == "head" and not s.isspace():
            stack.close(len(stack.nodes) - 1)
        stack.top.kids.append(_html.unescape(s) if "&" in s else s)

    while pos < size:
        m = OPEN.search(page, pos)
        if m is None:
            text(page[pos:])
            break
        if m.start() > pos:
            text(page[pos : m.start()])
        if m[3]:  # a comment
            if page.startswith((">", "->"), m.end()):
                pos = page.index(">", m.end()) + 1
                continue
            end = COMMENT_END.search(page, m.end())
            pos = end.end() if end else size
            continue
        if m[2] is None:  # a declaration or a stray mark
            pos = page.find(">", m.end()) + 1 or size
            continue
        rest = REST.match(page, m.end())
        if rest is None:
            break
        pos, name, attrs = rest.end(), m[2].lower(), rest[1]
        if m[1]:
            end_tag(stack, name)
        else:
            node = start_tag(stack, name, attrs)
            if node is not None and name in RAW:
                end = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, pos)
                raw = page[pos : end.start() if end else size]
                node.kids.append(_html.unescape(raw) if name in ("textarea", "title") else raw)
                pos = (page.find(">", end.end()) + 1 or size) if end else size
    return root


def end_tag(stack: Open, name: str) -> None:
    if name == "p" and not stack.at.get("p"):
        stack.top.kids.append(Node("p"))
    elif name == "br":
        stack.top.kids.append(Node("br"))
    else:
        at = stack.place(HEADS if name in HEADS else (name,))
        if at > 0 and (name in SCOPE or name in TABLE or at > stack.place(SCOPE)):
            stack.close(at)


def start_tag(stack: Open, name: str, attrs: str) -> Node | None:
    """Puts a new element in its place and returns it; None for a repeated html or body."""
    if name in ("html", "body") and stack.at.get(name):
        return None
    if stack.top.tag == "head" and name not in HEAD_ONLY:
        stack.close(len(stack.nodes) - 1)
    if name in IMPLIED:
        names, stop = IMPLIED[name]
        while (at := stack.place(names)) > stack.place(stop):
            stack.close(at)
    if name in CLOSES_P and (at := stack.place(("p",))) > stack.place(SCOPE):
        stack.close(at)
    if name in HEADS and stack.top.tag in HEADS:
        stack.close(len(stack.nodes) - 1)
    if name in CELL and stack.top.tag in ("table", "tbody", "thead", "tfoot"):
        row = Node("tr")
        stack.top.kids.append(row)
        stack.push(row)
    node = Node(name, attrs)
    stack.top.kids.append(node)
    if name not in VOID and name not in RAW and (name in BLOCK or not attrs.endswith("/")):
        stack.push(node)
    return node


def style_of(n: Node) -> dict[str, str]:
    out: dict[str, str] = {}
    if "style" in n.attrs.lower():
        for part in (n.get("style") or "").lower().split(";"):
            k, _, v = part.partition(":")
            out[k.strip()] = v.replace("!important", "").strip()
    return out


def displayed(n: Node, style: dict[str, str]) -> bool:
    if n.tag in HIDDEN or style.get("display") == "none":
        return False
    if not n.attrs:
        return n.tag != "dialog"
    if n.tag == "dialog" and n.get("open") is None:
        return False
    return "display" in style or n.get("hidden") is None


class Writer:
    """Lines of text under a prefix, with collapsed white space and blank lines between spaced blocks."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.fixed: set[int] = set()  # lines that must not be wrapped
        self.lists: list[list] = []
        self.space = self.blank = False
        self.pre = 0
        self.prefix, self.first = "", None

    def text(self, s: str) -> None:
        if self.pre:
            *whole, last = s.replace("\r\n", "\n").split("\n")
            for x in whole:
                self.raw("".join(self.parts) + x, True)
                self.parts = []
            if last:
                self.parts.append(last)
            return
        s = SPACE.sub(" ", s)
        if s == " " or not s:
            self.space |= bool(self.parts) and s == " "
            return
        if self.parts and (self.space or s[0] == " "):
            self.parts.append(" ")
        self.space = s[-1] == " "
        self.parts.append(s.strip(" "))

    def end_line(self) -> None:
        if self.parts:
            self.raw("".join(self.parts), self.pre > 0)
            self.parts, self.space = [], False

    def raw(self, line: str, fixed: bool = False) -> None:
        if self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        lead = self.first if self.first is not None else self.prefix
        self.first = None
        if fixed:
            self.fixed.add(len(self.lines))
        self.lines.append((lead + line).rstrip())

    def gap(self) -> None:
        self.end_line()
        self.blank = bool(self.lines)


def wrapped(line: str) -> list[str]:
    """``line`` in pieces of at most ``WRAP`` characters, cut at spaces only."""
    out = []
    while len(line) > WRAP:
        at = line.rfind(" ", 1, WRAP + 1)
        if at < 1 or not line[:at].strip():
            at = line.find(" ", WRAP)
            if at < 0:
                break
        out.append(line[:at].rstrip())
        line = line[at + 1 :].lstrip()
    return [*out, line] if line or not out else out


class Cell:
    __slots__ = ("node", "seen", "cols", "rows", "lines")

    def __init__(self, node: Node, seen: bool):
        self.node, self.seen, self.lines = node, seen, [""]
        self.cols, self.rows = node.number("colspan", COLS) or 1, node.number("rowspan", ROWS)
        self.rows = 1 if self.rows is None else self.rows or ROWS  # 0: all rows that follow


def rows_of(top: Node, seen: bool) -> tuple[list[list[Cell]], list]:
    """The rows of a table, and what stands in it outside of rows."""
    rows, loose, todo = [], [], [(k, seen) for k in reversed(top.kids)]
    while todo:
        n, seen = todo.pop()
        if isinstance(n, str):
            if n and not n.isspace():
                loose.append((n, seen))
            continue
        style = style_of(n)
        if not displayed(n, style) or n.tag in ("col", "colgroup"):
            continue
        if n.tag not in ("tbody", "thead", "tfoot", "tr"):
            loose.append((n, seen))
            continue
        seen = visible(style, seen)
        if n.tag != "tr":
            todo.extend((k, seen) for k in reversed(n.kids))
            continue
        cells = []
        for c in n.kids:
            if isinstance(c, str):
                if c and not c.isspace():
                    cell = Node("td")
                    cell.kids.append(c)
                    cells.append(Cell(cell, seen))
            elif displayed(c, s := style_of(c)):
                if c.tag not in CELL:
                    cell = Node("td")
                    cell.kids.append(c)
                    c, s = cell, {}
                cells.append(Cell(c, visible(s, seen)))
        rows.append(cells)
    return rows, loose


def visible(style: dict[str, str], seen: bool) -> bool:
    v = style.get("visibility")
    return seen if v in (None, "", "inherit") else v not in ("hidden", "collapse")


def lay_out(rows: list[list[Cell]]) -> Iterator[str]:
    """The lines of a table with aligned columns."""
    spans: list[tuple[int, int, int]] = []  # columns from, to, that a cell above fills down to a row; ascending, not touching if alike
    placed: list[list[tuple[int, Cell]]] = []
    widths: dict[int, int] = {}
    wide: list[tuple[int, Cell, int]] = []
    for r, cells in enumerate(rows):
        spans = [x for x in spans if x[2] > r]
        at, i, row, added = 0, 0, [], []
        for c in cells:
            while i < len(spans) and spans[i][0] <= at:
                at = max(at, spans[i][1])
                i += 1
            row.append((at, c))
            most = max((len(x) for x in c.lines), default=0)
            if c.cols == 1:
                widths[at] = max(widths.get(at, 0), most)
            else:
                widths.setdefault(at, 0)
                wide.append((at, c, most))
            if c.rows > 1:
                added.append((at, at + c.cols, min(r + c.rows, len(rows))))
            at += c.cols
        placed.append(row)
        if added and len(spans) + len(added) <= COLS:
            spans = merged(sorted(spans + added))
    used = sorted(widths)
    for at, c, most in wide:  # a spanning cell that needs more widens its last used column
        cols = used[bisect_left(used, at) : bisect_left(used, at + c.cols)]
        lack = most - sum(widths[k] for k in cols) - 3 * (len(cols) - 1)
        if lack > 0:
            widths[cols[-1]] += lack
    start, x = {}, 0
    for k in used:
        start[k] = x
        x = min(x + min(widths[k], WRAP) + 3, WIDE)
    for row in placed:
        if not any(any(c.lines) for _, c in row):
            continue
        for k in range(max(len(c.lines) for _, c in row)):
            parts, n = [], 0
            for i, (at, c) in enumerate(row):
                lead = " " * max(0, start[at] - (3 if i else 0) - n) + (" | " if i else "")
                piece = c.lines[k] if k < len(c.lines) else ""
                parts += [lead, piece]
                n += len(lead) + len(piece)
            yield "".join(parts).rstrip()


def merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out: list[tuple[int, int, int]] = []
    for a, b, until in spans:
        if out and out[-1][1] >= a and out[-1][2] == until:
            out[-1] = (out[-1][0], max(b, out[-1][1]), until)
        else:
            out.append((a, b, until))
    return out


def render(root: Node) -> str:
    """The text of a tree; an explicit stack of nodes and closing acts, so that depth is no limit."""
    outs = [Writer()]
    todo: list = [(root, True)]
    while todo:
        node, seen = todo.pop()
        if callable(node):
            node()
        elif isinstance(node, str):
            if seen:
                outs[-1].text(node)
        else:
            element(node, seen, outs, todo)
    outs[0].end_line()
    return "\n".join(outs[0].lines)


def element(node: Node, seen: bool, outs: list[Writer], todo: list) -> None:
    style = style_of(node)
    if not displayed(node, style):
        return
    out, tag, seen = outs[-1], node.tag, visible(style, seen)
    later: Callable[[Callable], None] = lambda act: todo.append((act, None))
    if tag == "br":
        if out.pre:
            out.text("\n")
        elif out.parts:
            out.end_line()
        elif not out.blank:
            out.blank = bool(out.lines)
        return
    if tag == "img" or tag == "input":
        kind = (node.get("type") or "text").lower() if tag == "input" else "image"
        shown = node.get("alt") if kind == "image" else (node.get("value") or node.get("placeholder")) if kind in SHOWN_INPUT else None
        if shown and seen:
            out.text(shown)
        return
    if tag == "table":
        table(node, seen, outs, todo)
        return
    if tag in SPACED and not (out.lists and tag in ("ul", "ol")):
        out.gap()
        if tag == "hr":
            return
        later(out.gap)
    elif tag in BLOCK:
        out.end_line()
        later(out.end_line)
    if tag == "pre":
        pre(node, out, later)
    elif tag in ("ul", "ol", "menu"):
        start = node.get("start") if tag == "ol" else None
        out.lists.append([tag == "ol", int(start) if start and re.fullmatch(r"-?[0-9]{1,9}", start) else 1])
        later(out.lists.pop)
    elif tag == "li":
        mark = "- "
        if out.lists and out.lists[-1][0]:
            n = node.number("value", 10**9)
            out.lists[-1][1] = out.lists[-1][1] if n is None else n
            mark = f"{out.lists[-1][1]}. "
            out.lists[-1][1] += 1
        indent(out, out.prefix + mark, out.prefix + " " * len(mark), later)
    elif tag in ("blockquote", "dd"):
        indent(out, None, out.prefix + "    ", later)
    elif tag == "q" and seen:
        out.text('"')
        later(lambda: out.text('"'))
    todo.extend((k, seen) for k in reversed(node.kids))


def indent(out: Writer, first: str | None, prefix: str, later: Callable) -> None:
    before = out.prefix
    out.prefix, out.first = prefix, first if first is not None else out.first

    def back() -> None:
        out.end_line()
        out.prefix = before
        if first is not None:
            out.first = None

    later(back)


def pre(node: Node, out: Writer, later: Callable) -> None:
    kids = node.kids
    if kids and isinstance(kids[0], str) and kids[0][:1] == "\n":
        kids[0] = kids[0].lstrip("\n")
    out.pre += 1
    at = len(out.lines)

    def done() -> None:
        out.end_line()
        out.pre -= 1
        while len(out.lines) > at and not out.lines[-1]:
            out.lines.pop()

    later(done)


def table(node: Node, seen: bool, outs: list[Writer], todo: list) -> None:
    """Queues the cells of a table, each into lines of its own, and then its layout."""
    rows, loose = rows_of(node, seen)
    cells = [c for row in rows for c in row]
    outer = outs[-1]
    outer.gap()
    todo.append((outer.gap, None))
    if len(cells) == 1:
        block = Node("div")
        block.kids = cells[0].node.kids
        todo.append((block, cells[0].seen))
    else:

        def finish() -> None:
            for line in lay_out(rows):
                outer.raw(line, True)

        def close(c: Cell) -> Callable:
            def act() -> None:
                w = outs.pop()
                w.end_line()
                c.lines = [y for i, x in enumerate(w.lines) if x for y in ([x] if i in w.fixed else wrapped(x))] or [""]

            return act

        todo.append((finish, None))
        for c in reversed(cells):
            todo.append((close(c), None))
            todo.extend((k, c.seen) for k in reversed(c.node.kids))
            todo.append((lambda: outs.append(Writer()), None))
    todo.append((outer.end_line, None))
    todo.extend(reversed(loose))


def text_of(page: str) -> str:
    return render(parse(page))


def extract(pages: DataFrame, html: str = "html", rows: int = 256, out: str = "text") -> DataFrame:
    """``pages`` without ``html``, with the text as ``out``."""
    bound_batches(pages.sparkSession)
    kept = [c for c in pages.columns if c.lower() not in (html.lower(), out.lower())]
    src = pages.select(*kept, F.col(html).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, rows):
            text = [None if p is None else text_of(p) for p in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(text, pa.string())], [*b.schema.names[:-1], out])

    schema = pages.select(*kept).schema.add(out, "string")
    return src.mapInArrow(run, schema)
