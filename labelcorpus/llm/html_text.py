"""HTML extraction: a small tree builder with implied tags, and a renderer that keeps the visible layout.

The builder closes what HTML closes by itself (paragraphs before blocks, list items, table parts, the head), opens
missing table rows, ignores stray end tags and never lets one cross a table cell. The renderer drops
what a browser does not show (scripts, styles, templates, the head, fallback content, ``hidden``, ``display:none``,
``visibility:hidden``), collapses white space outside ``pre``, puts blocks on their own lines and paragraphs,
headings, lists and tables apart by a blank line, marks list items by nesting, and aligns table cells in
columns.

Parsing is per page and needs no other row, so the operator is one pass without a shuffle; batches of a few rows
bound a task's memory by its largest pages.

Defined cases: null HTML gives null text; empty HTML, or HTML without visible text, gives an empty text.
Truncated tags end the page; unknown tags are inline. Elements nested over ``DEEP`` levels are
attached at that level, no text is lost. Repeated rows are extracted one by one. Extra columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEEP = 200
#: Element classes.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
UNSEEN = {"script", "style", "template", "noscript", "head", "title", "iframe", "noembed", "noframes", "canvas",
          "audio", "video", "datalist", "object"}
RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "noscript", "xmp"}
HEAD = {"title", "meta", "link", "base", "style", "script", "noscript", "template"}
APART = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "table", "pre", "blockquote", "figure", "hr", "menu"}
BLOCK = APART | {"address", "article", "aside", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dt",
                 "fieldset", "figcaption", "footer", "form", "header", "hgroup", "html", "legend", "li", "main", "nav",
                 "option", "search", "section", "summary", "tr", "tbody", "thead", "tfoot", "td", "th"}
CELLS, ROWS, GROUPS = {"td", "th"}, {"tr"}, {"tbody", "thead", "tfoot"}
TABLE = CELLS | ROWS | GROUPS | {"table", "caption", "colgroup"}
#: What a start tag closes, and the elements past which it does not look.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "td": (CELLS, {"table"}),
    "th": (CELLS, {"table"}),
    "tr": (CELLS | ROWS | {"caption", "colgroup"}, {"table"}),
    "tbody": (CELLS | ROWS | GROUPS | {"caption", "colgroup"}, {"table"}),
    "thead": (CELLS | ROWS | GROUPS | {"caption", "colgroup"}, {"table"}),
    "tfoot": (CELLS | ROWS | GROUPS | {"caption", "colgroup"}, {"table"}),
}
SPACE = re.compile(r"[ \t\n\r\f]+")
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"""
                   r"""|</?[a-zA-Z](?:=\s*+(?:"[^"]*"|'[^']*')|[^>])*+(?:>|\Z)|[^<]++|<""", re.S)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)


class Node:
    __slots__ = ("tag", "attrs", "below")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.below = tag, attrs or {}, []


def attributes(tag: str) -> dict[str, str]:
    found = NAME.match(tag)
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(tag[found.end():].rstrip(">"))}


def unseen(node: Node) -> bool:
    a = node.attrs
    return node.tag in UNSEEN or "hidden" in a or bool(HIDING.search(a.get("style", ""))) or (
        node.tag == "input" and a.get("type", "").lower() not in ("submit", "button", "reset"))


def build(page: str) -> Node:
    """The page's tree; text is kept as strings among the children."""
    root = Node("html")
    stack = [root]

    def close_to(i: int) -> None:
        del stack[i:]

    def find(tags: set[str], stops: set[str]) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in stops:
                return 0
        return 0

    def push(node: Node) -> None:
        stack[-1].below.append(node)
        if len(stack) < DEEP:
            stack.append(node)
    at, end = 0, len(page)
    while at < end:
        token = TOKEN.match(page, at)
        raw, at = token[0], token.end()
        if raw[0] != "<" or raw == "<":
            if stack[-1].tag == "head" and not SPACE.fullmatch(raw):
                stack.pop()
            stack[-1].below.append(html.unescape(raw) if "&" in raw else raw)
            continue
        if raw[1] in "!?":
            if raw.startswith("<![CDATA["):
                stack[-1].below.append(raw[9:].removesuffix("]]>"))
            continue
        if raw[-1] != ">":  # the page ends inside a tag
            break
        name = NAME.match(raw)[1].lower()
        if raw[1] == "/":
            if name == "br":
                stack[-1].below.append(Node("br"))
            elif name == "p" and not find({"p"}, TABLE):
                stack[-1].below.append(Node("p"))
            elif name not in ("html", "body"):
                # an end tag of a table part may leave cells; others stay inside theirs
                i = find({name}, {"table"} if name in TABLE and name != "table" else CELLS | {"caption", "table"} if name != "table" else set())
                if i:
                    close_to(i)
            continue
        if name in ("html", "body"):
            stack[0].attrs |= attributes(raw)
            if stack[-1].tag == "head":
                stack.pop()
            continue
        if stack[-1].tag == "head" and name not in HEAD:
            stack.pop()
        if name in CLOSES:
            tags, stops = CLOSES[name]
            while i := find(tags, stops):
                close_to(i)
        if name in BLOCK and (i := find({"p"}, CELLS | {"caption", "button", "object"})) and name not in TABLE - {"table"}:
            close_to(i)
        if name in CELLS | ROWS | GROUPS | {"caption"} and not find({"table"}, set()):
            continue  # a table part without a table is ignored, its text stays
        if name in CELLS and not find(ROWS, {"table"}):
            push(Node("tr"))
        node = Node(name, attributes(raw) if len(raw) > len(name) + 2 else None)
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            text = page[at: close.start() if close else end]
            at = close.end() if close else end
            node.below.append(html.unescape(text) if name in ("title", "textarea") else text)
            stack[-1].below.append(node)
        elif name in VOID:
            stack[-1].below.append(node)
        else:
            push(node)
    return root


class Lines:
    """Lines of text with collapsed white space, margins and a prefix per list item."""

    def __init__(self):
        self.done: list[str] = []
        self.line, self.gap, self.space = [], 0, False
        self.indent, self.mark = "", ""

    def text(self, s: str) -> None:
        words = SPACE.split(s)
        if not any(words):
            self.space = bool(self.line) and (self.space or len(s) > 0)
            return
        lead, trail = words[0] == "", words[-1] == ""
        body = " ".join(w for w in words if w)
        if self.line and (self.space or lead):
            self.line.append(" ")
        self.line.append(body)
        self.space = trail

    def flush(self) -> None:
        if self.line:
            if self.done and self.gap > 1:
                self.done.append("")
            self.done.append((self.mark or self.indent) + "".join(self.line))
            self.mark, self.line, self.gap = "", [], 0
        self.space = False

    def brk(self, gap: int) -> None:
        self.flush()
        self.gap = max(self.gap, gap)

    def verbatim(self, s: str) -> None:
        rows = s.replace("\r\n", "\n").split("\n")
        for i, row in enumerate(rows):
            if row.strip():
                self.line.append(row.rstrip() if i < len(rows) - 1 else row)
            if i < len(rows) - 1:
                if self.line:
                    self.flush()
                elif self.done:
                    self.gap = 2


def render(node: Node, out: Lines, depth: int = 0, number: list[int] | None = None, pre: bool = False) -> None:
    """Write the node's children."""
    for child in node.below:
        if isinstance(child, str):
            (out.verbatim if pre else out.text)(child)
            continue
        tag = child.tag
        if unseen(child):
            continue
        if tag == "br":
            out.flush()
        elif tag == "hr":
            out.brk(2)
        elif tag == "input":
            out.text(" " + child.attrs.get("value", "") + " ")
        elif tag == "table":
            out.brk(2)
            table(child, out, depth)
            out.brk(2)
        elif tag in ("ul", "ol", "menu", "dir"):
            out.brk(1 if depth else 2)
            start = child.attrs.get("start", "")
            render(child, out, depth + 1, [int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1] if tag == "ol" else None)
            out.brk(1 if depth else 2)
        elif tag == "li":
            out.brk(1)
            mark = "- "
            if number:
                mark, number[0] = f"{number[0]}. ", number[0] + 1
            before = out.indent, out.mark
            step = "  " * max(0, depth - 1)
            out.mark, out.indent = step + mark, step + " " * len(mark)
            render(child, out, depth, None, pre)
            out.flush()
            out.indent, out.mark = before[0], ""
            out.gap = 1
        elif tag in BLOCK:
            gap = 2 if tag in APART else 1
            out.brk(gap)
            before = out.indent
            if tag in ("dd", "blockquote"):
                out.indent += "  "
            render(child, out, depth, number if tag not in ("dd", "blockquote") else None, pre or tag == "pre")
            out.brk(gap)
            out.indent = before
        else:
            render(child, out, depth, number, pre)


#: Cells are aligned up to this length (longer ones run on, whole) and up to this place of a line, so that the padding
#: of a row has a bound whatever the other rows hold.
WIDEST_CELL, WIDEST_LINE = 80, 400


def table(node: Node, out: Lines, depth: int) -> None:
    """Captions and stray content first, then the rows with their cells in columns."""
    rows: list[list[tuple[int, str]]] = []
    spans: list[tuple[int, int, int]] = []  # (from, to, last row): columns that cells above cover, by from
    pending = [(node, iter(node.below))]
    while pending:
        here, children = pending[-1]
        child = next(children, None)
        if child is None:
            pending.pop()
        elif isinstance(child, str):
            out.text(child)
        elif unseen(child):
            continue
        elif child.tag in GROUPS:
            pending.append((child, iter(child.below)))
        elif child.tag == "tr":
            row, column = [], 0
            spans = [s for s in spans if s[2] >= len(rows)]
            reach, deep = 0, []
            for cell in child.below:
                if isinstance(cell, str) or cell.tag not in CELLS:
                    if isinstance(cell, str):
                        out.text(cell)
                    elif not unseen(cell):
                        render(_holder(cell), out, depth)
                    continue
                while reach < len(spans) and spans[reach][0] <= column:
                    column, reach = max(column, spans[reach][1]), reach + 1
                if not unseen(cell):
                    inner = Lines()
                    render(cell, inner, 0)
                    inner.flush()
                    row.append((column, "\n".join(inner.done)))
                wide, high = span(cell, "colspan", 1000), span(cell, "rowspan", 65534)
                if high > 1:
                    last = len(rows) + high - 1
                    if deep and deep[-1][1:] == (column, last):
                        deep[-1] = (deep[-1][0], column + wide, last)
                    else:
                        deep.append((column, column + wide, last))
                column += wide
            spans = sorted(spans + deep)
            rows.append(row)
        elif child.tag == "caption":
            out.brk(1)
            render(child, out, depth)
            out.brk(1)
        elif child.tag not in ("colgroup", "col"):
            render(_holder(child), out, depth)
    out.brk(1)
    if all(c == 0 for row in rows for c, _ in row):  # one column: a layout table
        for row in rows:
            for _, text in row:
                for line in text.split("\n") if text else ():
                    out.line.append(line)
                    out.flush()
        return
    widths: dict[int, int] = {}
    flat = [[(c, SPACE.sub(" ", text)) for c, text in row] for row in rows]
    for row in flat:
        for c, text in row:
            widths[c] = max(widths.get(c, 0), min(len(text), WIDEST_CELL))
    place, at = {}, 0
    for c in sorted(widths):
        place[c], at = min(at, WIDEST_LINE), at + widths[c] + 2
    for row in flat:
        line = ""
        for c, text in row:
            line = (line.ljust(place[c]) if len(line) + 2 <= place[c] or not line else line + "  ") + text
        if line.strip():
            out.line.append(line.rstrip())
            out.flush()


def span(cell: Node, name: str, most: int) -> int:
    """A span's value up to the standard's limit; 1 where there is none."""
    value = cell.attrs.get(name, "1")
    return min(most, max(1, int(value[:9]))) if value.isascii() and value.isdigit() else 1


def _holder(child: Node) -> Node:
    node = Node("div")
    node.below = [child]
    return node


def visible_text(page: str) -> str:
    root = build(page)
    if unseen(root):
        return ""
    out = Lines()
    render(root, out)
    out.flush()
    return "\n".join(out.done)


def extract(pages: DataFrame, key: str = "page_id", source: str = "html") -> DataFrame:
    """key, text (the visible text) and n_lines for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [None if p is None else visible_text(p) for p in part["h"].to_pylist()]
                yield pa.RecordBatch.from_pydict({
                    "key": part["k"], "text": pa.array(texts, pa.string()),
                    "n_lines": pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())})
    kind = pages.schema[key].dataType.simpleString()
    out = pages.select(F.col(key).alias("k"), F.col(source).alias("h")).mapInArrow(run, f"key {kind}, text string, n_lines bigint")
    return out.withColumnRenamed("key", key)
