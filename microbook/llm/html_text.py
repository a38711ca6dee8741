"""Visible text of web pages, laid out as a reader would see it.

A tree is built with the tags that HTML implies, what is not displayed is left out, and the rest is written line by line: blank
lines between paragraphs, marks and indents for lists, columns of equal width for tables.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from microbook.llm.common import whole

# fixed values of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("head title script style noscript template iframe object canvas audio video datalist desc metadata defs".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr fieldset".split())
BLOCKS = PARAGRAPHS | frozenset(
    "html body div article aside section nav header footer main address form li dt dd tr thead tbody tfoot caption figcaption details "
    "summary center hgroup legend search menu".split())
CLOSES_P = BLOCKS - frozenset("html body li dt dd tr thead tbody tfoot caption legend summary figcaption".split())
# a tag closes an open one of its set, up to the nearest of the bounds
_PARTS = frozenset("thead tbody tfoot".split())
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])), "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])), "tr": (frozenset(["tr", "td", "th", "caption"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    **{t: (_PARTS | {"tr", "td", "th", "caption"}, frozenset(["table"])) for t in _PARTS},
}
SCOPES = frozenset("table td th caption button html template".split())
GONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
SHOWN = re.compile(r"display\s*:\s*(?!none)\w|visibility\s*:\s*visible", re.I)
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
SELECTOR = re.compile(r"([A-Za-z][\w-]*)?([.#][A-Za-z_-][\w-]*)?")
INDENTS = 20  # nested lists and quotations are indented no further
IN_SCOPE = frozenset("p li b i a span".split())  # an end tag of these does not reach outside its scope


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []


class StyleRules:
    """Which elements the page's own style sheets hide: rules for a tag, a class, an id, or a tag with one of them.

    The most specific rule that says anything about display or visibility counts, of equal ones the last. Combined selectors,
    pseudo-classes and conditional blocks (at-rules) are passed over.
    """

    def __init__(self) -> None:
        self.rules: dict[tuple[str, str], tuple[int, int, bool]] = {}
        self.n = 0

    def read(self, sheet: str) -> None:
        depth, start, head = 0, 0, ""
        sheet = COMMENT.sub(" ", sheet)
        for m in re.finditer(r"[{};]", sheet):
            sign = m.group()
            if sign == "{":
                if not depth:
                    head, start = sheet[start:m.start()].strip(), m.end()
                depth += 1
            elif sign == "}" and depth:
                depth -= 1
                if not depth:
                    self.add(head, sheet[start:m.start()])
                    start = m.end()
            elif not depth:
                start = m.end()

    def add(self, head: str, body: str) -> None:
        gone = bool(GONE.search(body))
        if head.startswith("@") or not (gone or SHOWN.search(body)):
            return
        for one in head.split(","):
            m = SELECTOR.fullmatch(one.strip())
            if m and m.group():
                tag, mark = (m.group(1) or "").lower(), m.group(2) or ""
                weight = bool(tag) + (100 if mark[:1] == "#" else 10 if mark else 0)
                self.n += 1
                self.rules[tag, mark] = (weight, self.n, gone)

    def hide(self, node: Node) -> bool:
        if not self.rules:
            return False
        marks = ["", *["." + c for c in node.attrs.get("class", "").split()], "#" + node.attrs.get("id", "").strip()]
        found = [r for m in marks for t in ("", node.tag) if (r := self.rules.get((t, m)))]
        return bool(found) and max(found)[2]


class TreeBuilder(HTMLParser):
    """Nodes and strings; open tags are closed where the next tag implies it, stray end tags are passed over."""

    CDATA_CONTENT_ELEMENTS = ("script", "style", "noscript", "iframe")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}  # where each tag is open, so that no tag needs a walk over all open ones
        self.styles = StyleRules()

    def _last(self, tags: frozenset[str]) -> int:
        """The innermost open place of `tags`; 0 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _cut(self, i: int) -> None:
        for node in self.open[i:]:
            self.places[node.tag].pop()
        del self.open[i:]

    def _close(self, tags: frozenset[str], bounds: frozenset[str]) -> None:
        bound = self._last(bounds)
        while (i := self._last(tags)) > bound:
            self._cut(i)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body"):
            return
        if tag in CLOSES_P:
            self._close(frozenset(["p"]), SCOPES)
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        if len(tag) == 2 and tag[0] == "h" and tag[1].isdigit() and self.open[-1].tag[0] == "h" and self.open[-1].tag[1:].isdigit():
            self._cut(len(self.open) - 1)
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":  # the standard reads this as a break
            self.handle_starttag("br", [])
        i = self._last(frozenset([tag]))
        if i and not (tag in IN_SCOPE and i < self._last(SCOPES)):
            self._cut(i)

    def handle_data(self, data: str) -> None:
        top = self.open[-1]
        if top.tag == "style" and top.attrs.get("media", "").strip().lower() in ("", "all", "screen"):
            self.styles.read(data)
        top.children.append(data)

    def unknown_decl(self, data: str) -> None:
        """Marked sections are comments in HTML."""


def hidden(node: Node, styles: StyleRules) -> bool:
    a = node.attrs
    if node.tag in HIDDEN or "hidden" in a or (node.tag == "input" and a.get("type", "").lower() == "hidden"):
        return True
    inline = a.get("style", "")
    return bool(GONE.search(inline)) or (not SHOWN.search(inline) and styles.hide(node))


def chosen(select: Node) -> list[Node]:
    """The options of a list that a reader sees: all of an open list, else the last selected one or the first."""
    options, todo = [], select.children[::-1]
    while todo:
        item = todo.pop()
        if isinstance(item, Node):
            if item.tag == "option":
                options.append(item)
            else:
                todo += item.children[::-1]
    size = select.attrs.get("size", "")
    if "multiple" in select.attrs or (size.isdecimal() and len(size) < 5 and int(size) > 1):
        return options
    return ([o for o in options if "selected" in o.attrs][-1:] or options[:1])


def width(text: str) -> int:
    """Columns on a fixed grid: two for wide characters, none for marks that combine."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Page:
    """Lines under way: white space runs collapse, blank lines between paragraphs do not add up."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = self.blank = False
        self.marks: list[str] = []  # per open list item: the mark, then the indent that replaces it
        self.fresh: list[int] = []  # marks not yet written

    def text(self, data: str) -> None:
        words = data.split(None) if data.strip() else []
        if data[:1].isspace() or not words:
            self.space = self.space or bool(self.line)
        for i, word in enumerate(words):
            if (i or self.space) and self.line:
                self.line.append(" ")
            self.line.append(word)
            self.space = False
        if words and data[-1:].isspace():
            self.space = True

    def end(self) -> None:
        """End the line under way."""
        if self.line:
            self.put("".join(self.line))
        self.line, self.space = [], False

    def put(self, line: str) -> None:
        if self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        self.lines.append("".join(self.marks[-INDENTS:]) + line if line else line)
        for i in self.fresh:
            if i < len(self.marks):
                self.marks[i] = " " * len(self.marks[i])
        self.fresh = []

    def mark(self, mark: str) -> None:
        self.fresh.append(len(self.marks))
        self.marks.append(mark)

    def gap(self) -> None:
        self.end()
        self.blank = bool(self.lines)


class _Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int, int]]] = []  # per cell: lines, columns, rows
        self.captions: list[str] = []

    def placed(self) -> list[list[tuple[list[str], int, int]]]:
        """Cells with their first column and number of columns; columns taken by cells from above are passed over."""
        taken: dict[int, int] = {}  # column -> first row in which it is free again
        out = []
        for r, row in enumerate(self.rows):
            at, cells = 0, []
            for cell, span, down in row:
                while taken.get(at, 0) > r:
                    at += 1
                cells.append((cell, at, span))
                if down > 1:
                    taken.update(dict.fromkeys(range(at, at + span), r + down))
                at += span
            out.append(cells)
        return out

    def lines(self) -> list[str]:
        """Cells of a column start at the same place; a cell of several lines takes as many."""
        wide: list[int] = []
        rows = self.placed()
        for row in rows:
            for cell, at, span in row:
                wide += [0] * (at + span - len(wide))
                if span == 1:
                    wide[at] = max([wide[at], *map(width, cell)])
        out = list(self.captions)
        for row in rows:
            for k in range(max((len(c) for c, _, _ in row), default=0)):
                parts, done = [], 0
                for cell, at, span in row:
                    parts += [" " * w for w in wide[done:at]]
                    text = cell[k] if k < len(cell) else ""
                    room = sum(wide[at:at + span]) + 2 * (span - 1)
                    parts.append(text + " " * max(0, room - width(text)))
                    done = at + span
                out.append("  ".join(parts).rstrip())
        return out


def spanned(text: str, most: int, none: int = 1) -> int:
    """A colspan or rowspan; 0 means `none`, what is no number 1."""
    return min(most, int(text) or none) if text.isdecimal() and len(text) < 9 else 1


def rendered(html: str) -> str:
    """The visible text of a page. Depth is bounded by memory alone: the tree is walked with a list, not by recursion."""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    pages, tables, numbers = [Page()], [], []
    pre = 0
    todo: list[tuple[object, bool]] = [(builder.root, True)]
    while todo:
        item, enter = todo.pop()
        page = pages[-1]
        if isinstance(item, str):
            if pre:
                first, *rest = item.expandtabs(8).split("\n")
                page.line.append(first)
                for line in rest:
                    page.put("".join(page.line))
                    page.line = [line]
            else:
                page.text(item)
            continue
        tag = item.tag
        if enter:
            if hidden(item, builder.styles):
                continue
            if tag == "br":
                page.put("".join(page.line)) if page.line else page.put("")
                page.line, page.space = [], False
                continue
            if tag == "img":
                if item.attrs.get("alt", "").strip():
                    page.text(f" {item.attrs['alt'].strip()} ")
                continue
            if tag == "select":
                page.text(" ")
                for option in reversed(chosen(item)):
                    todo += [(" ", True), (option, True)]
                continue
            if tag == "input":
                if item.attrs.get("type", "").lower() in ("submit", "button", "reset") and item.attrs.get("value"):
                    page.text(f" {item.attrs['value']} ")
                continue
            if tag in PARAGRAPHS and not (tag in ("ul", "ol") and numbers):
                page.gap()
            elif tag in BLOCKS:
                page.end()
            if tag == "hr":
                page.put("---")
                page.blank = True
                continue
            if tag in ("ul", "ol", "menu"):
                start = item.attrs.get("start", "")
                numbers.append((int(start) if start.lstrip("-").isdigit() and len(start) < 10 else 1) if tag == "ol" else None)
            elif tag == "li":
                if numbers and numbers[-1] is not None:
                    page.mark(f"{numbers[-1]}. ")
                    numbers[-1] += 1
                else:
                    page.mark("- ")
            elif tag in ("dd", "blockquote"):
                page.mark("  ")
            elif tag == "pre":
                pre += 1
            elif tag == "table":
                tables.append(_Table())
            elif tag == "tr" and tables:
                tables[-1].rows.append([])
            elif tag in ("td", "th", "caption") and tables:
                pages.append(Page())
            todo.append((item, False))
            todo += [(child, True) for child in reversed(item.children)]
            continue
        if tag in ("td", "th", "caption") and tables:
            page.end()
            cell = [x for x in pages.pop().lines if x]
            if tag == "caption":
                tables[-1].captions += cell
            else:
                if not tables[-1].rows:
                    tables[-1].rows.append([])
                # the standard's bounds of spans; a rowspan of 0 reaches to the end of the table
                tables[-1].rows[-1].append((cell, spanned(item.attrs.get("colspan", ""), 1000), spanned(item.attrs.get("rowspan", ""), 65_534, 65_534)))
            continue
        if tag == "table" and tables:
            page.end()
            for line in tables.pop().lines():
                page.put(line)
        if tag in PARAGRAPHS and not (tag in ("ul", "ol") and len(numbers) > 1):
            page.gap()
        elif tag in BLOCKS:
            page.end()
        if tag in ("ul", "ol", "menu") and numbers:
            numbers.pop()
        elif tag in ("li", "dd", "blockquote") and page.marks:
            page.marks.pop()
        elif tag == "pre":
            pre -= 1
    pages[0].end()
    return "\n".join(line.rstrip() for line in pages[0].lines).strip("\n")


def extracted(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """page_id, text, n_lines, text_sha256, one row per input row.

    Null and empty pages give empty texts. Anything that is not HTML is text. Rows are independent: repeated rows stay, a null
    page_id stays null.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), whole(html).alias("html"))
    schema = T.StructType([rows.schema["page_id"], T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()),
                           T.StructField("text_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [rendered(h.as_py()) for h in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64()),
                 pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts], pa.string())],
                ["page_id", "text", "n_lines", "text_sha256"])

    return rows.mapInArrow(run, schema)
