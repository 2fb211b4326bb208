"""Visible text of HTML pages by layout-aware rendering.

A small tree builder reads tags with implied ends (a paragraph ends at the next block, a list item at
the next item, cells and rows at their like, a head at the first thing that no head holds), and so for hidden elements too,
which are left out with all they hold; a renderer walks the tree without recursion and writes what a reader
would see: nothing of head, scripts, styles, templates, comments, or of elements hidden by attribute or inline
style, and of what is shown only where a page cannot show its object, sound or picture; fields and their options, formulas,
drawings' text and what is hidden from screen readers alone are seen; blocks on lines of their own with an empty line around paragraphs and headings; list items with marks or
numbers, indented by level; preformatted text as it is; tables with cells padded to the widths of their columns.

Pages are rendered in Arrow batches, each page by itself, so memory follows the longest page.

Nulls and edges: a null or empty page has empty text; unclosed and stray tags are tolerated; rows of equal page_id are rendered
one by one; an empty table gives no rows; only ``page_id`` and ``html`` are read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head script style template noscript title object iframe datalist audio video canvas".split())
# Parts of drawings and formulas that are not drawn.
UNSEEN |= frozenset("annotation annotation-xml clippath defs desc marker metadata pattern symbol".split())
# What a head may hold, and elements whose contents end nothing outside.
IN_HEAD = frozenset("head base link meta noframes noscript script style template title".split())
CLOSED = frozenset("template noscript object iframe".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure".split())
BLOCKS = SPACED | frozenset(
    "html body address article aside caption center dd details div dt fieldset figcaption footer form header hgroup hr legend"
    " li main menu nav section summary tbody td tfoot th thead tr".split()
)
# A start tag ends open elements of its set, up to the nearest element of the bound.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
BLANKS = re.compile(r"[ \t\n\r\f]+")
RAW = ("script", "style")
APART = ("select", "option", "optgroup", "textarea")  # in a line, with blanks around


class Node:
    __slots__ = ("tag", "parts", "start")

    def __init__(self, tag: str, start: int = 1):
        self.tag, self.start = tag, start
        self.parts: list[Node | str] = []


class Tree(HTMLParser):
    """Builds the tree; hidden elements are open like others, but hang on no parent."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.stack = [self.root]

    def close_to(self, tags: set[str], bound: set[str]) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag in bound or self.stack[k].tag in CLOSED:
                return
            if self.stack[k].tag in tags:
                last = k
                while last > 1 and self.stack[last - 1].tag in tags:
                    last -= 1
                del self.stack[last:]
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body":
            self.end_head()
        elif self.stack[-1].tag == "head" and tag not in IN_HEAD:
            self.stack.pop()  # the end of the head may be left out
        if tag in BLOCKS:
            self.close_to({"p"}, {"td", "th", "li", "div", "table", "button"})
        if tag in ENDS:
            self.close_to(*ENDS[tag])
        if tag in ("html", "body"):
            return
        given = dict(attrs)
        unseen = tag in UNSEEN or "hidden" in given or HIDDEN.search(given.get("style") or "")
        if unseen and tag in VOID:
            return
        if tag in ("br", "hr", "img"):
            alt = (given.get("alt") or "").strip()
            self.stack[-1].parts.append(Node(tag) if tag != "img" else alt)
            return
        if tag in VOID:
            return
        start = given.get("start") or ""
        node = Node(tag, int(start) if start.isdecimal() and len(start) < 10 else 1)
        if not unseen:
            self.stack[-1].parts.append(node)
        self.stack.append(node)

    def handle_endtag(self, tag: str) -> None:
        bound = {"table"} if tag in ("td", "th", "tr", "li", "p", "div") else set()
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                del self.stack[k:]
                return
            if self.stack[k].tag in bound or self.stack[k].tag in CLOSED:
                return

    def end_head(self) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == "head":
                del self.stack[k:]
                return

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)  # as pages are read, whatever the section is called

    def handle_data(self, data: str) -> None:
        if self.stack[-1].tag == "head" and data.strip():
            self.stack.pop()
        self.stack[-1].parts.append(data)


class Page:
    """Lines under construction: an open line, and how many empty lines must come before the next."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line, self.indent, self.mark = "", "", ""
        self.gap = self.blank = False

    def end(self, gap: bool = False) -> None:
        if self.line:
            if self.gap and self.lines:
                self.lines.append("")
            self.lines.append((self.indent + self.mark + self.line).rstrip())
            self.mark = " " * len(self.mark)
            self.line, self.gap = "", False
        self.blank = False
        self.gap |= gap

    def text(self, data: str) -> None:
        words = BLANKS.sub(" ", data)
        if self.blank or not self.line:
            words = words.lstrip(" ")
        if not words:
            return
        self.line += words
        self.blank = words.endswith(" ")

    def raw(self, data: str) -> None:
        self.end(True)
        if self.lines:
            self.lines.append("")
        self.lines += [(self.indent + x).rstrip() for x in data.strip("\n").split("\n")]


def width(text: str) -> int:
    return sum(2 if unicodedata.east_asian_width(c) in "WF" else not unicodedata.combining(c) for c in text)


def words_in(node: Node, joint: str = "") -> str:
    """All text under a node, without layout."""
    found, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            found.append(x)
        else:
            found.append("\n" if x.tag == "br" else joint if x.tag in BLOCKS else " " if x.tag in APART else "")
            todo += reversed(x.parts)
    return "".join(found)


def table(node: Node) -> tuple[list[Node], list[str]]:
    """Captions of a table, and its rows with cells aligned."""
    captions, rows, todo = [], [], list(reversed(node.parts))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            if x.strip():
                rows.append([BLANKS.sub(" ", x).strip()])
        elif x.tag == "tr":
            cells = [c for c in x.parts if isinstance(c, Node) or c.strip()]
            rows.append([BLANKS.sub(" ", words_in(c, " ") if isinstance(c, Node) else c).strip() for c in cells])
        elif x.tag == "caption":
            captions.append(x)
        elif x.tag in ("tbody", "thead", "tfoot", "colgroup"):
            todo += reversed(x.parts)
        else:
            rows.append([BLANKS.sub(" ", words_in(x, " ")).strip()])
    widths: dict[int, int] = {}
    for row in rows:
        for i, cell in enumerate(row):
            widths[i] = max(widths.get(i, 0), width(cell))
    lines = ["  ".join(c + " " * (widths[i] - width(c)) for i, c in enumerate(row)).rstrip() for row in rows]
    return captions, [x for x in lines if x]


def render(html: str) -> str:
    tree = Tree()
    tree.feed(html)
    tree.close()
    page = Page()
    # (node or text, marks to set) to open; a function to call when an element ends.
    todo: list = [tree.root]
    while todo:
        x = todo.pop()
        if callable(x):
            x()
        elif isinstance(x, str):
            page.text(x)
        elif x.tag == "br":
            if page.line:
                page.end()
        elif x.tag == "hr":
            page.end(True)
        elif x.tag == "pre":
            page.raw(words_in(x))
            page.end(True)
        elif x.tag == "table":
            page.end(True)
            captions, lines = table(x)
            for line in captions:
                page.text(words_in(line, " "))
                page.end()
            for line in lines:
                page.line = line
                page.end()
            page.end(True)
        elif x.tag in ("ul", "ol", "menu"):
            nested = bool(page.mark)
            page.end(not nested)
            before = page.indent, page.mark
            page.indent += " " * len(page.mark)
            page.mark, number = "", x.start

            def leave(before=before, nested=nested) -> None:
                page.end(not nested)
                page.indent, page.mark = before[0], " " * len(before[1])

            todo.append(leave)
            steps: list = []
            for part in x.parts:
                if isinstance(part, Node) and part.tag == "li":
                    mark = f"{number}. " if x.tag == "ol" else "- "
                    number += 1
                    steps += [lambda mark=mark: (page.end(), setattr(page, "mark", mark)), *part.parts]
                    steps.append(lambda: (page.end(), setattr(page, "mark", "")))
                else:
                    steps.append(part)
            todo += reversed(steps)
        elif x.tag in BLOCKS:
            gap = x.tag in SPACED
            page.end(gap)
            todo.append(lambda gap=gap: page.end(gap))
            todo += reversed(x.parts)
        elif x.tag in APART:
            todo += [" ", *reversed(x.parts), " "]
        else:
            todo += reversed(x.parts)
    page.end()
    return "\n".join(page.lines)


def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [render(h.as_py() or "") for h in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["page_id", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id and visible text."""
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    return narrow.mapInArrow(rendered, "page_id long, text string")
