"""Text of web pages by layout-aware rendering.

A page is built into a tree, with the tags that HTML lets authors leave out; the tree is
walked once with an explicit stack. All visible text is emitted: blocks start on lines of
their own, paragraphs and the like keep a blank line, lists get markers and indents, and
the cells of a table are aligned in columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breachline.llm.common import pieces

# Fixed values of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("head script style template noscript iframe object audio video canvas datalist title "
             "desc metadata defs annotation annotation-xml".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr".split())
BLOCKS = SPACED | set(
    "html body div section article aside header footer nav main address form fieldset legend "
    "li dt dd tr td th thead tbody tfoot caption figcaption details summary center hgroup "
    "option optgroup textarea".split()
)
# A start tag of the left closes an open element of the right, looked for up to a barrier.
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "body": ({"head"}, set()),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
}
_P_ENDS = (BLOCKS - {"html", "body", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "option", "optgroup", "textarea"}) | {"hr"}
_P_BARRIER = {"td", "th", "table", "button", "caption"}
_HEAD_CONTENT = set("title meta link base style script noscript template".split())
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(hidden|collapse)", re.I)
_NUMBER = re.compile(r"[ \t\n\r\f]*([+-]?)0*([0-9]+)")
#: A document type may hold declarations of its own, which are no text.
_DOCTYPE = re.compile(r"\s*<!doctype[^>\[]*\[[^\]]*\]\s*>", re.I)
#: Digits of a number that count; HTML numbers are no larger.
DIGITS = 9
#: A column is padded to its widest cell, up to this width.
COLUMN = 60


@dataclass
class Node:
    tag: str
    attrs: dict
    children: list = field(default_factory=list)


class Builder(HTMLParser):
    """Builds the tree; never fails on broken markup."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.open = [self.root]

    def _close_to(self, tags: set[str], barrier: set[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return
            if self.open[i].tag in barrier:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.open[-1].tag == "head" and tag not in _HEAD_CONTENT:
            self.open.pop()
        if tag in _P_ENDS:
            self._close_to({"p"}, _P_BARRIER)
        if tag in CLOSES:
            self._close_to(*CLOSES[tag])
        if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self.handle_starttag("tr", [])
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        barrier = set() if tag in ("table", "body", "html") else {"table"} - {tag}
        if tag in ("td", "th", "tr"):
            barrier = {"table"}
        self._close_to({tag}, barrier)

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip():
            self.open.pop()
        self.open[-1].children.append(data)


def whole_number(value: str | None, default: int) -> int:
    """The number an attribute begins with; one of too many digits is the greatest of few."""
    found = _NUMBER.match(value or "")
    if not found:
        return default
    digits = found[2]
    number = int(digits) if len(digits) <= DIGITS else 10**DIGITS - 1
    return -number if found[1] == "-" else number


def visible(node: Node) -> bool:
    """Whether a page shows the element; ``aria-hidden`` only hides it from screen readers."""
    attrs = node.attrs
    if node.tag in HIDDEN or "hidden" in attrs:
        return False
    return not _INVISIBLE.search(attrs.get("style") or "")


class Canvas:
    """Lines of text with collapsed white space, pending line breaks and an indent."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.breaks, self.blank = 0, False
        self.indent, self.marker = "", ""
        self.fresh = True  # nothing on the current line yet
        self.ended = False  # the last thing written is a line break of its own

    def need(self, breaks: int) -> None:
        self.breaks = max(self.breaks, breaks)
        self.blank = False

    def _start(self) -> None:
        if self.breaks:
            if self.parts:  # a line that <br> has ended already counts
                self.parts.append("\n" * (self.breaks - self.ended))
            self.breaks, self.fresh = 0, True
        self.ended = False
        if self.fresh:
            lead = self.indent
            if self.marker:
                lead = lead[: -len(self.marker)] + self.marker
                self.marker = ""
            self.parts.append(lead)
            self.fresh = False

    def text(self, data: str) -> None:
        words = _BLANKS.sub(" ", data)
        if words[:1] == " " or self.blank:
            self.blank = not (self.fresh or self.breaks)
        words, after = words.strip(" "), words.endswith(" ")
        if words:
            gap = " " if self.blank else ""
            self._start()
            self.parts.append(gap + words)
            self.blank = after

    def verbatim(self, data: str) -> None:
        for i, line in enumerate(data.split("\n")):
            if i:
                self.line()
            if line:
                self._start()
                self.parts.append(line)

    def line(self) -> None:
        if self.breaks:
            self.breaks += 1
        else:
            self.parts.append("\n")
            self.ended = True
        self.fresh, self.blank = True, False

    def result(self) -> str:
        lines = "".join(self.parts).split("\n")
        return "\n".join(line.rstrip(" ") for line in lines).strip("\n")


class Table:
    """Cells of one table, each a rendered text, and the rows laid out in columns."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int]]] = []

    def add(self, text: str, span: str | None) -> None:
        if not self.rows:
            self.rows.append([])
        self.rows[-1].append((text.split("\n"), max(1, min(whole_number(span, 1), 1000))))

    def lines(self) -> Iterator[str]:
        width: dict[int, int] = {}
        for row in self.rows:
            at = 0
            for lines, span in row:
                if span == 1:
                    width[at] = min(COLUMN, max(width.get(at, 0), *map(len, lines)))
                at += span
        for row in self.rows:
            for i in range(max((len(lines) for lines, _ in row), default=0)):
                out, at = [], 0
                for lines, span in row:
                    wide = sum(width.get(k, 0) for k in range(at, at + span)) + 2 * (span - 1)
                    out.append((lines[i] if i < len(lines) else "").ljust(wide))
                    at += span
                yield "  ".join(out).rstrip(" ")


def render(html: str) -> str:
    """The visible text of a page."""
    builder = Builder()
    builder.feed(_DOCTYPE.sub("", html, count=1) if _DOCTYPE.match(html) else html)
    builder.close()
    canvas, outer = Canvas(), []  # outer: canvases around open cells
    tables: list[Table] = []
    lists: list[list] = []  # [is ordered, next number]
    pre = 0
    todo: list = [(builder.root, False)]
    while todo:
        node, leaving = todo.pop()
        if isinstance(node, str):
            canvas.verbatim(node) if pre else canvas.text(node)
            continue
        tag = node.tag
        if not leaving:
            if not visible(node):
                continue
            if tag == "br":
                canvas.line()
                continue
            if tag in BLOCKS and tag not in ("td", "th"):
                canvas.need(2 if tag in SPACED and not (tag in ("ul", "ol") and lists) else 1)
            if tag in ("pre", "textarea"):
                pre += 1
            elif tag in ("ul", "ol"):
                lists.append([tag == "ol", whole_number(node.attrs.get("start"), 1)])
            elif tag == "optgroup":
                canvas.text(node.attrs.get("label") or "")
                canvas.need(1)
            elif tag == "li":
                ordered, number = lists[-1] if lists else (False, 1)
                marker = f"{number}. " if ordered else "- "
                if lists:
                    lists[-1][1] += 1
                node.attrs["#"] = canvas.indent
                canvas.indent, canvas.marker = canvas.indent + " " * len(marker), marker
            elif tag in ("blockquote", "dd"):
                node.attrs["#"] = canvas.indent
                canvas.indent += "  "
            elif tag == "table":
                tables.append(Table())
            elif tag == "tr" and tables:
                tables[-1].rows.append([])
            elif tag in ("td", "th") and tables:
                outer.append((canvas, lists))
                canvas, lists = Canvas(), []
            todo.append((node, True))
            todo.extend((child, False) for child in reversed(node.children))
            continue
        if tag in ("pre", "textarea"):
            pre -= 1
        elif tag in ("ul", "ol"):
            lists.pop()
        elif tag in ("li", "blockquote", "dd"):
            canvas.indent, canvas.marker = node.attrs["#"], ""
        elif tag in ("td", "th") and tables:
            text = canvas.result()
            canvas, lists = outer.pop()
            tables[-1].add(text, node.attrs.get("colspan"))
        elif tag == "table":
            for line in tables.pop().lines():
                canvas.need(1)
                if line:
                    canvas.verbatim(line)
        if tag in BLOCKS and tag not in ("td", "th"):
            canvas.need(2 if tag in SPACED and not (tag in ("ul", "ol") and lists) else 1)
    return canvas.result()


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per input row: ``<id_col>, text, n_chars, n_lines``.

    Null and empty pages give an empty text with no line. Broken markup and deep nesting are
    rendered as far as tags can be matched; repeated rows are rendered row by row; an empty
    table gives no rows; other columns are not read.
    """
    source = pages.select(F.col(f"`{id_col}`"), F.col(f"`{html_col}`").cast("string"))
    kind = source.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = [render(html) if html else "" for html in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([t.count("\n") + bool(t) for t in texts], pa.int64())],
                [id_col, "text", "n_chars", "n_lines"],
            )

    return source.mapInArrow(run, f"`{id_col}` {kind}, text string, n_chars bigint, n_lines bigint")
