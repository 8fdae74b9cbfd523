"""HTML extraction: layout-aware rendering of all visible text.

Pages are parsed into a tree (``html_tree``) and rendered block by block:
paragraph-like blocks are set off by a blank line, other blocks by a line end;
list items carry bullets or their numbers and are indented with their list;
table cells are aligned in columns, spans included; preformatted text keeps
its white space, all other white space is collapsed.  Text that a browser does
not show is left out: hidden elements, closed dialogs, the body of closed
details, scripts, styles, the head; form controls show their label or choice.

Style sheets are not evaluated, only style attributes.  Each page is rendered
by itself, so nothing shuffles.  Columns are padded to at most ``MAX_PAD``
characters and begin at most ``MAX_START`` characters to the right, so neither
a long cell nor many columns blow up a table; no text is cut.
Time is linear in the page, but for cells that span rows and end in different
rows: each row walks over those above it that are still open.

Defined cases: null html gives null text and title; an empty page an empty
text; repeated rows are rendered each; other columns are not looked at.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow
from .html_tree import Node, is_hidden, keeps_space, parse, visibility

MAX_PAD = 60
MAX_START = 1000
MAX_SPAN = 1000

# How browsers lay out elements by default.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir blockquote pre listing xmp table hr figure fieldset".split())
BLOCKS = SPACED | frozenset("address article aside body center dd details dialog div dt figcaption footer form header "
                            "hgroup html legend li main nav option optgroup plaintext search section summary caption "
                            "tr td th thead tbody tfoot".split())
LISTS = frozenset("ul ol menu dir".split())
NO_VALUE = frozenset("hidden password checkbox radio file image range color".split())  # inputs that show no text
_SPACE = re.compile(r"[ \t\n\r\f\v]+")


class Page:
    """Lines of text with pending breaks: 0 none, 1 line end, 2 blank line."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.glue = ""  # a collapsed blank that waits for more text
        self.gap = 0

    def _flush(self) -> None:
        text = "".join(self.line).rstrip(" ") if self.line else ""
        if text:
            self.lines.append(text)
        self.line, self.glue = [], ""

    def block(self, gap: int) -> None:
        """A block begins or ends here."""
        self._flush()
        self.gap = max(self.gap, gap)

    def _open_line(self) -> None:
        if not self.line:
            if self.gap == 2 and self.lines:
                self.lines.append("")
            self.gap = 0

    def inline(self, text: str) -> None:
        words = _SPACE.split(text)
        if len(words) == 1 and not words[0]:
            return
        if not words[0] and self.line:
            self.glue = " "
        body = " ".join(w for w in words if w)
        if body:
            self._open_line()
            self.line += [self.glue if self.line else "", body]
            self.glue = " " if not words[-1] else ""

    def exact(self, text: str) -> None:
        """Preformatted text."""
        for i, part in enumerate(text.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
            if i:
                self.line_end()
            if part:
                self._open_line()
                self.line += [self.glue if self.line else "", part]
                self.glue = ""

    def line_end(self) -> None:
        """A forced line end; an empty line stays."""
        if self.line:
            self._flush()
        elif self.lines:
            self._open_line()
            self.lines.append("")

    def insert(self, lines: list[str], first: str = "", other: str = "") -> None:
        """Rendered lines as a block, with a prefix for the first and for the
        others."""
        for i, line in enumerate(lines):
            if i == 0 and self.gap == 2 and self.lines:
                self.lines.append("")
            self.lines.append((((first if i == 0 else other) + line).rstrip(" ")) if line or i == 0 else "")
        if lines:
            self.gap = 0

    def result(self) -> list[str]:
        self._flush()
        lines = self.lines
        while lines and not lines[-1]:
            lines.pop()
        start = next((i for i, x in enumerate(lines) if x), len(lines))
        return lines[start:]


def _number(text: str | None, default: int) -> int:
    m = re.match(r"\s*([+-]?\d{1,9})", text or "")
    return int(m[1]) if m else default


def _sub_page(node: Node, shown: bool, pre: bool) -> list[str]:
    page = Page()
    _children(node, page, shown, pre)
    return page.result()


def _children(node: Node, page: Page, shown: bool, pre: bool) -> None:
    for child in node.children:
        if isinstance(child, str):
            if shown:
                (page.exact if pre else page.inline)(child)
        elif not is_hidden(child):
            _element(child, page, visibility(child, shown), keeps_space(child, pre))


def _list(node: Node, page: Page, shown: bool, pre: bool) -> None:
    items = [c for c in node.children if isinstance(c, Node) and c.tag == "li" and not is_hidden(c)]
    down = "reversed" in node.attrs
    number = _number(node.attrs.get("start"), len(items) if down else 1)
    for child in node.children:
        if isinstance(child, Node) and child.tag == "li" and not is_hidden(child):
            number = _number(child.attrs.get("value"), number)
            mark = f"{number}. " if node.tag == "ol" else "- "
            number += -1 if down else 1
            lines = _sub_page(child, visibility(child, shown), keeps_space(child, pre))
            page.block(1)
            page.insert(lines, mark, " " * len(mark))
            page.block(1)
        elif isinstance(child, Node) and not is_hidden(child) and child.tag not in BLOCKS:
            _element(child, page, visibility(child, shown), keeps_space(child, pre))
        elif isinstance(child, Node) and not is_hidden(child):
            lines = Page()
            _element(child, lines, visibility(child, shown), keeps_space(child, pre))
            page.block(1)
            page.insert(lines.result(), "  " if child.tag in LISTS else "", "  " if child.tag in LISTS else "")
            page.block(1)
        elif isinstance(child, str) and shown:
            page.inline(child)


def _rows(table: Node) -> list[Node]:
    groups: dict[str, list[Node]] = {"thead": [], "tbody": [], "tfoot": []}
    for group in table.children:
        if isinstance(group, Node) and not is_hidden(group):
            if group.tag == "tr":
                groups["tbody"].append(group)
            elif group.tag in groups:
                groups[group.tag] += [r for r in group.children if isinstance(r, Node) and r.tag == "tr" and not is_hidden(r)]
    return groups["thead"] + groups["tbody"] + groups["tfoot"]


def _joined(spans: list[list[int]]) -> list[list[int]]:
    """Neighbours that end in the same row become one."""
    out = spans[:1]
    for span in spans[1:]:
        if span[0] <= out[-1][1] and span[2] == out[-1][2]:
            out[-1][1] = max(out[-1][1], span[1])
        else:
            out.append(span)
    return out


def _table(node: Node, page: Page, shown: bool, pre: bool) -> None:
    for c in node.children:
        if isinstance(c, Node) and c.tag == "caption" and not is_hidden(c):
            page.insert(_sub_page(c, visibility(c, shown), pre))
            page.block(1)
    grid: list[list[tuple[int, int, list[str]]]] = []  # per row: (column, span, lines)
    rows = _rows(node)
    covered: list[list[int]] = []  # from above: (first column, end, row where it ends), ascending
    for number, row in enumerate(rows):
        column, cells, added, at = 0, [], [], 0
        covered = [c for c in covered if c[2] > number]
        row_shown = visibility(row, visibility(row.parent, shown))
        for cell in row.children:
            if isinstance(cell, Node) and cell.tag in ("td", "th") and not is_hidden(cell):
                while at < len(covered) and covered[at][0] <= column:
                    column = max(column, covered[at][1])
                    at += 1
                wide = min(max(_number(cell.attrs.get("colspan"), 1), 1), MAX_SPAN)
                end = min(number + max(_number(cell.attrs.get("rowspan"), 1), 1), len(rows))
                cells.append((column, wide, _sub_page(cell, visibility(cell, row_shown), keeps_space(cell, pre))))
                if end > number + 1:
                    added.append([column, column + wide, end])
                column += wide
        if added:
            covered = _joined(sorted(covered + added))
        if any(lines for _, _, lines in cells):
            grid.append(cells)
    used = sorted({c for cells in grid for c, _, _ in cells})
    width = dict.fromkeys(used, 0)
    for cells in grid:
        for c, wide, lines in cells:
            if wide == 1:
                width[c] = max(width[c], min(max(map(len, lines), default=0), MAX_PAD))
    start, at = {}, 0
    for c in used:
        start[c], at = min(at, MAX_START), at + (width[c] + 2 if width[c] else 0)
    for cells in grid:
        for i in range(max(len(lines) for _, _, lines in cells)):
            line = ""
            for c, _, lines in cells:
                if i < len(lines) and lines[i]:
                    line = line.ljust(start[c])
                    if line and not line.endswith("  "):
                        line += "  "
                    line += lines[i]
            page.insert([line])
            page.block(1)


def _element(node: Node, page: Page, shown: bool, pre: bool) -> None:
    tag = node.tag
    if tag == "br":
        page.line_end()
    elif tag == "wbr":
        pass
    elif tag == "input":
        if node.attrs.get("type", "text").lower() not in NO_VALUE and shown:
            page.inline(" " + node.attrs.get("value", "") + " ")
    elif tag == "select":
        options = [o for o in _all(node, "option") if not is_hidden(o)]
        if "multiple" in node.attrs or _number(node.attrs.get("size"), 1) > 1:
            chosen = options  # a list box shows them all
        else:  # the last one selected, or the first one
            chosen = [o for o in options if "selected" in o.attrs][-1:] or options[:1]
        for option in chosen:
            page.inline(" ")
            _children(option, page, shown, False)
            page.inline(" ")
    elif tag == "details" and "open" not in node.attrs:
        summary = next((c for c in node.children if isinstance(c, Node) and c.tag == "summary"), None)
        page.block(1)
        if summary is not None and not is_hidden(summary):
            _children(summary, page, visibility(summary, shown), pre)
        page.block(1)
    elif tag in BLOCKS:
        gap = 2 if tag in SPACED else 1
        if tag in LISTS and any(x.tag == "li" for x in _above(node)):
            gap = 1  # a list inside a list
        page.block(gap)
        if tag in LISTS:
            _list(node, page, shown, pre)
        elif tag == "table":
            _table(node, page, shown, pre)
        elif tag == "hr":
            pass
        elif tag in ("blockquote", "dd"):
            page.insert(_sub_page(node, shown, pre), "  ", "  ")
        else:
            if tag == "pre" and node.children and isinstance(node.children[0], str):
                node.children[0] = node.children[0].removeprefix("\n")
            _children(node, page, shown, pre)
        page.block(gap)
    else:
        if tag in ("button", "textarea", "rt"):
            page.inline(" ")
        _children(node, page, shown, pre)
        if tag in ("button", "textarea", "rt"):
            page.inline(" ")


def _above(node: Node):
    while (node := node.parent) is not None:
        yield node


def _all(node: Node, tag: str):
    for child in node.children:
        if isinstance(child, Node):
            if child.tag == tag:
                yield child
            yield from _all(child, tag)


def render(html_text: str) -> tuple[str, str]:
    """(title, visible text) of a page."""
    root = parse(html_text)
    title = next(_all(root, "title"), None)
    heading = "" if title is None else " ".join("".join(c for c in title.children if isinstance(c, str)).split())
    page = Page()
    if not is_hidden(root):
        for child in root.children:
            if isinstance(child, Node) and not is_hidden(child):
                _element(child, page, visibility(child, True), keeps_space(child, False))
    return heading, "\n".join(page.result())


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, title, text, n_chars."""
    def run(batches):
        for batch in batches:
            ids, found, held, at = batch.column(0), [], 0, 0
            for i, source in enumerate(batch.column(1)):
                text = source.as_py()
                found.append((None, None) if text is None else render(text))
                held += len(text or "")
                if held > 4_000_000 or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([
                        ids.slice(at, len(found)), pa.array([t for t, _ in found], pa.string()),
                        pa.array([x for _, x in found], pa.string()),
                        pa.array([None if x is None else len(x) for _, x in found], pa.int64())],
                        names=["page_id", "title", "text", "n_chars"])
                    found, held, at = [], 0, i + 1

    own = pages.select(F.col(id_col).cast("long"), F.col(html_col))
    return map_arrow(own, run, "page_id long, title string, text string, n_chars long")
