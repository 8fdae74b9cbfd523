"""HTML text → tree: tokens, implied tags, visibility.

The builder follows what browsers do with incomplete markup as far as it
matters for text: missing end tags of paragraphs, list items, definition
terms, options, rows and cells are implied; missing html, head, body, tbody
and tr are implied; misplaced content of a table goes before the table (kept in a
list of its own until the page ends, so the time stays linear); end tags without a start are ignored; nesting is cut at ``MAX_DEPTH`` as browsers do.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

MAX_DEPTH = 256

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style xmp iframe noembed noframes noscript textarea title".split())
ESCAPABLE = frozenset("textarea title".split())
HEAD_ONLY = frozenset("base basefont bgsound link meta title style script noscript noframes template".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                     "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section search summary table "
                     "ul li dd dt listing xmp plaintext".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TABLE_PARTS = frozenset("caption colgroup col thead tbody tfoot tr td th".split())
ROW_GROUPS = frozenset("thead tbody tfoot".split())
SCOPE_ENDS = frozenset("table td th caption html template object marquee applet button".split())
HIDDEN = frozenset("head script style template noscript noframes noembed iframe datalist audio video canvas rp "
                   "annotation annotation-xml meta link title".split())

_ATTR = re.compile(r"""([^\s=/"'>][^\s=/>]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_QUOTE = re.compile(r"""=\s*(["'])""")
_TAG_NAME = re.compile(r"<[a-zA-Z][^\s/>]*")


class Node:
    __slots__ = ("attrs", "before", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs or {}, [], None
        self.before: list | None = None  # a table's misplaced content

    def add(self, child) -> None:
        self.children.append(child)
        if isinstance(child, Node):
            child.parent = self


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if raw and not raw.isspace():
        for name, double, single, bare in _ATTR.findall(raw):
            out.setdefault(name.lower(), html.unescape(double or single or bare))
    return out


def _tag_end(text: str, at: int) -> int:
    """Where the start tag at ``at`` ends (past its '>'), quotes respected
    after '='; -1 if it never ends."""
    while True:
        close = text.find(">", at)
        if close < 0:
            return -1
        for m in _QUOTE.finditer(text, at, close):
            stop = text.find(m[1], m.end())
            if stop < 0:  # an open quote: the first '>' ends the tag
                return close + 1
            if stop > close:
                at = stop + 1
                break
        else:
            return close + 1


def tokens(text: str) -> Iterator[tuple[str, str, dict | None]]:
    """('text', characters, None), ('start', tag, attributes) and
    ('end', tag, None), in one pass."""
    at, n = 0, len(text)
    while at < n:
        lt = text.find("<", at)
        if lt < 0:
            yield "text", html.unescape(text[at:]), None
            return
        if lt > at:
            yield "text", html.unescape(text[at:lt]), None
        nxt = text[lt + 1:lt + 2]
        if nxt.isascii() and nxt.isalpha():
            end = _tag_end(text, lt + 1)
            if end < 0:
                return  # an unfinished tag shows nothing
            name = _TAG_NAME.match(text, lt)
            tag = name[0][1:].lower()
            yield "start", tag, _attributes(text[name.end():end - 1])
            at = end
            if tag in RAW_TEXT:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(text, at)
                stop = close.start() if close else n
                body = text[at:stop]
                yield "text", html.unescape(body) if tag in ESCAPABLE else body, None
                yield "end", tag, None
                at = text.find(">", stop) + 1 if close and text.find(">", stop) >= 0 else n
            elif tag == "plaintext":
                yield "text", text[at:], None
                return
        elif nxt == "/":
            close = text.find(">", lt)
            if close < 0:
                return
            name = text[lt + 2:close].strip().split("/")[0].split()
            if name:
                yield "end", name[0].lower(), None
            at = close + 1
        elif text.startswith("<!--", lt):
            stop = text.find("-->", lt + 2)
            at = stop + 3 if stop >= 0 else n
        elif nxt in ("!", "?"):
            close = text.find(">", lt)
            at = close + 1 if close >= 0 else n
        else:
            yield "text", "<", None
            at = lt + 1


def _flat(children: list) -> Iterator:
    """Lists are nested at most as deep as tables are open."""
    for child in children:
        if isinstance(child, list):
            yield from _flat(child)
        else:
            yield child


class Builder:
    def __init__(self):
        self.root = Node("html")
        self.body = Node("body")
        self.head = Node("head")
        self.root.add(self.head)
        self.root.add(self.body)
        self.stack = [self.root, self.body]
        self.in_head, self.seen_body = False, False
        self.around_tables: dict[Node, None] = {}

    # -- places -----------------------------------------------------------
    def _index(self, tags, stop=SCOPE_ENDS) -> int:
        """Place of the innermost open element of ``tags`` before an element
        of ``stop``; -1 if there is none."""
        for i in range(len(self.stack) - 1, 1, -1):
            tag = self.stack[i].tag
            if tag in tags:
                return i
            if tag in stop:
                return -1
        return -1

    def _close(self, tags, stop=SCOPE_ENDS) -> None:
        i = self._index(tags, stop)
        if i >= 0:
            del self.stack[i:]

    def _place(self, child) -> None:
        top = self.stack[-1]
        if top.tag in ("table", "tr") or top.tag in ROW_GROUPS:
            text = isinstance(child, str)
            if text and not child.strip():
                return
            if text or (child.tag not in TABLE_PARTS and child.tag not in ("script", "style", "template")):
                table = next(x for x in reversed(self.stack) if x.tag == "table")
                self._put(table.before, table.parent, child)
                return
        self._put(top.children, top, child)

    def _put(self, children: list, parent: Node, child) -> None:
        if isinstance(child, Node):
            child.parent = parent
            if child.tag == "table":
                child.before = []
                children.append(child.before)
                self.around_tables[parent] = None
        children.append(child)

    def finish(self) -> Node:
        """The tree, with misplaced content where it belongs."""
        for parent in self.around_tables:
            parent.children = list(_flat(parent.children))
        return self.root

    def _open(self, node: Node) -> None:
        self._place(node)
        if len(self.stack) < MAX_DEPTH:
            self.stack.append(node)

    # -- tokens -----------------------------------------------------------
    def text(self, data: str) -> None:
        if data:
            if self.in_head and self.stack[-1] is self.head:
                if not data.strip():
                    return
                self._leave_head()
            if self.stack[-1].tag == "colgroup" and data.strip():
                self.stack.pop()
            self._place(data)

    def _leave_head(self) -> None:
        self.in_head = False
        self.stack = [self.root, self.body]

    def start(self, tag: str, attrs: dict) -> None:
        if tag == "html":
            return
        if tag == "body":
            if self.in_head:
                self._leave_head()
            self.body.attrs = attrs | self.body.attrs
            self.seen_body = True
            return
        if tag == "head":
            if not self.in_head and not self.seen_body and not self.body.children:
                self.in_head = True
                self.stack = [self.root, self.head]
            return
        if self.in_head and self.stack[-1] is self.head and tag not in HEAD_ONLY:
            self._leave_head()
        if tag in CLOSES_P:
            self._close(("p",))
        if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
            self.stack.pop()
        if tag == "li":
            self._close(("li",), SCOPE_ENDS | {"ul", "ol", "menu", "dir"})
        elif tag in ("dt", "dd"):
            self._close(("dt", "dd"), SCOPE_ENDS | {"dl"})
        elif tag == "option":
            self._close(("option",), SCOPE_ENDS | {"select", "optgroup"})
        elif tag == "optgroup":
            self._close(("optgroup", "option"), SCOPE_ENDS | {"select"})
        elif tag in ("rt", "rp"):
            self._close(("rt", "rp"), SCOPE_ENDS | {"ruby"})
        elif tag == "a":
            self._close(("a",), SCOPE_ENDS | CLOSES_P)
        elif tag in TABLE_PARTS and not self._table_part(tag):
            return
        node = Node(tag, attrs)
        if tag in VOID:
            self._place(node)
        else:
            self._open(node)

    def _table_part(self, tag: str) -> bool:
        """Close and imply rows, groups and cells; False outside a table."""
        at = max((i for i, x in enumerate(self.stack) if x.tag == "table"), default=-1)
        if at < 0:
            return False
        inside = [x.tag for x in self.stack[at + 1:]]

        def cut(tags) -> None:
            for i, t in enumerate(inside):
                if t in tags:
                    del self.stack[at + 1 + i:]
                    del inside[i:]
                    return

        if tag in ("td", "th"):
            cut(("td", "th", "caption", "colgroup"))
            if "tr" not in inside:
                cut(("caption", "colgroup"))
                if not any(t in ROW_GROUPS for t in inside):
                    self._open(Node("tbody"))
                self._open(Node("tr"))
        elif tag == "tr":
            cut(("tr", "caption", "colgroup"))
            if not any(t in ROW_GROUPS for t in inside):
                self._open(Node("tbody"))
        else:
            cut(ROW_GROUPS | {"tr", "caption"} | ({"colgroup"} if tag != "col" else set()))
        return True

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "head":
            if self.in_head:
                self._leave_head()
            return
        if tag == "br":
            self._place(Node("br"))
            return
        if tag == "p" and self._index(("p",)) < 0:
            self.start("p", {})
        if tag in HEADINGS:
            self._close(HEADINGS)
            return
        if tag in FORMATTING:
            i = self._index((tag,), SCOPE_ENDS - {"button"})
            if i >= 0:
                if all(x.tag in FORMATTING for x in self.stack[i:]):
                    del self.stack[i:]
                else:  # closed out of order: what is open inside stays open
                    del self.stack[i]
            return
        if tag == "table" or tag in TABLE_PARTS:
            self._close((tag,), frozenset(("html",)) if tag == "table" else frozenset(("table", "html")))
        else:
            self._close((tag,), frozenset(("table", "td", "th", "caption", "html")))


def parse(text: str) -> Node:
    """The body element of the page."""
    builder = Builder()
    for kind, data, attrs in tokens(text):
        if kind == "text":
            builder.text(data)
        elif kind == "start":
            builder.start(data, attrs)
        else:
            builder.end(data)
    return builder.finish()


_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]+)", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*([a-z]+)", re.I)
_PRE_SPACE = re.compile(r"(?:^|;)\s*white-space\s*:\s*(?:pre|break-spaces)", re.I)


def is_hidden(node: Node) -> bool:
    """Whether the element makes no box at all."""
    a = node.attrs
    return (node.tag in HIDDEN or "hidden" in a or (node.tag == "dialog" and "open" not in a)
            or (node.tag == "input" and a.get("type", "").lower() == "hidden")
            or ("style" in a and [x.lower() for x in _DISPLAY.findall(a["style"])][-1:] == ["none"]))


def visibility(node: Node, inherited: bool) -> bool:
    """Whether text directly in the element is painted."""
    found = _VISIBILITY.findall(node.attrs["style"]) if "style" in node.attrs else None
    return found[-1].lower() == "visible" if found else inherited


def keeps_space(node: Node, inherited: bool) -> bool:
    return inherited or node.tag in ("pre", "textarea", "listing", "xmp", "plaintext") or (
        "style" in node.attrs and _PRE_SPACE.search(node.attrs["style"]) is not None)
