"""Layout-aware text of HTML pages.

A tokenizer and tree builder read the page: void and raw-text elements, tags that are implied
(an open ``p`` ends before a block, ``li``, ``dt``/``dd``, ``option``, table rows, cells and row
groups end before the next of their kind) and end tags that close all that is open inside. The
tree is then walked once and every visible text is laid out: white space collapses as in a
browser except in ``pre`` and ``textarea``; blocks stand on lines of their own and paragraphs,
headings, lists and tables are set off by a blank line; list items carry their marker (numbers
count from ``start``) and nested lists are indented, by ``INDENT`` blanks at most; table cells are padded
to the width of their column (lines beyond ``WIDE`` characters widen no column) and joined by two
blanks, cells of several lines stay in their column, ``colspan`` and ``rowspan`` leave the covered
places empty. Alignment puts ``GAP`` blanks at most before a text (see ``grid``), so it adds to a page in
proportion to its texts. Formulas and labels of drawings are text like other.

Not visible, and left out with all they hold: head, script, style, template, noscript, media and
embedded content, comments, elements with ``hidden`` or ``display:none`` in their style attribute,
closed ``dialog``, form fields' values, definitions in drawings and annotations in formulas. Text
under ``visibility:hidden`` is left out, but for elements inside that are ``visible`` again.

Both walks use explicit stacks, so nesting depth is not limited by the interpreter, and take time in
proportion to the page.

Defined results: null pages and pages without visible text give "". A tag or comment that never
ends hides the rest of the page, as in a browser; a lone ``<`` is text. Pages are read whole.
Repeated rows each get their result; extra columns pass through.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import free_name, packed, quoted, ship, table, unpacked

# Element classes of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset("head script style title template noscript iframe noembed noframes object audio video canvas datalist area base link meta param source track rp".split())
#: hidden inside svg or math only
FOREIGN_HIDDEN = {"svg": frozenset("defs desc metadata symbol clippath mask marker pattern lineargradient radialgradient filter".split()), "math": frozenset(("annotation", "annotation-xml"))}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SPACED = HEADINGS | frozenset("p ul ol dl table pre blockquote figure fieldset hr menu".split())
BLOCKS = SPACED | frozenset("address article aside body caption center dd details dialog dir div dt figcaption footer form header hgroup html legend li main nav option optgroup search section select summary textarea xmp tr thead tbody tfoot".split())
ENDS_P = BLOCKS - frozenset("body html caption dd dt li option optgroup select legend summary tr thead tbody tfoot textarea".split()) | frozenset(("dd", "dt", "li", "summary"))
LISTS = frozenset(("ul", "ol", "menu", "dir"))
GROUPS = frozenset(("thead", "tbody", "tfoot"))
#: start tag -> (open elements that it ends, elements that stop the search)
IMPLIED = {"li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
           "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
           **{g: ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}) for g in GROUPS}, "body": ({"head"}, {"html"}),
           "rt": ({"rt", "rp"}, {"ruby"}), "rp": ({"rt", "rp"}, {"ruby"})}
SCOPES = frozenset(("table", "td", "th", "caption", "html", "button", "template"))
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']*))?""")
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
INDENT = 40  # blanks at most before a line
WIDE = 80  # a longer line of a cell does not widen its column
GAP = 2 * (WIDE + 2)  # blanks at most before a text in a table: two of the widest columns
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


def _attributes(page: str, at: int) -> tuple[dict[str, str], int]:
    """Attributes from ``at``, and where the tag ends (-1: never)."""
    found: dict[str, str] = {}
    while at < len(page):
        if page[at] == ">":
            return found, at + 1
        m = _ATTRIBUTE.match(page, at)
        if m:
            value = m[2] or ""
            found.setdefault(m[1].lower(), html.unescape(value[1:-1] if value[:1] in "\"'" else value))
            at = m.end()
        else:
            at += 1
    return found, -1


def tokens(page: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """("text", text, {}), ("start", name, attributes) and ("end", name, {})."""
    at = begin = 0
    while True:
        lt = page.find("<", at)
        if lt < 0:
            if begin < len(page):
                yield "text", html.unescape(page[begin:]), {}
            return
        m = _NAME.match(page, lt)
        if not m and page[lt + 1:lt + 2] not in ("!", "?", "/"):
            at = lt + 1
            continue
        if begin < lt:
            yield "text", html.unescape(page[begin:lt]), {}
        if not m:
            mark, skip = ("-->", 2) if page.startswith("<!--", lt) else (">", 1)
            end = page.find(mark, lt + skip)
            if end < 0:
                return
            at = begin = end + len(mark)
            continue
        name = m[1].lower()
        attributes, at = _attributes(page, m.end())
        if at < 0:
            return
        begin = at
        if page[lt + 1] == "/":
            yield "end", name, {}
            continue
        yield "start", name, attributes
        if name in RAW:
            stop = _RAW_END[name].search(page, at)
            text = page[at:stop.start() if stop else len(page)]
            if text:
                yield "text", html.unescape(text) if name in ("textarea", "title") else text, {}
            yield "end", name, {}
            if not stop:
                return
            at = begin = _attributes(page, stop.end())[1]
            if at < 0:
                return


class Node:
    __slots__ = ("name", "attributes", "children", "hidden", "visible")

    def __init__(self, name: str, attributes: dict[str, str], hidden: bool = False):
        self.name, self.attributes, self.children = name, attributes, []
        style = attributes.get("style", "")
        self.hidden = hidden or name in HIDDEN or "hidden" in attributes or bool(_UNSEEN.search(style)) or name == "dialog" and "open" not in attributes or name == "input"
        said = _VISIBILITY.findall(style)
        self.visible = said[-1].lower() == "visible" if said else None  # None: as around it


class _Open:
    """The open elements, and where in the stack each name is open."""

    def __init__(self, root: Node):
        self.stack, self.places = [root], {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.name, []).append(len(self.stack))
        self.stack.append(node)

    def cut(self, at: int) -> None:
        for node in reversed(self.stack[at:]):
            self.places[node.name].pop()
        del self.stack[at:]

    def last(self, names) -> int:
        """The innermost place of any of ``names``, 0 for none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def end(self, names, stops) -> None:
        """Close up to the outermost open element of ``names`` that no element of ``stops`` hides."""
        inside = self.last(stops)
        found = [held[i] for n in names if (held := self.places.get(n)) and (i := bisect.bisect(held, inside)) < len(held)]
        if found:
            self.cut(min(found))


def parse(page: str) -> Node:
    """The page's tree. Every step looks names up instead of walking the open elements, so nesting of
    any depth is read in linear time."""
    root = Node("#root", {})
    held = _Open(root)
    for kind, value, attributes in tokens(page):
        stack = held.stack
        if kind == "text":
            stack[-1].children.append(value)
        elif kind == "start":
            if value in ENDS_P and held.places.get("p"):
                held.end(("p",), SCOPES)
            if value in HEADINGS and stack[-1].name in HEADINGS:
                held.cut(len(stack) - 1)
            if value in IMPLIED:
                held.end(*IMPLIED[value])
            node = Node(value, attributes, any(value in names and held.places.get(f) for f, names in FOREIGN_HIDDEN.items()))
            stack[-1].children.append(node)
            if value not in VOID:
                held.push(node)
        else:
            if value == "br":
                stack[-1].children.append(Node("br", {}))
            stops = () if value in ("table", "body", "html") else ("table",) if value in ("tr", "td", "th", "caption") or value in GROUPS else SCOPES - {value}
            at = held.last((value,))
            if at and at > held.last(stops):
                held.cut(at)
    return root


class Layout:
    """Lines of one flow of text."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank = self.space = False
        self.indent = 0
        self.marker = ""

    def text(self, value: str, pre: bool) -> None:
        if pre:
            for i, part in enumerate(value.split("\n")):
                if i:
                    self.flush(keep=True)
                if part:
                    self._put(part)
            return
        words = _BLANKS.sub(" ", value)
        if not words:
            return
        if words[0] == " ":
            self.space, words = True, words[1:]
        if words:
            tail = words[-1] == " "
            self._put((" " if self.space and self.line else "") + words.rstrip(" "))
            self.space = tail

    def _put(self, value: str) -> None:
        if not self.line:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
        self.line.append(value)

    def flush(self, keep: bool = False) -> None:
        """End the line; ``keep``: also an empty one."""
        if self.line or self.marker and keep:
            if self.blank and self.lines and not self.line:
                self.lines.append("")
                self.blank = False
            lead = " " * min(self.indent - len(self.marker), INDENT) + self.marker
            self.marker = ""
            self.lines.append((lead + "".join(self.line)).rstrip(" "))
        elif keep and self.lines:
            self.lines.append("")
        self.line, self.space = [], False

    def block(self, spaced: bool) -> None:
        self.flush()
        self.blank |= spaced

    def rows(self, lines: list[str]) -> None:
        for x in lines[:1]:
            self._put(x)
            self.flush(keep=True)
        lead = " " * min(self.indent, INDENT)
        self.lines += [(lead + x).rstrip(" ") for x in lines[1:]] if lead else lines[1:]


def _whole(value: str | None, default: int, most: int) -> int:
    return min(int(value), most) if value and value.strip().isdecimal() and len(value) < 20 else most if value and value.strip().isdecimal() else default


def grid(rows: list[tuple[int, list[tuple[list[str], int, int]]]]) -> list[str]:
    """Aligned lines of table rows; a row is (row group, cells), a cell (lines, colspan, rowspan), where a
    rowspan of 0 reaches to the end of the row group; none reaches beyond it. Columns are as wide as
    their longest line of up to ``WIDE`` characters. Before each text stand the blanks that bring it to its
    column, ``GAP`` at most with those it begins with. This holds for every table, whatever its size, and
    keeps the text in proportion to the page."""
    left, after = [0] * len(rows), 0
    for i in range(len(rows) - 1, -1, -1):  # rows of the group from here on
        after = after + 1 if i + 1 < len(rows) and rows[i + 1][0] == rows[i][0] else 1
        left[i] = after
    placed: list[dict[int, list[str]]] = []
    covered: dict[int, int] = {}  # column -> first row that it is free in
    for i, (_, row) in enumerate(rows):
        cells, column = {}, 0
        for lines, columns, down in row:
            while covered.get(column, 0) > i:
                column += 1
            cells[column] = lines
            down = min(down or left[i], left[i])
            if down > 1:
                for c in range(column, column + columns):
                    covered[c] = max(covered.get(c, 0), i + down)
            column += columns
        placed.append(cells)
    if all(c == 0 for cells in placed for c in cells):  # one column, as in tables that only frame others
        return [x for cells in placed for x in cells.get(0, ())]
    widths: dict[int, int] = {}
    for cells in placed:
        for c, lines in cells.items():
            if any(lines):
                widths[c] = max(widths.get(c, 0), max((len(x) for x in lines if len(x) <= WIDE), default=0))
    starts, at = {}, 0
    for c in sorted(widths):
        starts[c] = at
        at += widths[c] + 2
    out = []
    for cells in placed:
        made: list[list[str]] = [[] for _ in range(max(map(len, cells.values()), default=0))]
        ends = [0] * len(made)  # the place in the table up to which each line is filled
        for c in sorted(cells):
            for i, x in enumerate(cells[c]):
                if x:
                    blanks = min(starts[c] - ends[i], max(GAP - len(x) + len(x.lstrip(" ")), 2 if made[i] else 0))
                    made[i] += [" " * blanks, x]
                    ends[i] = starts[c] + min(len(x), widths[c])
        out += map("".join, made)
    return out


def render(root: Node) -> tuple[str, int, int]:
    """Visible text of a tree, its list items and its table cells."""
    flows, tables, lists, widths = [Layout()], [], [], []
    pre = items = cells = groups = 0
    shown = [True]
    work: list[tuple[object, bool]] = [(root, False)]
    while work:
        node, leaving = work.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if shown[-1]:
                flow.text(node, pre > 0)
            continue
        name = node.name
        if not leaving:
            if node.hidden:
                continue
            if name == "br":
                if shown[-1]:
                    flow.flush(keep=True)
                continue
            shown.append(shown[-1] if node.visible is None else node.visible)
            if name in ("td", "th") and tables:
                if not tables[-1]:
                    tables[-1].append((groups, []))
                flows.append(Layout())
                cells += 1
            elif name == "table":
                flow.block(True)
                tables.append([])
            elif name == "tr" and tables:
                tables[-1].append((groups, []))
            elif name in GROUPS and tables:
                groups += 1
            elif name == "text":  # labels in a drawing
                flow.text(" ", False)
            elif name in BLOCKS:
                flow.block(name in SPACED and not (name in LISTS and lists))
                if name in LISTS:
                    lists.append([_whole(node.attributes.get("start"), 1, 10**9) if name == "ol" else None])
                elif name == "li":
                    items += 1
                    count = lists[-1][0] if lists else None
                    marker = "- " if count is None else f"{_whole(node.attributes.get('value'), count, 10**9)}. "
                    if count is not None:
                        lists[-1][0] = int(marker[:-2]) + 1
                    if flow.marker:
                        flow.flush(keep=True)
                    flow.indent += len(marker)
                    widths.append(len(marker))
                    flow.marker = marker
                elif name in ("blockquote", "dd"):
                    flow.indent += 2
            pre += name in ("pre", "textarea", "xmp")
            work.append((node, True))
            work.extend((c, False) for c in reversed(node.children))
            continue
        pre -= name in ("pre", "textarea", "xmp")
        shown.pop()
        groups += name in GROUPS
        if name in ("td", "th") and tables:
            flow.flush()
            flows.pop()
            # limits of the HTML standard; a rowspan of 0 is the rest of the row group
            tables[-1][-1][1].append((flow.lines, _whole(node.attributes.get("colspan"), 1, 1000) or 1, _whole(node.attributes.get("rowspan"), 1, 65534)))
        elif name == "table":
            flow.flush()
            flow.rows(grid(tables.pop()))
            flow.block(True)
        elif name in BLOCKS and not (name == "tr" and tables):
            if name == "li":
                flow.flush(keep=bool(flow.marker))
                flow.marker = ""
                flow.indent -= widths.pop()
            elif name in ("blockquote", "dd"):
                flow.flush()
                flow.indent -= 2
            elif name in LISTS:
                lists.pop()
            flow.block(name in SPACED and not (name in LISTS and lists))
    flows[0].flush()
    lines = flows[0].lines
    while lines and not lines[-1]:
        lines.pop()
    return "\n".join(lines), items, cells


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rb in batches:
        out = []
        for i in range(rb.num_rows):
            text, items, cells = render(parse(rb.column("page")[i].as_py() or ""))
            out.append({"text": text, "n_lines": text.count("\n") + 1 if text else 0, "n_items": items, "n_cells": cells})
        yield pa.RecordBatch.from_arrays([rb.column("row"), rb.column("page"), pa.array(out, pa.struct([("text", pa.string()), ("n_lines", pa.int64()), ("n_items", pa.int64()), ("n_cells", pa.int64())]))], names=["row", "page", "found"])


_FOUND = T.StructType([T.StructField("text", T.StringType()), *(T.StructField(n, T.LongType()) for n in ("n_lines", "n_items", "n_cells"))])


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with a struct column ``rendered`` (``rendered_`` if taken): text, n_lines, n_items
    (list items) and n_cells (table cells)."""
    ship(pages.sparkSession)
    row = pages.select(packed(pages, html_col), quoted(html_col).cast("string").alias("page"))
    out = row.mapInArrow(_rendered, T.StructType([*row.schema.fields, T.StructField("found", _FOUND)]))
    return out.select(*unpacked(pages, html_col, "page"), F.col("found").alias(free_name(pages, "rendered")))


def op5(spark, sf_dir: str) -> DataFrame:
    """Registered query: the visible text of every page."""
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "rendered.text", "rendered.n_lines", "rendered.n_items", "rendered.n_cells")
