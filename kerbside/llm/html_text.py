"""Visible text of web pages, laid out as a browser would: blocks on lines of their own, lists with marks, tables in columns."""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.tables import id_and_bytes

# The element categories of the HTML standard that layout depends on.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "script style template head title noscript noframes iframe object audio video canvas svg math datalist meter progress".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody"
    " td tfoot th thead tr ul caption listing".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol menu dir dl table figure fieldset listing hr".split())
ROWED = frozenset("table tbody thead tfoot tr".split())
# Foreign elements close themselves, these tags end them, and inside of the last ones tags are those of HTML again.
FOREIGN = frozenset({"svg", "math"})
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p"
    " pre ruby s small span strong strike sub sup table tt u ul var".split()
)
HTML_INSIDE = frozenset("foreignobject desc title mi mo mn ms mtext".split())
ENDS_SELECT = frozenset("select input textarea keygen".split())
LISTS = frozenset("ul ol menu dir".split())
ENDS_P = BLOCKS - frozenset("dd dt li td th tr tbody thead tfoot caption option optgroup body html summary legend".split()) | {"p"}
SCOPE = frozenset("html table td th caption button object template".split())
# A start tag closes open elements of these names, looking up no further than the names after them.
IMPLIED_ENDS = {
    "li": (("li",), LISTS | {"table", "td", "th"}),
    "dt": (("dt", "dd"), frozenset({"dl", "table", "td", "th"})),
    "dd": (("dt", "dd"), frozenset({"dl", "table", "td", "th"})),
    "option": (("option",), frozenset({"select", "datalist"})),
    "optgroup": (("optgroup",), frozenset({"select"})),
    "td": (("td", "th"), frozenset({"table"})),
    "th": (("td", "th"), frozenset({"table"})),
    "tr": (("tr", "caption", "colgroup"), frozenset({"table"})),
    **{x: (("tbody", "thead", "tfoot", "caption", "colgroup"), frozenset({"table"})) for x in ("tbody", "thead", "tfoot", "colgroup")},
    **{h: (("h1", "h2", "h3", "h4", "h5", "h6"), BLOCKS - {"h1", "h2", "h3", "h4", "h5", "h6"}) for h in ("h1", "h2", "h3", "h4", "h5", "h6")},
}


class Node:
    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes, self.children = name, attributes, []

    @property
    def hidden(self) -> bool:
        style = "".join(self.attributes.get("style", "").lower().split())
        return (
            self.name in HIDDEN
            or "hidden" in self.attributes
            or (self.name == "dialog" and "open" not in self.attributes)
            or "display:none" in style
            or "visibility:hidden" in style
        )


class TreeBuilder(HTMLParser):
    """An element tree with the tags that the standard lets an author leave out."""

    READS_TEXTAREA = "textarea" in getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ())  # newer versions of Python

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.foreign = [False]  # of each open element, whether its content is that of svg or math
        self.times: Counter = Counter()  # open elements by name, so that nothing is searched for in vain

    def _pop(self, k: int) -> None:
        self.times.subtract(n.name for n in self.open[k:])
        del self.open[k:], self.foreign[k:]

    def _close(self, names: tuple[str, ...], stops: frozenset) -> None:
        if not any(self.times[n] > 0 for n in names):
            return
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].name in names:
                self._pop(k)
                return
            if self.open[k].name in stops:
                return

    def _add(self, name: str, attributes: dict[str, str]) -> None:
        node = Node(name, attributes)
        self.open[-1].children.append(node)
        if name not in VOID:
            html = name in HTML_INSIDE or (name == "annotation-xml" and "html" in attributes.get("encoding", "").lower())
            self.open.append(node)
            self.foreign.append(name in FOREIGN or (self.foreign[-1] and not html))
            self.times[name] += 1

    def _end_foreign(self) -> None:
        while self.foreign[-1]:
            self._pop(len(self.open) - 1)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html":
            return
        if tag in ENDS_FOREIGN or (tag == "font" and any(k in ("color", "face", "size") for k, _ in attrs)):
            self._end_foreign()
        if self.foreign[-1]:
            self._add(tag, {k: v or "" for k, v in attrs})
            return
        if tag in ENDS_SELECT:
            self._close(("select",), SCOPE)
        if tag == "body":
            self._close(("head",), frozenset())
        elif self.open[-1].name == "head" and tag not in HIDDEN | VOID:
            self._pop(len(self.open) - 1)
        if tag in ENDS_P:
            self._close(("p",), SCOPE)
        if tag == "optgroup":
            self._close(*IMPLIED_ENDS["option"])
        if tag in IMPLIED_ENDS:
            self._close(*IMPLIED_ENDS[tag])
        if tag in ("td", "th") and self.open[-1].name in ("table", "tbody", "thead", "tfoot"):
            self._add("tr", {})
        self._add(tag, {k: v or "" for k, v in attrs})
        if tag == "textarea" and not self.READS_TEXTAREA:
            self.set_cdata_mode(tag)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag in FOREIGN or (len(self.open) > 1 and self.open[-1].name == tag and self.foreign[-2]):
            self._pop(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("br", "p"):
            self._end_foreign()
        if tag == "br":
            self._add("br", {})
        elif tag == "p" and self.times["p"] <= 0:
            self.handle_starttag("p", [])
            self._pop(len(self.open) - 1)
        elif tag not in ("html", "body"):
            stops = frozenset() if tag == "table" else frozenset({"table"}) if tag in ROWED else SCOPE - {tag}
            self._close((tag,), stops)

    def handle_data(self, data: str) -> None:
        if self.cdata_elem == "textarea" and not self.READS_TEXTAREA:
            data = unescape(data)
        if self.open[-1].name == "head" and data.strip():
            self._pop(len(self.open) - 1)
        self.open[-1].children.append(data)


def width_of(line: str) -> int:
    """Columns that a line takes: wide characters two, combining ones none."""
    if line.isascii():
        return len(line)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in line)


class Lines:
    """Lines of a block under construction."""

    def __init__(self) -> None:
        self.done: list[str] = []
        self.line = ""
        self.gap = False
        self.space = False

    def text(self, data: str, kept: bool) -> None:
        if kept:
            if self.space:
                self._put(" ")
                self.space = False
            first, *rest = data.expandtabs(8).split("\n")
            self._put(first)
            for part in rest:
                self.end(True)
                self._put(part)
            return
        # Only the white space of HTML collapses; a no-break space is a character like any other.
        words = data.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\f", " ").split(" ")
        for nth, word in enumerate(words):
            if nth:
                self.space = bool(self.line)
            if word:
                self._put((" " if self.space else "") + word)
                self.space = False

    def _put(self, data: str) -> None:
        if data:
            if self.gap and self.done and not self.line:
                self.done.append("")
            self.gap = False
            self.line += data

    def end(self, forced: bool = False) -> None:
        if self.line or forced:
            if forced and not self.line and self.gap and self.done:
                self.done.append("")
                self.gap = False
            self.done.append(self.line.rstrip(" "))
        self.line, self.space = "", False

    def block(self, lines: list[str], spaced: bool) -> None:
        self.end()
        if lines:
            if (spaced or self.gap) and self.done and self.done[-1]:
                self.done.append("")
            self.done += lines
            self.gap = spaced
        elif spaced:
            self.gap = True

    def finished(self) -> list[str]:
        self.end()
        while self.done and not self.done[-1].strip():
            self.done.pop()
        while self.done and not self.done[0].strip():
            self.done.pop(0)
        return self.done


def table_lines(rows: list[list[list[str]]]) -> list[str]:
    """Rows of cells (each a list of lines) as aligned columns, two spaces apart."""
    columns = max(map(len, rows), default=0)
    widths = [max((width_of(x) for row in rows if k < len(row) for x in row[k]), default=0) for k in range(columns)]
    out = []
    for row in rows:
        for nth in range(max(map(len, row), default=0)):
            parts = [cell[nth] if nth < len(cell) else "" for cell in row]
            padded = [p + " " * (widths[k] - width_of(p)) for k, p in enumerate(parts)]
            out.append("  ".join(padded).rstrip(" "))
    return out


def placed(rows: list) -> list[list[list[str]]]:
    """Rows of (lines, columns, rows or 0 for all that follow) as rows of cells; None ends a group, which no cell goes beyond."""
    out, taken = [], {}
    for row in rows:
        if row is None:
            taken = {}
            continue
        cells, below = [], {k: n - 1 for k, n in taken.items() if n > 1}
        for lines, across, down in row:
            while len(cells) in taken:
                cells.append([])
            for nth in range(across):
                if down != 1:
                    below[len(cells)] = max(below.get(len(cells), 0), down - 1 if down else len(rows))
                cells.append([] if nth else lines)
        taken = below
        out.append(cells)
    return out


def rendered(root: Node) -> list[str]:
    """Lines of a tree, bottom up without recursion, so that deep trees are no danger."""
    # A frame: node, its remaining children, its lines, whether white space is kept, cells of its rows, number of list items,
    # and whether it is an inline element, which goes on in the lines of the one around it.
    stack = [[root, iter(root.children), Lines(), False, [], 0, False]]
    while True:
        node, children, lines, kept, rows, _, inline = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            if inline:
                continue
            if rows and node.name not in ROWED:
                lines.block(table_lines(placed(rows)), False)
            own = lines.finished()
            if not stack:
                return own
            parent = stack[-1]
            if node.name in ("td", "th") and parent[0].name == "tr":
                across = min(1000, _number(node.attributes.get("colspan"), 1))
                down = _number(node.attributes.get("rowspan"), 1)
                parent[4].append((own, max(1, across), down if down >= 0 else 1))
            elif node.name == "tr":
                parent[4].append(rows)
                if own:
                    parent[2].block(own, False)
            elif node.name in ("tbody", "thead", "tfoot"):
                parent[4].extend([None, *rows, None])
                parent[2].block(own, False)
            else:
                if node.name == "table":
                    own = own + table_lines(placed(rows))
                if node.name == "li":
                    at = parent[5] = parent[5] + 1
                    if parent[0].name == "ol":
                        at = _number(node.attributes.get("value"), _number(parent[0].attributes.get("start"), 1) + at - 1)
                    mark = f"{at}. " if parent[0].name == "ol" else "- "
                    own = [(mark if k == 0 else " " * len(mark) if x else "") + x for k, x in enumerate(own)] or [mark.rstrip()]
                elif node.name in ("dd", "blockquote"):
                    own = [x and "  " + x for x in own]
                elif node.name == "hr":
                    own = ["---"]
                nested = node.name in LISTS and any(f[0].name == "li" for f in stack)
                parent[2].block(own, node.name in SPACED and not nested)
            continue
        if rows and not inline and node.name not in ROWED and (child.strip() if isinstance(child, str) else child.name not in ROWED - {"table"}):
            lines.block(table_lines(placed(rows)), False)
            rows.clear()
        if isinstance(child, str):
            if node.name not in ROWED or child.strip():
                lines.text(child, kept)
        elif child.hidden:
            continue
        elif child.name == "br":
            lines.end(True)
        elif child.name in BLOCKS:
            if node.name == "details" and "open" not in node.attributes and child.name != "summary":
                continue
            stack.append([child, iter(child.children), Lines(), kept or child.name in ("pre", "listing"), [], 0, False])
            if child.name in ("option", "optgroup") and child.attributes.get("label"):
                stack[-1][2].block([child.attributes["label"]], False)
                if child.name == "option":
                    stack[-1][1] = iter([x for x in child.children if not isinstance(x, str)])
        elif child.name == "textarea":
            lines.text("".join(x for x in child.children if isinstance(x, str)).removeprefix("\n"), True)
        elif child.name not in VOID:
            stack.append([child, iter(child.children), lines, kept, rows, 0, True])


def _number(value: str | None, default: int) -> int:
    try:
        return max(-(10**6), min(10**6, int((value or "").strip())))
    except ValueError:
        return default


def visible_text(html: str) -> str:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    if builder.cdata_elem == "textarea" and builder.rawdata:  # never closed
        builder.handle_data(builder.rawdata)
    return "\n".join(rendered(builder.root))


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row of ``pages`` (page_id, url, html).

    A null page has a null text; an empty one, or one that shows nothing, an empty text. Repeated page_ids are pages of their
    own. Other columns are left out. No shuffle: each page is laid out by the task that reads it.
    """

    def laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, bodies in id_and_bytes(batches):
            texts = [None if key["empty"] else visible_text(body.decode()) for key, body in zip(keys, bodies)]
            columns = [pa.array([k["page_id"] for k in keys], pa.int64()), pa.array([k["url"] for k in keys], pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"])

    html = F.col("html").cast("string")
    keys = F.struct(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.isNull().alias("empty"))
    return pages.select(keys.alias("keys"), html.alias("html")).mapInArrow(laid_out, "page_id bigint, url string, text string")
