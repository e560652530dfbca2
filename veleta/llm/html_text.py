"""Visible text of HTML pages, laid out: blocks, lists and tables keep their shape.

A tree is built from tags with the end tags that HTML lets authors leave out; a walk over it, free
of recursion, emits the text that a reader would see. Elements that are not rendered, hidden
elements, closed details and the options of a list that are not chosen stay out; a descendant may
be visible again where only `visibility` hid it. Scripts count as run, so noscript is not shown.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta.llm.tables import in_arrow

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = set("head script style title template noscript datalist iframe noembed noframes object audio video canvas svg map".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary ul xmp".split()
)
# Blocks with an empty line around them.
SPACED = set("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul menu dir xmp".split())
LISTS = set("ul ol menu dir".split())
CLOSES_P = BLOCKS - set("body html option optgroup legend".split()) | {"table"}
# Open elements that a start tag ends, and the elements that end the search for them.
IMPLIED = {
    "li": ({"li"}, LISTS),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
    "th": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "colgroup": ({"caption", "colgroup"}, {"table"}),
    "rt": ({"rt", "rp"}, {"ruby"}),
    "rp": ({"rt", "rp"}, {"ruby"}),
    "body": ({"head"}, {"html"}),
}
# An end tag does not reach out of these.
FENCES = {"td", "th", "table", "caption", "template", "button"}
# A cell wider than this is not padded to, so that one long cell does not widen a whole table.
WIDEST = 60
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|</([a-zA-Z][^\s/>]*+)[^>]*+>?"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>?",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.children = tag, attrs, []

    def attributes(self) -> dict[str, str]:
        return {n.lower(): unescape(a or b or c or "") for n, a, b, c in ATTRIBUTE.findall(self.attrs)} if self.attrs else {}


def build(html: str) -> Node:
    """The tree of a page; text is held as strings."""
    root = Node("#root")
    stack, at = [root], 0
    still_open: Counter = Counter()

    def pop_to(depth: int) -> None:
        still_open.subtract(n.tag for n in stack[depth:])
        del stack[depth:]

    def close(names: set[str], until: set[str]) -> None:
        if not any(still_open[n] for n in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            tag = stack[depth].tag
            if tag in names:
                # Go on to the outermost of the names within reach.
                outer = depth
                while outer > 1 and stack[outer - 1].tag in names:
                    outer -= 1
                pop_to(outer)
                return
            if tag in until or tag in FENCES:
                return

    while at < len(html):
        found = MARKUP.search(html, at)
        if not found:
            stack[-1].children.append(unescape(html[at:]))
            break
        if found.start() > at:
            stack[-1].children.append(unescape(html[at : found.start()]))
        at = found.end()
        end, start, attrs = found.groups()
        if end:
            end = end.lower()
            if end == "br":
                stack[-1].children.append(Node("br"))
            for depth in range(len(stack) - 1, 0, -1) if still_open[end] else ():
                tag = stack[depth].tag
                if tag == end:
                    pop_to(depth)
                    break
                if tag in FENCES and end not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th", "body", "html"):
                    break
                if tag == "table":
                    break
        elif start:
            tag = start.lower()
            if tag in ("html", "body") and any(n.tag == tag for n in stack[:4]):
                continue
            if tag in CLOSES_P:
                close({"p"}, set())
            if tag in IMPLIED:
                close(*IMPLIED[tag])
            if stack[-1].tag == "head" and tag not in UNSEEN and tag not in VOID:
                pop_to(len(stack) - 1)
            node = Node(tag, attrs)
            stack[-1].children.append(node)
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(html, at)
                body = html[at : stop.start() if stop else len(html)]
                node.children.append(unescape(body) if tag in ("textarea", "title") else body)
                at = len(html) if not stop else (html.find(">", stop.end()) + 1 or len(html))
            elif tag not in VOID:
                stack.append(node)
                still_open[tag] += 1
        elif found.group().startswith("<![CDATA["):
            stack[-1].children.append(found.group()[9:].removesuffix("]]>"))
    return root


class Flow:
    """Lines of a run of blocks."""

    def __init__(self):
        self.lines: list[str] = []
        self.line = ""
        self.gap = False
        self.indents: list[str] = []
        self.bullet = ""

    def newline(self) -> None:
        if self.line.strip(" "):
            self._put(self.line.rstrip(" "))
        self.line = ""

    def _put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        indent = "".join(self.indents)
        if self.bullet:
            indent, self.bullet = indent[: len(indent) - len(self.bullet)] + self.bullet, ""
        self.lines.append(indent + line)

    def space(self) -> None:
        self.newline()
        self.gap = True

    def text(self, text: str) -> None:
        text = SPACE.sub(" ", text)
        if not self.line or self.line.endswith(" "):
            text = text.removeprefix(" ")
        self.line += text

    def kept(self, text: str) -> None:
        """Preformatted text."""
        first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        self.line += first
        for line in rest:
            self._put(self.line.rstrip())
            self.line = line

    def block(self, lines: list[str]) -> None:
        self.newline()
        for line in lines:
            self._put(line)

    def done(self) -> list[str]:
        self.newline()
        if self.bullet:
            self.bullet = ""
        return self.lines


def _hidden(attrs: dict[str, str], seen: bool) -> tuple[bool, bool]:
    """Whether the element is not rendered at all, and whether its own text is visible."""
    style = re.sub(r"\s+", "", attrs.get("style", "").lower())
    rules = dict(r.split(":", 1) for r in style.split(";") if ":" in r)
    value = {k: v.removesuffix("!important") for k, v in rules.items()}
    gone = value.get("display") == "none" or ("hidden" in attrs and "display" not in value) or value.get("content-visibility") == "hidden"
    visibility = value.get("visibility")
    return gone, seen if visibility in (None, "inherit") else visibility == "visible"


def _number(text: str | None, default: int, least: int = -(10**9), most: int = 10**9) -> int:
    found = re.match(r"\s*[+-]?\d{1,10}", text or "")
    return max(least, min(most, int(found.group()))) if found else default


def _chosen(select: Node, attrs: dict[str, str]) -> set[int]:
    """Options of a list that show: the selected ones, else the first; all where it shows several."""
    options, todo = [], [select]
    while todo:
        node = todo.pop()
        for child in reversed(node.children):
            if isinstance(child, Node):
                todo.append(child)
        if node.tag == "option":
            options.append(node)
    if "multiple" in attrs or _number(attrs.get("size"), 1) > 1:
        return {id(o) for o in options}
    marked = [o for o in options if "selected" in o.attributes()]
    return {id(o) for o in (marked[-1:] or options[:1])}


def _table_lines(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Cells in columns; each cell is its lines, its columns and its rows."""
    grid, held = [], {}
    for row in rows:
        cells, column = [], 0
        waiting = list(row)
        while waiting or column in held:
            if column in held:
                cells.append([])
                held[column] -= 1
                if not held[column]:
                    del held[column]
                column += 1
                continue
            lines, wide, deep = waiting.pop(0)
            for k in range(wide):
                cells.append(lines if not k else [])
                if deep > 1:
                    held[column] = deep - 1
                column += 1
        grid.append(cells)
    widths: dict[int, int] = {}
    for cells in grid:
        for k, lines in enumerate(cells):
            for line in lines:
                if len(line) <= WIDEST:
                    widths[k] = max(widths.get(k, 0), len(line))
    out = []
    for cells in grid:
        for n in range(max(map(len, cells), default=0)):
            parts = [c[n] if n < len(c) else "" for c in cells]
            while parts and not parts[-1]:
                parts.pop()
            padded = [part.ljust(widths.get(k, 0)) for k, part in enumerate(parts[:-1])]
            out.append(" | ".join(padded + parts[-1:]))
    return [line for line in out if line]


class _Table:
    def __init__(self):
        self.rows: list[list[tuple[list[str], int, int]]] = []


def render(html: str | None) -> str:
    """Visible text of a page; NULL and empty pages give the empty text."""
    if not html:
        return ""
    page = Flow()
    flows, tables, lists, chosen = [page], [], [], []
    # (node, whether its text is visible, inside preformatted text) on the way in; a function on the way out.
    todo: list = [(build(html), True, False)]
    while todo:
        item = todo.pop()
        if callable(item):
            item()
            continue
        node, seen, pre = item
        if isinstance(node, str):
            if seen and (not tables or len(flows) > tables[-1][1]):
                flows[-1].kept(node) if pre else flows[-1].text(node)
            elif seen and node.strip():  # text right inside a table stands before it
                flows[-1].block([SPACE.sub(" ", node).strip()])
            continue
        tag = node.tag
        if tag in UNSEEN or (tag == "option" and chosen and id(node) not in chosen[-1]):
            continue
        attrs = node.attributes()
        gone, seen = _hidden(attrs, seen)
        if gone or (tag == "dialog" and "open" not in attrs) or (tag == "input"):
            continue
        flow, children = flows[-1], node.children
        if tag == "br":
            if not flow.line.strip(" "):
                flow.gap = True  # a break on an empty line leaves that line empty
            flow.newline()
            continue
        leave: list = []
        if tag == "details" and "open" not in attrs:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        if tag in ("pre", "textarea", "xmp", "listing"):
            pre = True
            if children and isinstance(children[0], str):
                children = [children[0].removeprefix("\r\n").removeprefix("\n"), *children[1:]]
        if tag == "table":
            flow.space()
            tables.append((_Table(), len(flows)))

            def end_table(flow=flow):
                table, _ = tables.pop()
                flow.block(_table_lines(table.rows))
                flow.space()

            leave.append(end_table)
        elif tag == "tr" and tables:
            tables[-1][0].rows.append([])
        elif tag in ("td", "th") and tables:
            cell = Flow()
            flows.append(cell)
            table = tables[-1][0]
            if not table.rows:
                table.rows.append([])
            row = table.rows[-1]
            wide, deep = _number(attrs.get("colspan"), 1, 1, 1000), _number(attrs.get("rowspan"), 1, 1, 65534)

            def end_cell(cell=cell, row=row, wide=wide, deep=deep):
                flows.pop()
                row.append(([line for line in cell.done() if line], wide, deep))

            leave.append(end_cell)
        elif tag == "caption" and tables:
            cell = Flow()
            flows.append(cell)

            def end_caption(cell=cell, flow=flow):
                flows.pop()
                flow.block(cell.done())

            leave.append(end_caption)
        elif tag in LISTS:
            flow.space() if not lists else flow.newline()
            step = -1 if "reversed" in attrs else 1
            count = sum(isinstance(c, Node) and c.tag == "li" for c in children)
            lists.append([tag == "ol", _number(attrs.get("start"), count if step < 0 else 1), step, True])

            def end_list(flow=flow):
                lists.pop()
                flow.newline() if lists else flow.space()

            leave.append(end_list)
        elif tag == "li":
            flow.newline()
            bullet = "- "
            if lists and lists[-1][0]:
                number = _number(attrs.get("value"), lists[-1][1])
                bullet, lists[-1][1] = f"{number}. ", number + lists[-1][2]
            flow.indents.append(" " * len(bullet))
            flow.bullet = bullet if seen else ""
            if lists and not lists[-1][3]:
                flow.gap = False  # items follow each other without empty lines
            if lists:
                lists[-1][3] = False

            def end_item(flow=flow):
                flow.newline()
                flow.indents.pop()
                flow.bullet = ""

            leave.append(end_item)
        elif tag in SPACED:
            flow.space() if not (tag == "p" and flow.bullet) else flow.newline()
            indent = "  " if tag in ("blockquote", "dl") else ""
            flow.indents.append(indent)

            def end_spaced(flow=flow):
                flow.newline()
                flow.indents.pop()
                flow.space()

            leave.append(end_spaced)
        elif tag in BLOCKS or tag == "textarea":
            flow.newline()
            leave.append(flow.newline)
        if tag == "select":
            chosen.append(_chosen(node, attrs))
            leave.append(chosen.pop)
        todo += leave[::-1]
        todo += [(c, seen, pre) for c in reversed(children)]
    return "\n".join(page.done())


def _render_all(batches):
    for batch in batches:
        for first in range(0, len(batch), 256):
            part = batch.slice(first, 256)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([render(h) for h in part.column(1).to_pylist()], pa.string())], names=["page_id", "text"]
            )


def visible_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id and visible text of every row.

    NULL and empty pages give the empty text; broken markup is read as browsers would roughly do
    and never fails. Pages are rendered one by one and whole, so repeated rows and NULL ids come
    out alike; other columns are not read. An empty table gives no rows.
    """
    own = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{html_col}`").cast("string").alias("html"))
    return in_arrow(own, _render_all, "page_id long, text string")
