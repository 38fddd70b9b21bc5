"""Text of HTML pages as they are laid out.

A page becomes a tree, with the tags authors leave out put in (paragraphs end where a
block begins, list items and table cells where the next one does), and the tree is
rendered: blocks on lines of their own, paragraphs and headings with a blank line
around, list items with their marker and indented, preformatted text as it is, and
tables with their cells in aligned columns, cells over several rows or columns included.
Everything visible is kept, navigation and footers too, and the text in buttons and
filled-in fields; what a browser does not show (head, scripts, styles, hidden elements)
is left out. ``display`` hides all that is in an element, ``visibility`` is inherited and
may be set back. Nothing recurses, so nesting may be as deep as it likes.

Layout has bounds, text has none: a cell is padded to CELL_WIDTH at most, of the levels
of indentation the innermost INDENTED are shown, and the columns that a cell of an
earlier row holds are kept free up to HELD columns from the left.

Defined results: NULL and empty pages have the empty text. Markup that is cut off or
not closed ends with the page; an opening without an end is text. Repeated rows are
pages of their own. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, text_column

# Cells are padded to the widest of their column, but no further than this.
CELL_WIDTH = 60
# Levels of indentation that are shown.
INDENTED = 20
# Columns in which a cell may reach down into later rows.
HELD = 100

# Elements by what the HTML standard says of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style template title noscript noframes iframe noembed object audio video canvas datalist".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr".split())
BLOCKS = SPACED | frozenset(
    "address article aside body center details dialog dd div dt fieldset figcaption footer form header hgroup "
    "html legend li main menu nav option optgroup search section summary tr caption".split()
)
# An end tag of an inline element does not look beyond these.
BARRIERS = BLOCKS | frozenset("td th tbody thead tfoot button select".split())
# Kinds of input that show no text.
TEXTLESS = frozenset("hidden checkbox radio file image color range password".split())
LABELS = {"submit": "Submit", "reset": "Reset"}
IN_HEAD = frozenset("base link meta title style script noscript template head".split())
# A start tag closes these open elements, looking no further than the scope.
CLOSES = {
    **{tag: ({"p"}, {"button", "table", "td", "th", "caption"}) for tag in BLOCKS - {"li", "dd", "dt", "tr", "option"}},
    "li": ({"li", "p"}, {"ul", "ol", "menu", "table"}),
    "dd": ({"dd", "dt", "p"}, {"dl", "table"}),
    "dt": ({"dd", "dt", "p"}, {"dl", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th", "caption"}, {"tr", "table"}),
    "th": ({"td", "th", "caption"}, {"tr", "table"}),
    "tr": ({"td", "th", "tr", "caption"}, {"table"}),
    **{tag: ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption"}, {"table"}) for tag in ("tbody", "thead", "tfoot")},
}

# An attribute as a browser reads it: a quote opens a string right after the equals sign
# only; elsewhere it is a character of the name or value. What is cut off goes on to the end.
_NAME = r"(?:=[^ \t\n\r\f/>=]*+|[^ \t\n\r\f/>=]++)"
_VALUE = r"""[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^ \t\n\r\f>"'][^ \t\n\r\f>]*+)?+"""
# Markup that is cut off goes on to the end of the page, so that every position is read once.
_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)((?:[ \t\n\r\f/]++|{_NAME}(?:{_VALUE})?+)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(rf"({_NAME})({_VALUE})?+")
# What of a style is no declaration: comments, strings and arguments.
_ASIDE = re.compile(r"/\*.*?(?:\*/|\Z)|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|\([^)]*+(?:\)|\Z)", re.S)
_IMPORTANT = re.compile(r"\s*!\s*important\s*\Z", re.I)
_SPACES = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes = tag, attributes
        self.children: list[Node | str] = []


def attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        value = value.lstrip(" \t\n\r\f")[1:].lstrip(" \t\n\r\f")
        if value[:1] in ("'", '"'):
            value = value[1:].removesuffix(value[0])
        found.setdefault(name.lower(), unescape(value))
    return found


def declarations(style: str) -> dict[str, str]:
    """Properties of a style, the last of each, unless an earlier one is important."""
    found: dict[str, tuple[bool, str]] = {}
    for declaration in _ASIDE.sub(" ", style).split(";"):
        name, _, value = declaration.partition(":")
        plain = _IMPORTANT.sub("", value)
        name, important = name.strip().lower(), plain != value
        if plain.strip() and important >= found.get(name, (False, ""))[0]:
            found[name] = important, plain.strip().lower()
    return {name: value for name, (_, value) in found.items()}


def tree(page: str) -> Node:
    """The elements of a page under one root."""
    root = Node("")
    stack = _Stack(root)
    at, end = 0, len(page)
    while at < end:
        match = _MARKUP.search(page, at)
        text = unescape(page[at : match.start() if match else end])
        if text:
            if stack.top.tag == "head" and text.strip():
                stack.cut(len(stack.nodes) - 1)
            stack.top.children.append(text)
        if match is None:
            break
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            _close(stack, tag)
            continue
        _make_room(stack, tag)
        node = Node(tag, match[3])
        stack.top.children.append(node)
        if tag in VOID or (match[3].endswith("/") and tag not in BLOCKS and tag not in RAW_TEXT):
            continue
        if tag in RAW_TEXT:
            closing = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
            stop = closing.start() if closing else end
            text = page[at:stop]
            node.children.append(unescape(text) if tag in ("textarea", "title") else text)
            at = stop
            if closing:
                bracket = page.find(">", stop)
                at = bracket + 1 if bracket >= 0 else end
            continue
        stack.push(node)
    return root


class _Stack:
    """The open elements, and how many of each tag, so that nothing absent is searched for."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.open: Counter = Counter()
        # Open elements by tag since each open block, the block itself left out.
        self.inner = [Counter()]

    @property
    def top(self) -> Node:
        return self.nodes[-1]

    def push(self, node: Node) -> None:
        self.nodes.append(node)
        self.open[node.tag] += 1
        if node.tag in BARRIERS:
            self.inner.append(Counter())
        else:
            self.inner[-1][node.tag] += 1

    def cut(self, depth: int) -> None:
        for node in reversed(self.nodes[depth:]):
            self.open[node.tag] -= 1
            if node.tag in BARRIERS:
                self.inner.pop()
            else:
                self.inner[-1][node.tag] -= 1
        del self.nodes[depth:]


def _make_room(stack: _Stack, tag: str) -> None:
    """Ends what a start tag implies the end of, and opens what it implies the start of."""
    if stack.top.tag == "head" and tag not in IN_HEAD:
        stack.cut(len(stack.nodes) - 1)
    ends, scope = CLOSES.get(tag, ((), ()))
    wanted = sum(stack.open[t] for t in ends)
    depth = len(stack.nodes) - 1
    while wanted and depth:
        inside = stack.nodes[depth].tag
        if inside in ends:
            stack.cut(depth)
            wanted -= 1
        elif inside in scope:
            break
        depth -= 1
    if tag in ("td", "th") and stack.top.tag in ("table", "tbody", "thead", "tfoot"):
        row = Node("tr")
        stack.top.children.append(row)
        stack.push(row)


def _close(stack: _Stack, tag: str) -> None:
    """Ends the nearest open element of that tag, and all in it.

    Cells and tables keep to themselves, and the end of an inline element ends no block.
    """
    if tag not in BARRIERS and tag != "br" and not stack.inner[-1][tag]:
        return
    scope = {"table", "td", "th", "caption"} - {tag}
    if tag in ("table", "body", "html"):
        scope = set()
    elif tag in ("tr", "tbody", "thead", "tfoot"):
        scope = {"table"}
    for depth in range(len(stack.nodes) - 1, 0, -1) if stack.open[tag] else ():
        if stack.nodes[depth].tag == tag:
            stack.cut(depth)
            return
        if stack.nodes[depth].tag in scope:
            return
    if tag in ("p", "br"):
        stack.top.children.append(Node(tag))


class _Writer:
    """Lines of text; breaks become lines once more text follows."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space, self.gap = False, 0
        self.indent: list[str] = []
        self.marker = ""

    def text(self, text: str) -> None:
        words = _SPACES.sub(" ", text)
        if words == " " or not words:
            self.space = self.space or (words == " " and bool(self.line))
            return
        if (self.space or words[0] == " ") and self.line:
            self._put(" ")
        self._put(words.strip(" "))
        self.space = words[-1] == " "

    def preformatted(self, text: str) -> None:
        first, *more = text.replace("\r\n", "\n").split("\n")
        if first:
            self._put(first)
        for line in more:
            self._end_line()
            if line:
                self._put(line)

    def _put(self, text: str) -> None:
        if not self.line:
            if self.lines:
                self.lines.extend([""] * max(0, self.gap - 1))
            self.gap = 0
            indent = self.indent[: -1 if self.marker else None][-INDENTED:]
            self.line.append("".join(indent) + self.marker)
            self.marker = ""
        self.line.append(text)

    def _end_line(self) -> None:
        self.lines.append("".join(self.line).rstrip(" "))
        self.line, self.space = [], False

    def break_(self, gap: int) -> None:
        if self.line:
            self._end_line()
            self.gap = 0
        self.space, self.gap = False, max(self.gap, gap)

    def line_break(self) -> None:
        if self.line:
            self.break_(1)
        else:
            self.gap += 1

    def result(self) -> list[str]:
        if self.line:
            self._end_line()
        return self.lines


def _displayed(node: Node, found: dict[str, str], style: dict[str, str]) -> bool:
    """Whether there is any place for an element, by its tag, attributes and style."""
    if node.tag in HIDDEN or style.get("display") == "none":
        return False
    if "hidden" in found and found["hidden"].lower() != "until-found" and "display" not in style:
        return False
    return node.tag != "dialog" or "open" in found or "display" in style


def _label(found: dict[str, str]) -> str:
    """The text that an input shows."""
    kind = found.get("type", "").strip().lower()
    return "" if kind in TEXTLESS else found.get("value", LABELS.get(kind, ""))


def _number(text: str | None, otherwise: int) -> int:
    text = (text or "").strip()
    return int(text) if re.fullmatch("-?[0-9]{1,9}", text) else otherwise


# A cell: its text, and the columns and rows it spans.
Cell = tuple[str, int, int]


def _placed(rows: list[list[Cell]]) -> list[list[tuple[int, str, int]]]:
    """The cells of each row as (first column, text, columns), beside those of earlier rows."""
    held: dict[int, int] = {}  # rows that a column is still taken in
    placed = []
    for row in rows:
        own, column, taken = [], 0, {}
        for text, span, down in row:
            while column in held:
                column += 1
            own.append((column, text, span))
            if down > 1:
                taken.update(dict.fromkeys(range(column, min(column + span, HELD)), down - 1))
            column += span
        held = {c: n - 1 for c, n in held.items() if n > 1} | taken
        placed.append(own)
    return placed


def _aligned(rows: list[list[Cell]], width: int) -> list[str]:
    """Lines of a table with the columns under each other; rows without text are left out."""
    placed = [row for row in _placed(rows) if any(text for _, text, _ in row)]
    widths: list[int] = []
    for row in placed:
        for column, text, span in row:
            widths.extend([0] * (column + 1 - len(widths)))
            if span == 1:
                widths[column] = min(width, max(widths[column], len(text)))
    lines = []
    for row in placed:
        after, cells = 0, []
        for column, text, span in row:
            cells += [" " * w for w in widths[after:column]]
            own = widths[column : column + span]
            cells.append(text.ljust(sum(own) + 3 * (len(own) - 1)))
            after = column + span
        lines.append(" | ".join(cells).rstrip(" "))
    return lines


def render(page: str, cell_width: int = CELL_WIDTH) -> str:
    """The visible text of a page."""
    writer = _Writer()
    outer: list[_Writer] = []  # of the cells that are open
    tables: list[list[list[Cell]]] = []
    lists: list[tuple[int, int] | None] = []  # the next item's number, and the step; None for bullets
    visible = [True]  # of the elements that are open
    preformatted = 0
    # Each node comes twice: to open it and, as (node,), to close it.
    waiting: list = [tree(page)]
    while waiting:
        item = waiting.pop()
        if isinstance(item, str):
            if not visible[-1]:
                continue
            if preformatted:
                writer.preformatted(item)
            else:
                writer.text(item)
            continue
        closing = isinstance(item, tuple)
        node = item[0] if closing else item
        tag = node.tag
        if not closing:
            found = attributes(node.attributes) if node.attributes else {}
            style = declarations(found["style"]) if "style" in found else {}
            if not _displayed(node, found, style):
                continue
            if tag == "br":
                writer.line_break()
                continue
            seen = style.get("visibility", "inherit")
            visible.append(visible[-1] if seen in ("inherit", "unset") else seen not in ("hidden", "collapse"))
            if tag == "input" and visible[-1]:
                writer.text(_label(found))
            if tag in BLOCKS:
                nested = lists and tag in ("ul", "ol")
                writer.break_(2 if tag in SPACED and not nested else 1)
            if tag == "ol":
                step = -1 if "reversed" in found else 1
                items = sum(isinstance(child, Node) and child.tag == "li" for child in node.children)
                lists.append((_number(found.get("start"), 1 if step > 0 else items), step))
            elif tag in ("ul", "menu"):
                lists.append(None)
            elif tag == "li":
                if lists and lists[-1] is not None:
                    number, step = lists[-1]
                    number = _number(found.get("value"), number)
                    lists[-1] = number + step, step
                    writer.marker = f"{number}. "
                else:
                    writer.marker = "- "
                writer.indent.append(" " * len(writer.marker))
                if not visible[-1]:
                    writer.marker = writer.indent[-1]
            elif tag in ("dd", "blockquote"):
                writer.indent.append("  ")
            elif tag in ("pre", "textarea"):
                preformatted += 1
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th") and tables:
                outer.append(writer)
                writer = _Writer()
            elif tag in ("td", "th"):
                writer.text(" ")
            waiting.append((node,))
            waiting.extend(reversed(node.children))
            continue
        visible.pop()
        if tag in ("ul", "ol", "menu"):
            lists.pop()
        elif tag == "li":
            writer.indent.pop()
            writer.marker = ""
        elif tag in ("dd", "blockquote"):
            writer.indent.pop()
        elif tag in ("pre", "textarea"):
            preformatted -= 1
        elif tag in ("td", "th") and tables:
            text = " ".join(line.strip() for line in writer.result() if line.strip())
            writer = outer.pop()
            found = attributes(node.attributes)
            # The standard's limits of spans; none down is to the end of the table.
            span = min(1000, max(1, _number(found.get("colspan"), 1)))
            down = min(65534, _number(found.get("rowspan"), 1)) or 65534
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1].append((text, span, down))
        elif tag == "table":
            for line in _aligned(tables.pop(), cell_width):
                writer.break_(1)
                writer.preformatted(line)
        if tag in BLOCKS:
            nested = lists and tag in ("ul", "ol")
            writer.break_(2 if tag in SPACED and not nested else 1)
    return "\n".join(writer.result()).replace("\xa0", " ").strip("\n")


def extract(pages: DataFrame, html_column: str = "html", text_name: str = "text", cell_width: int = CELL_WIDTH) -> DataFrame:
    """All columns of the pages but the markup, and the rendered text."""
    kept = [c for c in pages.columns if c not in (html_column, text_name)]
    rows = pages.select(*kept, html_column)
    schema = rows.select(*kept).schema.add(text_name, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, html_column)):
            texts = [render(page, cell_width) for page in text_column(part, html_column).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(texts, pa.string())], names=[*kept, text_name]
            )

    return rows.mapInArrow(run, schema)
