"""Visible text of HTML pages, laid out as a reader sees it.

A page becomes a tree (implied end tags, void and raw-text elements), invisible parts are
marked (scripts, styles, head, templates, comments, an attribute named ``hidden``, and the
style attribute's ``display:none`` and ``visibility:hidden``), and the
rest is written as text: paragraphs and headings with a blank line around, other blocks on
lines of their own, list items with markers and indentation, table cells in columns,
formulas in a line, the text elements of drawings and the shown options of selections. All
visible text is kept, navigation included. Walking uses stacks, so nesting may be deep.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_batches

# --- fixed values: element names of the HTML standard by their role ---
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = set("head script style template noscript iframe noembed noframes datalist title object audio video canvas".split())
SVG_UNSEEN = set("defs symbol desc metadata clippath mask pattern marker lineargradient radialgradient".split())
MATH_UNSEEN = set("annotation annotation-xml mphantom".split())
#: Signs between the parts of a formula that are not written one after the other.
MATH_SIGNS = {"mfrac": "/", "msup": "^", "mover": "^", "msub": "_", "munder": "_", "msubsup": "_^", "munderover": "_^"}
#: Opening tags that end a drawing or formula, outside of the elements that may hold them.
BREAKOUT = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu meta nobr ol p "
    "pre ruby s small span strong strike sub sup table tt u ul var".split()
)
FOREIGN_HOLDS = "foreignobject desc title mi mo mn ms mtext annotation-xml".split()
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr fieldset".split())
BLOCK = SPACED | set(
    "html body div section article aside header footer nav main address details summary dialog form figcaption "
    "li dt dd tr caption legend center search menu td th thead tbody tfoot hgroup".split()
)
#: An opening tag ends these open elements, up to the nearest of the elements that hold them.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"}, "td": {"td", "th"}, "th": {"td", "th"},
        "tr": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "thead": {"tr", "td", "th", "tbody"},
        "tfoot": {"tr", "td", "th", "tbody"}, "body": {"head"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select", "datalist"}, "optgroup": {"select"}, "body": {"html"}}
HELD_BY_TABLE = {"table"}
SCOPE = set("td th caption table button object li dd".split())  # an open p is looked for up to these
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<|[^<]+",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']\S*)))?")
DECLARATION = re.compile(r"""(?:[^;"'(]|"[^"]*"|'[^']*'|\([^)]*\)|["'(])+""")
CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
START = re.compile(r"\s*(-?\d{1,9})")
SPACE = re.compile(r"[ \t\r\n\f]+")
#: Cells wider than this are not padded, and tables nested deeper are written as blocks.
WIDEST, DEEPEST = 40, 8


def attributes_of(raw: str) -> dict[str, str]:
    """Values of a tag's attributes by lower-case name, the first of a name; references resolved."""
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), unescape("".join(values)))
    return found


def declared(style: str) -> dict[str, str]:
    """The style's display and visibility in lower case; the last counts, important ones first."""
    low, found, fixed = style.lower(), {}, set()
    if "display" in low or "visibility" in low:
        for one in DECLARATION.findall(CSS_COMMENT.sub("", low)):
            name, _, value = (x.strip() for x in one.partition(":"))
            value, important, _ = (x.strip() for x in value.partition("!"))
            if name in ("display", "visibility") and value and (important or name not in fixed):
                found[name] = value
                fixed |= {name} if important else set()
    return found


class Node:
    """An element. ``unseen`` hides it with all it holds, ``veiled`` its text until made visible."""

    __slots__ = ("tag", "attributes", "children", "unseen", "veiled")

    def __init__(self, tag: str, attributes: str = "", veiled: bool = False, drawn: bool = False):
        self.tag, self.children, self.veiled = tag, [], veiled
        self.attributes = attributes_of(attributes) if attributes and not attributes.isspace() else {}
        self.unseen = tag in UNSEEN or tag in MATH_UNSEEN or "hidden" in self.attributes
        if drawn:
            self.unseen = self.unseen or tag in SVG_UNSEEN
        if "style" in self.attributes or drawn:
            given = {k: self.attributes[k].strip().lower() for k in ("display", "visibility") if drawn and k in self.attributes}
            given |= declared(self.attributes.get("style", ""))
            self.unseen = self.unseen or given.get("display") == "none"
            if given.get("visibility") in ("hidden", "collapse", "visible"):
                self.veiled = given["visibility"] != "visible"
        self.unseen = self.unseen or (self.veiled and tag in VOID)


def tree(html: str) -> Node:
    """The page's elements; text nodes are strings, with references resolved."""
    root = Node("#page")
    stack = [root]
    names: dict[str, int] = {}  # how many of each name are open
    skip_to = 0

    def close(count: int) -> None:
        for node in stack[count:]:
            names[node.tag] -= 1
        del stack[count:]

    def end(tags: set[str], within: set[str]) -> None:
        """Close the outermost of ``tags`` that is open inside the nearest of ``within``."""
        if not any(names.get(t) for t in tags):
            return
        cut = None
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                cut = k
            elif stack[k].tag in within:
                break
        if cut:
            close(cut)

    def within(tags) -> bool:
        return any(names.get(x) for x in tags)

    for token in TOKEN.finditer(html):
        if token.start() < skip_to:
            continue
        name = token[2]
        if name is None:
            if stack[-1].veiled or (names.get("svg") and not within(("text", "foreignobject"))):
                continue  # not drawn
            text = token[0]
            if text.startswith("<![CDATA["):
                stack[-1].children.append(text[9:].removesuffix("]]>"))
            elif text == "<" or text[0] != "<":
                stack[-1].children.append(unescape(text) if "&" in text else text)
            continue
        name = name.lower()
        if token[1]:
            if name == "p" and not names.get("p"):
                stack[-1].children.append(Node("p"))
            elif name == "br":
                stack[-1].children.append(Node("br"))
            elif names.get(name):
                end({name}, {"table"} if name not in ("table", "html", "body") else set())
            continue
        foreign = (names.get("svg") or names.get("math")) and not within(FOREIGN_HOLDS)
        if foreign and name in BREAKOUT:
            close(next(k for k, x in enumerate(stack) if x.tag in ("svg", "math")))
            foreign = False
        if name in BLOCK and names.get("p"):
            end({"p"}, SCOPE)
        if name in ENDS:
            end(ENDS[name], HOLDS.get(name, HELD_BY_TABLE))
        node = Node(name, token[3], stack[-1].veiled, name == "svg" or bool(names.get("svg")))
        stack[-1].children.append(node)
        if name in VOID or (token[3] and token[3].endswith("/") and (foreign or name in ("svg", "math", "path", "use"))):
            continue
        if name in RAW:
            finish = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(html, token.end())
            body = html[token.end() : finish.start() if finish else len(html)]
            if name in ("textarea", "title"):
                body = unescape(body)
            if not node.veiled:
                node.children.append(body)
            skip_to = finish.end() if finish else len(html)
            continue
        stack.append(node)
        names[name] = names.get(name, 0) + 1
    return root


class Page:
    """Lines of text under construction."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []  # of the current line
        self.open_space = False
        self.gap = 0  # blank lines due before the next line
        self.indent = ""
        self.marker = ""

    def text(self, text: str, keep: bool) -> None:
        if keep:
            first, *rest = text.replace("\r\n", "\n").split("\n")
            self.word(first)
            for line in rest:
                self.line(force=True)
                self.word(line)
            return
        words = SPACE.sub(" ", text)
        if words.startswith(" "):
            self.open_space = True
        inner = words.strip(" ")
        if inner:
            self.word((" " if self.open_space and self.parts else "") + inner)
            self.open_space = words.endswith(" ")

    def word(self, text: str) -> None:
        if text:
            self.parts.append(text)

    def line(self, force: bool = False) -> None:
        """End the current line, if there is one."""
        if self.parts or force:
            if self.lines and self.gap:
                self.lines.append("")
            lead = self.indent
            if self.marker:
                lead = lead[: -len(self.marker)] + self.marker if len(lead) >= len(self.marker) else self.marker
                self.marker = ""
            self.lines.append((lead + "".join(self.parts)).rstrip())
            self.gap = 0
        self.parts, self.open_space = [], False

    def block(self, spaced: bool) -> None:
        self.line()
        if spaced:
            self.gap = 1

    def rows(self, lines: list[str]) -> None:
        for text in lines:
            self.parts = [text]
            self.line()


def columns(rows: list[list[list[str]]]) -> list[str]:
    """Rows of cells (each a list of lines) with the cells of a column under each other."""
    count = max((len(row) for row in rows), default=0)
    width = [0] * count
    for row in rows:
        for k, cell in enumerate(row):
            width[k] = max([width[k], *(len(x) for x in cell if len(x) <= WIDEST)])
    out = []
    for row in rows:
        for depth in range(max((len(cell) for cell in row), default=0)):
            line = [(cell[depth] if depth < len(cell) else "").ljust(width[k]) for k, cell in enumerate(row)]
            out.append("  ".join(line).rstrip())
    return out


def table_parts(table: Node) -> tuple[list[Node], list[list[Node]]]:
    """What stands in a table outside cells, and its rows of cells."""
    other, rows, stack = [], [], list(reversed(table.children))
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            if node.strip():
                loose = Node("span")
                loose.children.append(node)
                other.append(loose)
        elif node.unseen:
            continue
        elif node.tag in ("tbody", "thead", "tfoot", "colgroup"):
            stack += reversed(node.children)
        elif node.tag == "tr":
            cells = []
            for x in node.children:
                if not isinstance(x, str) and x.tag in ("td", "th"):
                    cells += [] if x.unseen else [x]
                elif not isinstance(x, str) or x.strip():
                    loose = Node("td")
                    loose.children.append(x)
                    cells.append(loose)
            rows.append(cells)
        elif node.tag in ("td", "th"):
            rows.append([node])
        else:
            other.append(node)
    return other, rows


def formula(node: Node) -> list[Node | str]:
    """The parts of a formula's element with the signs that its layout stands for."""
    parts: list = [x for x in node.children if not isinstance(x, str) and not x.unseen]
    out = ["√"] if node.tag == "msqrt" else []
    signs = MATH_SIGNS.get(node.tag, "")
    group = len(parts) > 1 if node.tag == "msqrt" else False
    out += ["("] if group else []
    for k, x in enumerate(parts):
        out += [signs[min(k, len(signs)) - 1]] if k and signs else []
        wide = signs and x.tag in ("mrow", *MATH_SIGNS) and len(x.children) > 1
        out += ["(", x, ")"] if wide else [x]
    return out + ([")"] if group else [])


def shown_options(select: Node) -> list[Node | str]:
    """The options a reader sees: all of a list, else the selected one or the first that can be."""
    several = "multiple" in select.attributes or re.match(r"\s*0*([2-9]|1\d)", select.attributes.get("size", ""))
    found, stack = [], [(x, False) for x in reversed(select.children)]
    while stack:
        node, off = stack.pop()
        if isinstance(node, str) or node.unseen:
            continue
        off = off or "disabled" in node.attributes
        if node.tag == "option":
            found.append((node, off))
            continue
        if node.tag == "optgroup" and several and not node.veiled:
            found.append((node.attributes.get("label", ""), off))
        stack += [(x, off) for x in reversed(node.children)]
    if not several:
        chosen = [x for x in found if "selected" in x[0].attributes][-1:]
        found = chosen or [x for x in found if not x[1]][:1]
    label = lambda x: x if isinstance(x, str) or not x.attributes.get("label") or x.veiled else x.attributes["label"]
    return [y for x, _ in found for y in (" ", label(x), " ")]


def write(top: Node, depth: int = 0) -> list[str]:
    """The visible lines of an element."""
    page = Page()
    keep = 0  # open pre elements
    counters: list[int | None] = []
    todo: list[tuple] = [("open", top)]
    while todo:
        action, node, *more = todo.pop()
        if action == "close":
            tag = node.tag
            if tag in BLOCK:
                page.block(tag in SPACED and not (tag in ("ul", "ol") and counters[:-1]))
            if tag == "pre":
                keep -= 1
            if tag == "text":
                page.open_space = True
            if tag in ("ul", "ol", "menu"):
                counters.pop()
            if more:
                page.indent, page.marker = more[0], ""
            continue
        if isinstance(node, str):
            page.text(node, bool(keep))
            continue
        if node.unseen:
            continue
        tag = node.tag
        if tag == "br":
            page.line(force=True)
            continue
        if tag == "table" and depth < DEEPEST:
            page.block(True)
            other, rows = table_parts(node)
            for x in other:
                page.rows(write(x, depth + 1))
            page.rows(columns([[write(cell, depth + 1) for cell in row] for row in rows]))
            page.block(True)
            continue
        before = None
        if tag in BLOCK:
            page.block(tag in SPACED and not (tag in ("ul", "ol") and counters))
        if tag == "hr":
            page.word("---")
            page.block(True)
            continue
        if tag in ("td", "th", "text"):
            page.open_space = True
        if tag in ("ul", "ol", "menu"):
            start = START.match(node.attributes.get("start", "")) if tag == "ol" else None
            counters.append((int(start[1]) if start else 1) if tag == "ol" else None)
        elif tag == "li":
            number = counters[-1] if counters else None
            marker = "- " if number is None else f"{number}. "
            if number is not None:
                counters[-1] = number + 1
            before = page.indent
            page.indent += " " * len(marker)
            page.marker = marker
        elif tag in ("blockquote", "dd"):
            before = page.indent
            page.indent += "  "
        elif tag == "pre":
            keep += 1
        todo.append(("close", node) if before is None else ("close", node, before))
        inner = node.children
        if tag in MATH_SIGNS or tag == "msqrt":
            inner = [] if node.veiled else formula(node)
        elif tag == "select":
            inner = shown_options(node)
        todo += [("open", child) for child in reversed(inner)]
    page.line()
    while page.lines and not page.lines[-1]:
        page.lines.pop()
    return page.lines


def page_text(html: str | None) -> str:
    """The text of a page; empty for null, empty and wholly invisible pages."""
    return "\n".join(write(tree(html))) if html else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_lines: one row per row of ``pages``; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [page_text(x) for x in batch.column("html").to_pylist()]
            lines = [x.count("\n") + bool(x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(lines, pa.int64())],
                ["page_id", "url", "text", "n_lines"],
            )

    slim = pages.select("page_id", "url", "html")
    kinds = [f"{c} {slim.schema[c].dataType.simpleString()}" for c in ("page_id", "url")]
    return arrow_batches(slim, run, ", ".join([*kinds, "text string", "n_lines bigint"]))
