"""HTML to text by layout: a tree builder with implied tags, visibility rules, and a renderer for blocks, lists and tables.

Tree: start tags close what they imply closed (a block closes an open <p>, <li> closes <li>, a cell closes a cell and so
on, never across the element that bounds them), end tags close up to their own element if it is open within that bound,
void elements hold nothing, and the contents of script, style and their like are raw.

Visibility: head, script, style, template, noscript and other elements without a box, ``hidden``, ``type=hidden`` inputs
and ``display:none`` hide a subtree; ``visibility:hidden`` hides text until a descendant says visible. Both count in inline
styles and, below these, in style sheets of the page whose selectors are an element, a class, an id or several of them on
one element; rules within @media and the like are left aside. Of a select the chosen options show, else its first.

Rendering: white space collapses but for pre and textarea; blocks start a line, those with margins leave a blank line;
list items get a bullet or their number, two more columns for each nested list, up to DEEPEST columns, where all further
ones stand; tables become rows whose cells stand in columns of equal width, with colspan, rowspan and nested blocks kept.
Tables more than TABLES_DEEP in one another are read as blocks, a cell below the other. A table is written without
alignment (rows of one line a cell joined by bars, other rows a cell below the other) where its spans take more than
SPANS_HELD places for each cell, or where the blanks that align all tables of a page up to it come to more than PADDING
times the page and a MiB.

Null or empty html renders as empty text; an empty table of pages gives an empty one. Broken markup never raises: a tag
that never ends makes what is left of the page text. Repeated rows give repeated results; only the id and html columns
are read, so that others can't clash. The scan and the walk are iterative; time and text grow in proportion to the page (with
the bounds above as factors), whatever its depth.
"""

from __future__ import annotations

import bisect
import collections
import html as entities
import itertools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

TAG_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
#: What a tag holds up to its end; possessive, so that it is read once. A quote without a partner is a character.
TAG_REST = re.compile(r"((?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+)>")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BOXLESS = frozenset("head title script style template noscript iframe object audio video canvas svg math datalist noembed noframes param source track area base link meta col colgroup".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir table pre blockquote figure fieldset hr xmp".split())
BLOCK = SPACED | frozenset("html body address article aside caption center dd details dialog div dt fieldset figcaption footer form header hgroup legend li main nav search section summary tbody td tfoot th thead tr".split())
CLOSES_P = (BLOCK - frozenset("html body td th tr tbody thead tfoot caption legend".split())) | {"hr"}
TABLE_BOUND, CELL_BOUND = frozenset(("table", "html")), frozenset(("table", "html", "template"))
#: start tag: (open elements that it closes, elements that stop the search)
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "td", "th", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "td", "th", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "td", "th", "table"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
    "th": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
SCOPE = frozenset(("table", "td", "th", "caption", "html", "template", "button", "object"))
DEEPEST, TABLES_DEEP, SPANS_HELD, PADDING = 80, 8, 64, 16
SCHEMA = "page_id long, text string, n_lines long, n_words long"
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.children = tag, attrs, []

    def attributes(self) -> dict[str, str]:
        out: dict[str, str] = {}
        for m in ATTRIBUTE.finditer(self.attrs):
            out.setdefault(m[1].lower(), entities.unescape(next((x for x in m.groups()[1:] if x is not None), "")))
        return out


class _Open:
    """The open elements, with the places of each tag among them, so that no search walks the stack."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = collections.defaultdict(list)

    def push(self, node: Node) -> None:
        self.places[node.tag].append(len(self.nodes))
        self.nodes.append(node)

    def pop(self) -> None:
        self.places[self.nodes.pop().tag].pop()

    def nearest(self, tags: Iterable[str]) -> int:
        """The place of the innermost element with one of the tags; 0 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close(self, tags: Iterable[str], bound: Iterable[str]) -> None:
        """Close up to the innermost element with one of the tags, unless one that bounds the search is further in."""
        at = self.nearest(tags)
        if at and at >= self.nearest(bound):
            while len(self.nodes) > at:
                self.pop()


def _raw_end(source: str, tag: str, at: int) -> tuple[int, int]:
    """Where the contents of a raw element end and where the page goes on."""
    found = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
    if not found:
        return len(source), len(source)
    end = source.find(">", found.end())
    return found.start(), end + 1 if end >= 0 else len(source)


def build_tree(source: str) -> Node:
    root = Node("#root")
    opened = _Open(root)

    def text(s: str) -> None:
        if s:
            top = opened.nodes[-1]
            if top.tag in ("table", "tbody", "thead", "tfoot", "tr") and not s.strip():
                return
            top.children.append(entities.unescape(s))

    def start(tag: str, attrs: str) -> None:
        if opened.nodes[-1].tag == "head" and tag not in ("title", "meta", "link", "base", "style", "script", "noscript", "template"):
            opened.pop()
        if tag in CLOSES_P:
            opened.close(("p",), SCOPE)
        if tag in IMPLIED:
            opened.close(*IMPLIED[tag])
        if tag == "tr" and opened.nodes[-1].tag == "table":
            start("tbody", "")
        elif tag in ("td", "th") and opened.nodes[-1].tag in ("table", "tbody", "thead", "tfoot"):
            start("tr", "")
        if tag in ("html", "body") and opened.nearest((tag,)):
            return
        node = Node(tag, attrs)
        opened.nodes[-1].children.append(node)
        if tag not in VOID:
            opened.push(node)

    def finish(tag: str) -> None:
        if tag == "br":
            start("br", "")
        elif tag == "p" and not opened.nearest(("p",)):
            start("p", "")
            opened.pop()
        elif tag not in ("html", "body"):
            within_table = tag in ("tr", "td", "th", "tbody", "thead", "tfoot", "caption", "table")
            opened.close((tag,), (TABLE_BOUND if within_table else SCOPE) - {tag})

    at, end = 0, len(source)
    begin = 0  # of the text that is not yet in the tree
    while (at := source.find("<", at)) >= 0:
        named = TAG_NAME.match(source, at)
        if named:
            rest = TAG_REST.match(source, named.end())
            if rest is None:
                break
            after = rest.end()
        elif source.startswith("<!--", at):
            after = found + 3 if (found := source.find("-->", at + 4)) >= 0 else end
        elif source.startswith(("<!", "<?", "</"), at):
            after = found + 1 if (found := source.find(">", at)) >= 0 else end
        else:
            at += 1
            continue
        text(source[begin:at])
        at = begin = after
        if not named:
            continue
        tag = named[1].lower()
        if source[named.start() + 1] == "/":
            finish(tag)
            continue
        start(tag, rest[1])
        if tag in RAW and opened.nodes[-1].tag == tag:
            stop, begin = _raw_end(source, tag, at)
            if stop > at:
                body = source[at:stop]
                opened.nodes[-1].children.append(entities.unescape(body) if tag in ("textarea", "title") else body)
            opened.pop()
            at = begin
    text(source[begin:])
    return root


class Styles:
    """What the style sheets of a page say of boxes and visibility, for selectors of one element each."""

    RULE = re.compile(r"([a-z][\w-]*|\*)?((?:[.#][\w-]+)*)")

    def __init__(self) -> None:
        #: element, id or class -> selectors that name it: (element or None, classes and ids) -> [no box, (rule, visible)]
        self.rules: dict[str, dict[tuple, list]] = collections.defaultdict(dict)
        self.known: dict[tuple, list] = {}
        self.count = 0

    def read(self, sheet: str) -> None:
        sheet = re.sub(r"/\*.*?(?:\*/|\Z)", " ", sheet.lower(), flags=re.S)
        depth, begin, selectors = 0, 0, ""
        for m in re.finditer(r"[{}]", sheet):
            if m[0] == "{":
                if depth == 0:
                    selectors, begin = sheet[begin : m.start()].strip(), m.end()
                depth += 1
            elif depth:
                depth -= 1
                if depth == 0:
                    if not selectors.startswith("@"):
                        self.add(selectors, sheet[begin : m.start()])
                    begin = m.end()

    def add(self, selectors: str, declarations: str) -> None:
        gone, says = declared(declarations)
        if not gone and says is None:
            return
        for selector in selectors.split(","):
            m = self.RULE.fullmatch(selector.strip())
            if m and m[0]:
                parts = re.findall(r"[.#][\w-]+", m[2])
                tag = None if m[1] in (None, "*") else m[1]
                key = (tag, frozenset(parts))
                if key not in self.known:  # filed under the part that the fewest others are filed under
                    name = min(parts, key=lambda x: len(self.rules.get(x, ()))) if parts else tag or "*"
                    self.known[key] = self.rules[name][key] = [False, (0, None)]
                self.count += 1
                self.known[key][0] |= gone
                if says is not None:
                    self.known[key][1] = (self.count, says)

    def of(self, tag: str, attrs: dict[str, str]) -> tuple[bool, bool | None]:
        if not self.rules:
            return False, None
        own = {f".{x}" for x in attrs.get("class", "").lower().split()} | ({f"#{attrs['id'].lower()}"} if attrs.get("id") else set())
        gone, last = False, (0, None)
        for name in {"*", tag} | own:
            for (element, parts), (no_box, visible) in self.rules.get(name, {}).items():
                if (element is None or element == tag) and parts <= own:
                    gone |= no_box
                    last = max(last, visible, key=lambda x: x[0])
        return gone, last[1]  # of rules that differ on visibility the last holds


def declared(style: str) -> tuple[bool, bool | None]:
    """Whether declarations take away the box, and what they say of visibility."""
    style = re.sub(r"\s+", "", style.lower())
    seen = re.findall(r"(?:^|;)visibility:(\w+)", style)
    return bool(re.search(r"(?:^|;)display:none(?:;|!|$)", style)), None if not seen else seen[-1] == "visible"


class Page:
    """Lines of one flow: the page itself or a table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.blank = False
        self.margin = False
        self.indent = 0
        self.marker = ""

    def inline(self, s: str) -> None:
        s = _BLANKS.sub(" ", s)
        if s[:1] == " " and (not self.parts or self.parts[-1].endswith(" ")):
            s = s[1:]
        if s:
            self.parts.append(s)

    def end_line(self) -> None:
        line = "".join(self.parts).rstrip(" ")
        self.parts = []
        if line:
            self.put(line)

    def put(self, line: str) -> None:
        if self.margin and self.lines and self.lines[-1]:
            self.lines.append("")
        self.margin = False
        self.lines.append(" " * (min(self.indent, DEEPEST) - len(self.marker)) + self.marker + line)
        self.marker = ""

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.margin |= spaced

    def verbatim(self, s: str) -> None:
        first, *rest = s.replace("\r\n", "\n").split("\n")
        self.parts.append(first)
        for x in rest:
            line = "".join(self.parts).rstrip()
            self.parts = [x]
            if line or self.lines:
                self.put(line)

    def done(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def hidden(node: Node, styles: Styles) -> tuple[bool, bool | None]:
    """Whether the subtree has no box, and what it says of the visibility of text (None: nothing)."""
    if node.tag in BOXLESS:
        return True, None
    if not node.attrs and not styles.rules:
        return False, None
    low = node.attrs.lower()
    if "hidden" not in low and "style" not in low and not styles.rules:
        return False, None
    attrs = node.attributes()
    gone, says = styles.of(node.tag, attrs)
    own_gone, own_says = declared(attrs.get("style", ""))
    if re.search(r"(?:^|;)\s*display\s*:", attrs.get("style", "").lower()):
        gone = own_gone
    gone |= "hidden" in attrs or attrs.get("type", "").lower() == "hidden"
    return gone, says if own_says is None else own_says


def chosen(select: Node) -> list[Node]:
    """The options of a select that show: those that are selected, else the first."""
    options, todo = [], list(reversed(select.children))
    while todo:
        node = todo.pop()
        if isinstance(node, Node):
            if node.tag == "option":
                options.append(node)
            else:
                todo += reversed(node.children)
    return [x for x in options if "selected" in x.attrs.lower() and "selected" in x.attributes()] or options[:1]


def placed(rows: list[list[tuple[int, int, list[str]]]]) -> list[list[tuple[int, int, list[str]]]] | None:
    """Rows of (colspan, rowspan, lines) as rows of (first column, column behind, lines), columns without an edge left out.

    None if spans reach so far down that more than SPANS_HELD of them are held for each cell.
    """
    out, busy = [], []  # busy: (first column, column behind, row behind) of cells from rows above
    left = SPANS_HELD * (1000 + sum(map(len, rows)))
    for r, row in enumerate(rows):
        busy = sorted(x for x in busy if x[2] > r)
        left -= len(busy)
        if left < 0:
            return None
        cells, at, i, below = [], 0, 0, []
        for columns, deep, lines in row:
            while i < len(busy) and busy[i][0] <= at:
                at = max(at, busy[i][1])
                i += 1
            cells.append((at, at + columns, lines))
            if deep != 1:
                below.append((at, at + columns, r + deep if deep else len(rows)))
            at += columns
        busy += below
        out.append(cells)
    edges = {x: k for k, x in enumerate(sorted({edge for row in out for a, b, _ in row for edge in (a, b)}))}
    return [[(edges[a], edges[b], lines) for a, b, lines in row] for row in out]


def unaligned(rows: list[list[tuple[int, int, list[str]]]]) -> list[str]:
    out = []
    for row in rows:
        texts = [[x for x in lines if x.strip()] for *_, lines in row]
        out += [" | ".join(x[0].strip() for x in texts if x)] if max(map(len, texts), default=0) <= 1 else itertools.chain(*texts)
    return [x for x in out if x]


def lines_of(row: list[tuple[int, int, list[str]]]) -> Iterator[list[tuple[int, str]]]:
    """(first column, text) of the cells of a row that say something, line for line."""
    at = 0
    while row:
        yield [(a, lines[at]) for a, _, lines in row if lines[at].strip()]
        at += 1
        row = [x for x in row if len(x[2]) > at]


def lay_out(rows: list[list[tuple[int, int, list[str]]]], room: list[int]) -> list[str]:
    """Rows of (colspan, rowspan, lines) cells as lines whose columns have equal widths; takes what they need off ``room``."""
    grid = placed(rows)
    if grid is None:
        return unaligned(rows)
    width = [0] * max([0, *(b for row in grid for _, b, _ in row)])
    have = lambda a, b: sum(width[a:b]) + 3 * (b - a - 1)
    for row in grid:
        for a, b, lines in row:
            if b - a == 1:
                width[a] = max([width[a], *map(len, lines)])
    for row in grid:
        for a, b, lines in row:
            if b - a > 1:
                width[b - 1] += max(0, max([0, *map(len, lines)]) - have(a, b))
    left = [0, *itertools.accumulate(w + 3 for w in width)]  # where each column begins
    rest = [[x for x in row if x[2]] for row in grid]
    need = sum(left[shown[-1][0]] for row in rest for shown in lines_of(row) if shown)
    if need > room[0]:
        return unaligned(rows)
    room[0] -= need
    out = []
    for row, full in zip(rest, grid):
        starts = sorted({a for a, *_ in full if a})
        for shown in lines_of(row):
            if not shown:
                continue
            line, texts, last = [], dict(shown), shown[-1][0]
            at = 0
            for a in [0, *starts[: bisect.bisect_right(starts, last)]]:
                if a:
                    line.append(" " * (left[a] - 3 - at) + " | ")
                    at = left[a]
                line.append(texts.get(a, ""))
                at += len(texts.get(a, ""))
            out.append("".join(line).rstrip(" "))
    return out


def render(source: str | None) -> str:
    root = build_tree(source or "")
    page, styles = Page(), Styles()
    pages, tables, lists = [page], [], []
    room = [PADDING * len(source or "") + (1 << 20)]
    todo: list[tuple] = [("in", root, True, False)]
    while todo:
        step, node, shown, pre = todo.pop()
        page = pages[-1]
        if isinstance(node, str):
            if shown:
                page.verbatim(node) if pre else page.inline(node)
            continue
        tag = node.tag
        if step == "in":
            if tag == "style":
                styles.read("".join(x for x in node.children if isinstance(x, str)))
            if tag == "head":
                todo += [("in", x, False, False) for x in reversed(node.children) if isinstance(x, Node) and x.tag == "style"]
            gone, says = hidden(node, styles) if tag != "#root" else (False, None)
            if gone:
                continue
            shown = shown if says is None else says
            if tag == "br":
                page.put("".join(page.parts).rstrip(" ")) if page.parts else page.end_line()
                page.parts = []
                continue
            if tag == "hr":
                page.block(True)
                continue
            if tag == "img":
                if shown and (alt := node.attributes().get("alt", "").strip()):
                    page.inline(alt)
                continue
            if tag in ("td", "th") and 0 < len(tables) <= TABLES_DEEP:
                pages.append(Page())
            elif tag == "table":
                page.block(True)
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag == "li":
                page.block(False)
                marker = "- "
                if lists and lists[-1] is not None:
                    marker = f"{lists[-1]}. "
                    lists[-1] += 1
                page.indent += len(marker)
                page.marker = marker
                todo.append(("unindent", node, len(marker), False))
            elif tag in BLOCK:
                page.block(tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and lists))
                if tag in ("ul", "menu", "dir"):
                    lists.append(None)
                elif tag == "ol":
                    begin = node.attributes().get("start", "1") if node.attrs else "1"
                    lists.append(int(begin) if re.fullmatch(r"-?\d{1,9}", begin) else 1)
                elif tag in ("blockquote", "dd"):
                    page.indent += 2
            todo.append(("out", node, shown, pre))
            inner = pre or tag in ("pre", "textarea", "xmp")
            todo += [("in", x, shown, inner) for x in reversed(chosen(node) if tag == "select" else node.children)]
        elif step == "unindent":
            page.end_line()
            page.indent, page.marker = page.indent - shown, ""
        elif tag in ("td", "th") and 0 < len(tables) <= TABLES_DEEP:
            lines = pages.pop().done()
            if not tables[-1]:
                tables[-1].append([])
            attrs = node.attributes() if node.attrs else {}
            number = lambda name, least, most: min(most, max(least, int(x))) if re.fullmatch(r"\d{1,9}", x := attrs.get(name, "1").strip()) else 1
            tables[-1][-1].append((number("colspan", 1, 1000), number("rowspan", 0, 65534), lines))
        elif tag == "table":
            page.block(True)
            for line in lay_out(tables.pop(), room):
                page.put(line)
            page.margin = True
        elif tag in BLOCK and tag not in ("tr", "li"):
            page.block(tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and len(lists) > 1))
            if tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
            elif tag in ("blockquote", "dd"):
                page.indent -= 2
        elif tag == "li":
            page.end_line()
    return "\n".join(pages[0].done())


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [render(x) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([x.count("\n") + 1 if x else 0 for x in texts], pa.int64()), pa.array([len(x.split()) for x in texts], pa.int64())], ["page_id", "text", "n_lines", "n_words"])


def render_pages(pages: DataFrame) -> DataFrame:
    """A row for each page with its visible text."""
    return pages.selectExpr("cast(page_id as long) page_id", "cast(html as string) html").mapInArrow(_rows, SCHEMA)
