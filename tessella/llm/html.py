"""Layout-aware text of web pages: a tree with implied tags, rendered as a browser would lay it out."""

from __future__ import annotations

import re
import unicodedata
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .registry import query, table

# Element classes of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead tr ul caption".split()
)
SPACED = set("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 ol p pre table ul".split())
HIDDEN = set("head script style template noscript object iframe canvas audio video datalist title".split())
#: Parts of drawings and formulas that are not drawn.
HIDDEN |= set("annotation annotation-xml clippath defs desc lineargradient marker mask metadata pattern radialgradient symbol".split())
#: Elements that stand on lines of their own without closing a paragraph.
LINES = BLOCK | {"select", "text", "textarea"}
CLOSES_P = BLOCK - set("body caption dd dt html legend li optgroup option tbody td tfoot th thead tr".split()) | {"dl"}
#: Opening the key closes an open element of the first set, up to one of the second.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"optgroup", "option"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}
FORMATS = set("a b big code em font i nobr s small span strike strong tt u".split())
_BLANKS = re.compile(r"[ \t\n\f\r]+")
_PROPERTY = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_SELECTOR = re.compile(r"\s*([a-z][a-z0-9-]*|\*)?([.#][\w-]+)?\s*", re.I)
#: Cells wider than this don't widen their column, so padding can't outgrow the text.
WIDEST = 400


# Elements whose content is text up to their own end tag.
RAW = set("script style textarea title xmp iframe noembed noframes".split())
#: Elements nest no deeper than this, as in browsers; what is deeper becomes a sibling.
DEPTH = 512
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)")
_EQUALS = re.compile(r"\s*=\s*")
_VALUE = re.compile(r"[^\s>]*")
_TAIL = re.compile(r"[\s/]*")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW}


def attributes(page: str, at: int) -> tuple[dict[str, str], int] | None:
    """The attributes from ``at`` on and the place after the tag; None if the page ends first."""
    found: dict[str, str] = {}
    while True:
        if at >= len(page):
            return None
        name = _ATTRIBUTE.match(page, at)
        if name is None:
            at = _TAIL.match(page, at).end()
            return (found, at + 1) if page.startswith(">", at) else None
        at, value = name.end(), ""
        if equals := _EQUALS.match(page, at):
            at = equals.end()
            if page[at : at + 1] in ('"', "'"):
                end = page.find(page[at], at + 1)
                if end < 0:
                    return None
                value, at = page[at + 1 : end], end + 1
            else:
                bare = _VALUE.match(page, at)
                value, at = bare[0], bare.end()
        found.setdefault(name[1].lower(), unescape(value))


class Node:
    __slots__ = ("attrs", "children", "depth", "gone", "items", "laid", "parent", "shown", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.items = 0
        self.depth = parent.depth + 1 if parent else 0
        self.gone, self.shown = False, True  # neither it nor what is in it has a place; its own text is seen
        self.laid: list[str] = []  # the lines of a table


class TreeBuilder:
    """A tree of a page; missing end tags are implied as browsers do."""

    def __init__(self) -> None:
        self.root = self.open = Node("#root", {}, None)

    def feed(self, page: str) -> None:
        """Read the page once from start to end; a tag or comment that never ends takes the rest."""
        at = 0
        while at < len(page):
            start = page.find("<", at)
            if start < 0:
                self.handle_data(unescape(page[at:]))
                return
            after = page[start + 1 : start + 2]
            name = _NAME.match(page, start + 2 if after == "/" else start + 1)
            if name is None and after not in ("!", "?", "/"):
                self.handle_data(unescape(page[at : start + 1]))
                at = start + 1
                continue
            if start > at:
                self.handle_data(unescape(page[at:start]))
            if name is None:  # a comment, a declaration or the like
                mark = "-->" if page.startswith("<!--", start) else ">"
                end = page.find(mark, start + (4 if mark == "-->" else 1))
                at = len(page) if end < 0 else end + len(mark)
                continue
            read = attributes(page, name.end())
            if read is None:
                return
            tag, (attrs, at) = name[0].lower(), read
            if after == "/":
                self.handle_endtag(tag)
                continue
            self.handle_starttag(tag, attrs)
            if tag in RAW:
                end = _RAW_END[tag].search(page, at)
                stop = end.start() if end else len(page)
                data = page[at:stop]
                self.handle_data(unescape(data) if tag in ("textarea", "title") else data)
                at = stop

    def close_up_to(self, tags: set[str], stops: set[str]) -> None:
        node, last = self.open, None
        while node.parent is not None and node.tag not in stops:
            if node.tag in tags:
                last = node
            node = node.parent
        if last is not None:
            self.open = last.parent

    def handle_starttag(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in ("html", "body") and self.holder(tag):
            return
        if tag in IMPLIED:
            self.close_up_to(*IMPLIED[tag])
        elif tag in BLOCK and self.holder("head") and tag != "html":
            self.close_up_to({"head"}, set())
        if tag in CLOSES_P:
            self.close_up_to({"p"}, {"table", "td", "th", "caption", "button", "li", "div", "section", "article"})
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6") and self.open.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.open = self.open.parent
        if tag in ("td", "th") and self.open.tag in ("table", "tbody", "thead", "tfoot"):
            self.handle_starttag("tr", {})
        if self.open.depth >= DEPTH:
            self.open = self.open.parent
        node = Node(tag, attrs, self.open)
        self.open.children.append(node)
        if tag not in VOID:
            self.open = node

    def holder(self, tag: str) -> Node | None:
        node = self.open
        while node is not None and node.tag != tag:
            node = node.parent
        return node

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", {})
            return
        if tag in ("body", "html"):
            return  # what follows still belongs to the body
        if tag == "p" and not self.holder("p"):
            self.handle_starttag("p", {})
        node = self.holder(tag)
        if node is None:
            return
        between, at = [], self.open
        while at is not node:
            between.append(at.tag)
            at = at.parent
        if tag in FORMATS and any(t in BLOCK for t in between):
            return  # an inline end tag doesn't close the blocks inside
        self.open = node.parent

    def handle_data(self, data: str) -> None:
        if self.open.tag == "head" and data.strip():
            self.close_up_to({"head"}, set())
        self.open.children.append(data)


Wish = tuple[int, int, str]  # weight, order and value


def wishes(declarations: str, weight: int, order: int) -> dict[str, Wish]:
    """Display and visibility as a block of declarations wants them; the last of each counts."""
    found: dict[str, Wish] = {}
    for m in _PROPERTY.finditer(declarations):
        wish = (weight + (10_000 if m[3] else 0), order, m[2].lower())
        found[m[1].lower()] = max(wish, found.get(m[1].lower(), wish), key=lambda w: w[0])
    return found


def style_rules(sheet: str) -> dict[str, dict[str, Wish]]:
    """What the rules of a style sheet want, by selector: tag, .class, #id or tag with one of these.

    Other selectors, and rules inside @-blocks, which hold on some screens only, are left out.
    """
    found: dict[str, dict[str, Wish]] = {}
    sheet, at, skip, order = _COMMENT.sub(" ", sheet), 0, 0, 0
    while (brace := sheet.find("{", at)) >= 0:
        close = sheet.find("}", at)
        if 0 <= close < brace:  # the end of a block that is skipped
            skip, at = max(0, skip - 1), close + 1
            continue
        head = sheet[at:brace].rpartition(";")[2]
        at = brace + 1
        if skip or head.lstrip().startswith("@"):
            skip += 1
            continue
        end = sheet.find("}", at)
        body, at = sheet[at : end if end >= 0 else len(sheet)], end + 1 if end >= 0 else len(sheet)
        order += 1
        if "display" not in body.lower() and "visibility" not in body.lower():
            continue
        for one in head.split(","):
            m = _SELECTOR.fullmatch(one)
            if not m or not (m[1] or m[2]):
                continue
            tag, own = (m[1] or "*").lower(), m[2] or ""
            weight = (100 if own[:1] == "#" else 10 if own else 0) + (tag != "*")
            kept = found.setdefault((tag if tag != "*" else "") + own or "*", {})
            for name, wish in wishes(body, weight, order).items():
                kept[name] = max(wish, kept.get(name, wish))
    return found


def settle(root: Node) -> list[Node]:
    """Decide what is seen, by elements, attributes, style sheets and inline styles; the tables that have a place, in order."""
    sheet, stack = [], [root]
    while stack:
        at = stack.pop()
        if at.tag == "style":
            sheet += [c for c in at.children if isinstance(c, str)]
        stack.extend(c for c in reversed(at.children) if isinstance(c, Node))
    rules = style_rules("\n".join(sheet))
    tables, stack = [], [root]
    while stack:
        at = stack.pop()
        attrs = at.attrs
        best: dict[str, Wish] = {}
        if "hidden" in attrs:
            best["display"] = (-1, 0, "none")
        if rules:
            names = ["." + c for c in attrs.get("class", "").split()] + (["#" + attrs["id"]] if attrs.get("id") else [])
            for key in ("*", at.tag, *names, *[at.tag + n for n in names]):
                for name, wish in rules.get(key, {}).items():
                    best[name] = max(wish, best.get(name, wish))
        if attrs.get("style"):
            for name, wish in wishes(attrs["style"], 1_000, 0).items():
                best[name] = max(wish, best.get(name, wish))
        at.gone = (
            at.tag in HIDDEN
            or at.tag == "dialog" and "open" not in attrs
            or at.tag == "input" and (attrs.get("type") or "").lower() == "hidden"
            or best.get("display", (0, 0, ""))[2] == "none"
        )
        if at.gone:
            continue
        if "visibility" in best and best["visibility"][2] != "inherit":
            at.shown = best["visibility"][2] not in ("hidden", "collapse")
        elif at.parent is not None:
            at.shown = at.parent.shown
        if at.tag == "table":
            tables.append(at)
        stack.extend(c for c in reversed(at.children) if isinstance(c, Node))
    return tables


def seen(node: Node) -> list[Node | str]:
    """The children that have a place, without the node's own text where that is not shown."""
    return [c for c in node.children if (node.shown if isinstance(c, str) else not c.gone)]


def width(text: str) -> int:
    """Columns of a text in a fixed-width font."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Renderer:
    """Lines of the visible text: collapsed white space, blank lines around blocks, lists and tables."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line = ""
        self.gap = 0  # blank lines due before the next text
        self.indent = ""
        self.marker = ""  # of a list item that has no text yet
        self.kept = 0  # depth of elements that keep their white space
        self.fresh = False  # nothing of the preformatted text is out yet

    def flush(self) -> None:
        text = self.line.rstrip() if self.kept else self.line.rstrip(" ")
        if text:
            self.put(text)
        self.line = ""

    def newline(self) -> None:
        """The end of a line of preformatted text, which may be empty."""
        empty = not self.line.strip()
        self.flush()
        if empty and not self.fresh:
            self.gap += 1

    def put(self, text: str) -> None:
        if self.lines:
            self.lines.extend([""] * self.gap)
        self.gap, self.fresh = 0, False
        head = self.indent
        if self.marker:
            head = self.indent[: -len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append(head + text)

    def space(self, blank_lines: int) -> None:
        self.flush()
        self.gap = max(self.gap, blank_lines)

    def text(self, data: str) -> None:
        if self.kept:
            for i, part in enumerate(data.split("\n")):
                if i:
                    self.newline()
                self.line += part
            return
        collapsed = _BLANKS.sub(" ", data)
        if not self.line or self.line.endswith(" "):
            collapsed = collapsed.lstrip(" ")
        self.line += collapsed

    def walk(self, root: Node) -> None:
        """Depth first with a stack of its own, so deep pages don't exhaust Python's."""
        stack: list[tuple[str, Node | str, object]] = [("in", root, None)]
        while stack:
            step, node, state = stack.pop()
            if isinstance(node, str):
                self.text(node)
            elif step == "out":
                self.leave(node, state)
            elif not node.gone:
                children, state = self.enter(node)
                stack.append(("out", node, state))
                stack.extend(("in", c, None) for c in reversed(children))
        self.flush()

    def enter(self, node: Node) -> tuple[list[Node | str], object]:
        tag, saved = node.tag, (self.indent, self.marker)
        if tag == "br" and self.kept:
            self.newline()
            return [], saved
        if tag == "br":
            if self.line.strip():
                self.flush()
            elif self.lines and not self.gap:
                self.gap = 1
            return [], saved
        if tag == "img" and node.attrs.get("alt") and node.shown:
            self.text(node.attrs["alt"])
        elif tag == "hr":
            self.space(0)
            if node.shown:
                self.put("---")
            return [], saved
        elif tag in ("pre", "textarea"):
            self.space(1 if tag == "pre" else 0)
            self.kept, self.fresh = self.kept + 1, True
        elif tag == "table":
            self.space(1)
            for line in node.laid:
                if line:
                    self.put(line)
                else:
                    self.gap += 1
            self.space(1)
            return [], saved
        elif tag in LINES:
            inner = tag in ("ul", "ol") and within_list(node)
            self.space(1 if tag in SPACED and not inner else 0)
            if tag == "li":
                self.marker = marker(node)
                self.indent += " " * len(self.marker)
            elif tag in ("blockquote", "dd"):
                self.indent += "  "
            elif tag == "optgroup" and node.attrs.get("label") and node.shown:
                self.text(node.attrs["label"])
                self.flush()
        return seen(node), saved

    def leave(self, node: Node, saved: tuple[str, str]) -> None:
        if node.tag in ("pre", "textarea"):
            self.flush()
            self.kept, self.gap = self.kept - 1, 0
        if node.tag in LINES:
            inner = node.tag in ("ul", "ol") and within_list(node)
            self.space(1 if node.tag in SPACED and not inner else 0)
            self.indent = saved[0]
            if node.tag == "li":
                self.marker = ""


def within_list(node: Node) -> bool:
    at = node.parent
    while at is not None and at.tag not in ("ul", "ol", "td", "body"):
        at = at.parent
    return at is not None and at.tag in ("ul", "ol")


def marker(item: Node) -> str:
    if item.parent.tag != "ol":
        return "- "
    first = item.parent.attrs.get("start") or "1"
    number = int(first) if re.fullmatch(r"-?[0-9]{1,9}", first) else 1
    item.parent.items += 1  # items are rendered in order, each once
    return f"{number + item.parent.items - 1}. "


def lines_of(node: Node) -> list[str]:
    """The lines of one element laid out by itself."""
    renderer = Renderer()
    renderer.walk(node)
    return renderer.lines


def span_of(cell: Node, name: str, most: int) -> int:
    """Columns or rows of a cell, at most as many as browsers take."""
    given = cell.attrs.get(name) or "1"
    return min(int(given), most) if re.fullmatch(r"[0-9]{1,9}", given) else 1


def table_lines(table: Node) -> list[str]:
    """Lines of a table: what stands above, then its rows, cells padded to their columns.

    A cell has as many lines as it needs. Cells that span columns or rows stand in the
    first place; the others stay empty.
    """
    above, rows, stack = [], [], [(c, 0) for c in reversed(seen(table))]
    down: dict[int, tuple[int, int]] = {}  # column: rows that a cell above still takes, its row group
    while stack:
        at, group = stack.pop()
        if isinstance(at, str):
            above += [_BLANKS.sub(" ", at).strip()] if at.strip() else []
        elif at.tag in ("tbody", "thead", "tfoot"):
            stack.extend((c, id(at)) for c in reversed(seen(at)))
        elif at.tag != "tr":
            above += lines_of(at)
        else:
            cells: list[list[str]] = []

            def skip(cells=cells, group=group) -> None:
                while (held := down.get(len(cells))) and held[0] and held[1] == group:
                    down[len(cells)] = (held[0] - 1, group)
                    cells.append([])

            skip()
            for cell in seen(at):
                if isinstance(cell, str) and not cell.strip():
                    continue
                wide = tall = 1
                if not isinstance(cell, str) and cell.tag in ("td", "th"):
                    # No rows means all that are left of the group.
                    wide, tall = span_of(cell, "colspan", 1_000) or 1, span_of(cell, "rowspan", 65_534) or 65_534
                for i in range(wide):
                    down[len(cells)] = (tall - 1, group)
                    cells.append([] if i else [" ".join(cell.split())] if isinstance(cell, str) else lines_of(cell))
                skip()
            for i in [i for i, (left, _) in down.items() if left and i >= len(cells)]:
                down[i] = (down[i][0] - 1, down[i][1])
            if any(cells):
                rows.append(cells)
    widths: list[int] = []
    for cells in rows:
        for i, cell in enumerate(cells):
            if i == len(widths):
                widths.append(0)
            widths[i] = max([widths[i], *[w for line in cell if (w := width(line)) <= WIDEST]])
    lines = []
    for cells in rows:
        for k in range(max(map(len, cells))):
            parts = [cell[k] if k < len(cell) else "" for cell in cells]
            lines.append(" | ".join(c + " " * (w - width(c)) for c, w in zip(parts, widths, strict=False)).rstrip(" |"))
    return above + lines


def render(html: str | None) -> str:
    """The visible text of one whole page."""
    builder = TreeBuilder()
    builder.feed(html or "")
    for table in reversed(settle(builder.root)):  # inner tables first
        table.laid = table_lines(table)
    return "\n".join(lines_of(builder.root))


def _rendered(pages: pa.Array) -> pa.Array:
    return pa.array([render(p) for p in pages.to_pylist()], pa.string())


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text, n_chars, n_lines): all visible text of every whole page, laid out.

    A tree is built with the end and start tags that HTML implies; scripts, styles, comments and
    what is hidden by attribute, inline style or a rule for a tag, class or id are left out; text
    made visible again inside a hidden element is there. Texts of drawings, formulas, text areas
    and all options of a choice are visible. White space is collapsed as on screen, blocks
    stand on lines of their own with blank lines around paragraphs, headings, lists and
    tables, list items have markers and indents, preformatted text keeps its lines, and
    table cells, of one or several lines, are padded to their columns of up to ``WIDEST`` characters.

    Null and empty pages give an empty text; a tag or comment that never ends takes the rest of
    the page; elements nest 512 deep, deeper ones become siblings; repeated rows each give a row; an empty table gives none. Other columns are ignored.
    """
    return (
        pages.select(F.col(f"`{id_col}`").alias("page_id"), F.arrow_udf(_rendered, "string").asNondeterministic()(F.col(f"`{html_col}`")).alias("text"))
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("n_lines", F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).cast("long"))
    )


@query()
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laid-out text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))
