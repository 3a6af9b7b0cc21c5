"""Visible text of HTML pages by layout-aware rendering.

A tree builder with HTML's implied tags (paragraphs that a block ends, list items, table
parts, void elements) makes a tree of each page; visibility rules cut parts of it: elements without a box, the ``hidden`` attribute, closed
``details``, and ``display`` and ``visibility`` by the cascade of the page's own style sheets (for a screen of ``SCREEN`` pixels) and style
attributes: importance, specificity, order. A renderer then lays out the rest: collapsed white space, blocks on lines of
their own, blank lines around paragraphs and headings, indented lists with markers, tables with aligned columns.
Nothing visible is judged or dropped.

Selectors may combine types, classes and ids, as descendants or children; rules with others (attributes, states, siblings) are not applied,
so what they hide is kept. Drawings show their text elements, formulas their symbols, form fields their text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, text_slices

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Blocks, and the blank lines that a block asks for around it.
GAP = dict.fromkeys("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer "
                    "form header hgroup hr html legend li main menu nav ol optgroup option pre search section summary table ul".split(), 1)
GAP |= dict.fromkeys("p h1 h2 h3 h4 h5 h6 blockquote dl figure ol pre table ul menu".split(), 2)
#: Elements without a box of their own.
NO_BOX = frozenset("audio canvas datalist embed head iframe map noembed noframes noscript object param rp script source "
                   "style template title track video annotation annotation-xml".split())
#: Inside a drawing only these show what they hold, and these hold nothing that shows.
SVG_TEXT = frozenset("text foreignobject".split())
SVG_HIDDEN = frozenset("defs desc metadata symbol clippath mask marker pattern".split())
#: Fields whose value is no text on the page.
SILENT_INPUTS = frozenset("hidden password checkbox radio file image color range".split())
#: Width in pixels that media queries see.
SCREEN = 1280
#: A start tag on the left ends an open element on the right, unless one of the third stands between.
_SECTIONS = frozenset("thead tbody tfoot".split())
_CELLS = frozenset("td th".split())
CLOSES = {"li": (frozenset(["li"]), frozenset("ol ul menu".split())),
          "dt": (frozenset("dt dd".split()), frozenset(["dl"])), "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
          "option": (frozenset(["option"]), frozenset(["select"])), "optgroup": (frozenset("option optgroup".split()), frozenset(["select"])),
          "td": (_CELLS, frozenset(["tr", "table"])), "th": (_CELLS, frozenset(["tr", "table"])),
          "tr": (_CELLS | {"tr", "caption"}, frozenset(["table"])),
          **{t: (_CELLS | _SECTIONS | {"tr", "caption", "colgroup"}, frozenset(["table"])) for t in (*_SECTIONS, "caption", "colgroup")}}
_ENDS_P = frozenset(GAP) - {"html", "body", "option", "optgroup", "legend"}
_P_SCOPE = frozenset("button caption html object table td th template".split())
_TABLE_PARTS = frozenset("tr td th thead tbody tfoot".split())
#: A tag that the page's end cuts is no text.
_CUT_TAG = re.compile(r"<[A-Za-z/][^<>]*\Z")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_COMPOUND = re.compile(r"([a-z][a-z0-9-]*|\*)?((?:[.#][\w-]+)*)", re.I)
_COMBINED = re.compile(r"\s*>\s*|\s+")
_PIXELS = re.compile(r"\(\s*(min|max)-width\s*:\s*([0-9.]+)(px|em|rem)\s*\)")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def declared(declarations: str) -> list[tuple[str, str, bool]]:
    """``display`` and ``visibility`` among declarations: (property, value, important)."""
    out = []
    for d in declarations.lower().split(";"):
        name, _, value = d.partition(":")
        if name.strip() in ("display", "visibility") and value.strip():
            plain, important, _ = value.partition("!important")
            out.append((name.strip(), plain.strip(), bool(important)))
    return out


def on_screen(query: str) -> bool:
    """Whether a media query holds on a wide screen; features other than the width count as holding, dark colours and reduced motion do not."""
    for q in query.lower().split(","):
        q = q.strip().removeprefix("only ").strip()
        negated, q = q.startswith("not "), q.removeprefix("not ").strip()
        kind = re.match(r"[a-z]+", q)
        holds = not kind or kind[0] in ("all", "screen")
        for bound, number, unit in _PIXELS.findall(q):
            width = float(number) * (1 if unit == "px" else 16)
            holds &= SCREEN >= width if bound == "min" else SCREEN <= width
        holds &= not re.search(r"prefers-color-scheme\s*:\s*dark|prefers-reduced-motion\s*:\s*reduce", q)
        if holds != negated:
            return True
    return False


def sheet_rules(css: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) of the rules of a style sheet that apply on a screen, in order."""
    css = re.sub(r"/\*.*?(\*/|\Z)", " ", css, flags=re.S)
    close, unclosed = {}, []  # where each block ends; at the sheet's end if nothing closes it
    for brace in re.finditer(r"[{}]", css):
        if brace[0] == "{":
            unclosed.append(brace.start())
        elif unclosed:
            close[unclosed.pop()] = brace.start()
    mark, at, end_of_read = re.compile(r"[{;}]"), 0, len(css)
    while found := mark.search(css, at, end_of_read):
        head, at = css[at:found.start()].strip(), found.end()
        if found[0] != "{":
            continue  # a statement, or the end of a block whose rules were read
        inner = close.get(found.start(), len(css))
        name = re.match(r"@([a-z-]+)\s*(.*)", head, re.I | re.S)
        if not name:
            yield head, css[at:inner]
        elif name[1].lower() in ("media", "supports", "layer") and (name[1].lower() != "media" or on_screen(name[2])):
            continue  # read what it holds
        at = inner + 1


class Selector:
    """Compounds of type, classes and id, from the element outwards, with what joins each to the one inside it (child or descendant)."""

    __slots__ = ("parts", "weight", "needs")

    def __init__(self, parts: list[tuple[bool, str, frozenset[str], frozenset[str]]]):
        self.parts = parts
        self.needs = [n for _, t, c, i in parts[1:] for n in (*([t] if t not in ("", "*") else ()), *(f".{x}" for x in c), *(f"#{x}" for x in i))]
        self.weight = (sum(len(i) for *_, i in parts), sum(len(c) for _, _, c, _ in parts), sum(t not in ("", "*") for _, t, _, _ in parts))

    @classmethod
    def parse(cls, text: str) -> "Selector | None":
        text = text.strip()
        joins = ["" if not j.strip() else ">" for j in _COMBINED.findall(text)]
        parts = []
        for k, compound in enumerate(_COMBINED.split(text)):
            m = _COMPOUND.fullmatch(compound)
            if not m or not compound:
                return None
            names = re.findall(r"[.#][\w-]+", m[2])
            parts.append((k < len(joins) and joins[k] == ">", (m[1] or "").lower(), frozenset(n[1:] for n in names if n[0] == "."),
                          frozenset(n[1:] for n in names if n[0] == "#")))
        return cls(parts[::-1])

    def fits(self, node: Node, above: list[Node], names: Counter) -> bool:
        """Whether the selector names ``node`` under the open elements ``above``, whose types, classes and ids ``names`` counts."""
        if not self._is(node, 0) or not all(names[n] for n in self.needs):
            return False
        todo = [(1, len(above) - 1)]
        while todo:
            k, i = todo.pop()
            if k == len(self.parts):
                return True
            child = self.parts[k][0]
            for j in range(i, i - 1 if child else -1, -1):
                if j >= 0 and self._is(above[j], k):
                    if k + 1 == len(self.parts):
                        return True
                    todo.append((k + 1, j - 1))
                    if not child and not self.parts[k + 1][0]:
                        break  # the nearest one is the best for a descendant
        return False

    def _is(self, node: Node, k: int) -> bool:
        _, tag, classes, ids = self.parts[k]
        if tag not in ("", "*", node.tag):
            return False
        return (not classes or classes <= set(node.attrs.get("class", "").split())) and (not ids or ids == {node.attrs.get("id")})


class Cascade:
    """The rules of a page on ``display`` and ``visibility``, looked up by what their innermost compound names."""

    def __init__(self, styles: str):
        self.rules: dict[str, list] = {}
        order = 0
        for selectors, declarations in sheet_rules(styles):
            if found := declared(declarations):
                for text in selectors.split(","):
                    if selector := Selector.parse(text):
                        _, tag, classes, ids = selector.parts[0]
                        key = f"#{min(ids)}" if ids else f".{min(classes)}" if classes else tag if tag != "*" else ""
                        for name, value, important in found:
                            order += 1
                            self.rules.setdefault(key, []).append(((important, False, selector.weight, order), name, value, selector))

    def styles(self, node: Node, above: list[Node], names: Counter) -> dict[str, str]:
        """The winning values for an element."""
        best: dict[str, tuple] = {}
        if self.rules:
            for key in ("", *_names(node)):
                for rank, name, value, selector in self.rules.get(key, ()):
                    if (name not in best or rank > best[name][0]) and selector.fits(node, above, names):
                        best[name] = (rank, value)
        if "style" in node.attrs:
            for i, (name, value, important) in enumerate(declared(node.attrs["style"])):
                rank = (important, True, (), i)
                if name not in best or rank[:2] > best[name][0][:2] or rank[:2] == best[name][0][:2] and i >= best[name][0][3]:
                    best[name] = (rank, value)
        return {name: value for name, (_, value) in best.items()}


class Builder(HTMLParser):
    """Builds the tree; ``close`` ends it. Open elements are a stack, so that nesting of any depth is safe."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open, self.count = [self.root], {"html": 1}
        self.styles: list[str] = []

    def _push(self, tag: str, attrs: dict[str, str]) -> Node:
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        self.open.append(node)
        self.count[tag] = self.count.get(tag, 0) + 1
        return node

    def _pop(self) -> None:
        self.count[self.open.pop().tag] -= 1

    def _end(self, tags: frozenset[str], barrier: frozenset[str]) -> None:
        """Close the innermost open element of ``tags`` and all inside it, as long as no barrier stands between."""
        if not any(self.count.get(t) for t in tags):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                while len(self.open) > i:
                    self._pop()
                return
            if self.open[i].tag in barrier:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        attrs = {k: v or "" for k, v in reversed(attrs)}
        if tag in ("html", "body"):
            if tag == "body":
                self._end(frozenset(["head"]), frozenset())
            if tag == "html":
                self.root.attrs.update(attrs)
                return
            if self.count.get("body"):
                return
        elif self.count.get("head") and tag not in ("title", "meta", "link", "style", "script", "base", "noscript", "template"):
            self._end(frozenset(["head"]), frozenset())  # a body element ends the head
        if tag in _ENDS_P and self.count.get("p"):
            self._end(frozenset(["p"]), _P_SCOPE)
        if tag in CLOSES:
            tags, barrier = CLOSES[tag]
            for _ in range(3 if tag in _SECTIONS or tag in ("tr", "caption") else 1):
                self._end(tags, barrier)
        if tag in _CELLS and self.count.get("table") and self._inner(_TABLE_PARTS | {"table"}) != "tr":
            self._push("tr", {})
        self._push(tag, attrs)
        if tag in VOID:
            self._pop()

    def _inner(self, tags: frozenset[str]) -> str | None:
        return next((n.tag for n in reversed(self.open) if n.tag in tags), None)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "p" and not self.count.get("p"):
            self._push("p", {})  # HTML makes an empty paragraph of it
            self._pop()
        elif tag == "br":
            self.handle_starttag("br", [])
        elif tag not in ("html", "body") and tag not in VOID:
            self._end(frozenset([tag]), frozenset(["table"]) - {tag})

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "style":
            self.styles.append(data)
        elif self.open[-1].tag != "script":
            if self.open[-1].tag == "head" and data.strip():
                self._pop()
            self.open[-1].children.append(data)


class Lines:
    """Text being laid out: collapses white space, keeps asked-for line breaks to the largest."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.breaks, self.space, self.prefix = 0, False, ""

    def text(self, data: str) -> None:
        data = _SPACE.sub(" ", data)
        if data[:1] == " ":
            self.space, data = True, data[1:]
        if data:
            self._flush()
            if data[-1] == " ":
                self.parts.append(data[:-1])
                self.space = True
            else:
                self.parts.append(data)

    def _flush(self) -> None:
        if self.breaks:
            self.parts.append("\n" * self.breaks if self.parts else "")
        elif self.space and self.parts and not self.parts[-1].endswith("\n"):
            self.parts.append(" ")
        self.breaks, self.space = 0, False
        if self.prefix:
            self.parts.append(self.prefix)
            self.prefix = ""

    def raw(self, data: str) -> None:
        """Preformatted text."""
        if data:
            self._flush()
            self.parts.append(data)

    def line_end(self) -> None:
        if not self.breaks:
            self._flush()
            self.parts.append("\n")
            self.space = False
        else:
            self.breaks += 1

    def gap(self, n: int) -> None:
        self.space = False
        if self.parts:
            ended = 1 if self.parts[-1].endswith("\n") else 0
            self.breaks = max(self.breaks, n - ended)

    def done(self) -> str:
        return "".join(self.parts).strip("\n")


def _table(rows: list[list[tuple[str, int, int]]]) -> str:
    """Rows of (text, columns spanned, rows spanned) with aligned columns, two blanks apart; cells of several lines keep them."""
    placed: list[list[tuple[int, str, int]]] = []  # column, text, columns of each cell
    taken: dict[int, int] = {}  # rows for which a cell above still holds a column
    for row in rows:
        at, cells, held = 0, [], {c: n - 1 for c, n in taken.items() if n > 1}
        for text, span, down in row:
            while taken.get(at):
                at += 1
            cells.append((at, text, span))
            if down > 1:
                held.update(dict.fromkeys(range(at, at + span), down - 1))
            at += span
        placed.append(cells)
        taken = held
    width = [0] * max((at + span for cells in placed for at, _, span in cells), default=0)
    for cells in placed:
        for at, text, span in cells:
            if span == 1:
                width[at] = max([width[at], *map(len, text.split("\n"))])
    for cells in placed:  # what spans columns widens the last of them
        for at, text, span in cells:
            if span > 1:
                lack = max(map(len, text.split("\n"))) - sum(width[at:at + span]) - 2 * (span - 1)
                width[at + span - 1] += max(0, lack)
    begin = [0]
    for w in width:
        begin.append(begin[-1] + w + 2)
    out = []
    for cells in placed:
        if any(text for _, text, _ in cells):
            texts = [(at, text.split("\n")) for at, text, _ in cells]
            for i in range(max(len(t) for _, t in texts)):
                line = ""
                for at, t in texts:
                    if i < len(t) and t[i]:
                        line = line.ljust(begin[at]) + t[i]
                out.append(line.rstrip())
    return "\n".join(out)


def _indent(text: str, first: str) -> str:
    return first + text.replace("\n", "\n" + " " * len(first))


def _span(node: Node, name: str, most: int) -> int:
    value = node.attrs.get(name, "1").strip()
    if not (value.isascii() and value.isdigit()):
        return 1
    return min(max(int(value[:9]), 1), most) if name == "colspan" or int(value[:9]) else most  # rowspan=0: to the end


def _whole(node: Node, name: str) -> int | None:
    value = node.attrs.get(name, "").strip()
    return int(value) if re.fullmatch(r"[+-]?[0-9]{1,9}", value) else None


def _marker(kind: str, n: int) -> str:
    """The marker of an ordered list's item."""
    if kind in ("a", "A") and n > 0:
        out = ""
        while n:
            n, r = divmod(n - 1, 26)
            out = chr(97 + r) + out
        return out if kind == "a" else out.upper()
    if kind in ("i", "I") and 0 < n < 4000:
        out = ""
        for value, text in ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
            out, n = out + text * (n // value), n % value
        return out if kind == "i" else out.upper()
    return str(n)


def _names(node: Node) -> list[str]:
    """What a selector can name of an element."""
    out = [node.tag, *{f".{c}" for c in node.attrs.get("class", "").split()}]
    return [*out, f"#{node.attrs['id']}"] if "id" in node.attrs else out


class Renderer:
    """Walks the tree without recursion. Items, cells and tables are laid out by themselves, then placed in their parent."""

    def __init__(self, cascade: Cascade):
        self.cascade = cascade
        self.lines = [Lines()]
        self.tables: list[list[list[tuple[str, int, int]]]] = []
        self.lists: list[list] = []
        self.pre = 0
        self.above: list[Node] = []
        self.names: Counter = Counter()
        self.visible, self.drawing = [True], [False]

    def shown(self, node: Node) -> bool:
        """Whether an element has a box; if so, it is opened with its visibility, which it inherits unless a rule says otherwise."""
        if node.tag in NO_BOX or self.drawing[-1] and node.tag in SVG_HIDDEN:
            return False
        styles = self.cascade.styles(node, self.above, self.names)
        display = styles.get("display", "none" if "hidden" in node.attrs or node.tag == "dialog" and "open" not in node.attrs else "")
        if display == "none":
            return False
        value = styles.get("visibility", "inherit")
        self.visible.append(self.visible[-1] if value in ("inherit", "unset") else value not in ("hidden", "collapse"))
        self.drawing.append(node.tag == "svg" or self.drawing[-1] and node.tag not in SVG_TEXT)
        self.above.append(node)
        self.names.update(_names(node))
        return True

    def render(self, root: Node) -> str:
        todo: list[tuple[Node | str, bool]] = [(root, True)]
        while todo:
            node, enter = todo.pop()
            if isinstance(node, str):
                if self.visible[-1] and not self.drawing[-1]:
                    self.lines[-1].raw(node) if self.pre else self.lines[-1].text(node)
            elif not enter:
                self.leave(node)
                self.names.subtract(_names(node))
                for stack in (self.above, self.visible, self.drawing):
                    stack.pop()
            elif self.shown(node):
                self.enter(node)
                todo.append((node, False))
                children = node.children
                if node.tag == "details" and "open" not in node.attrs:
                    children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
                todo.extend((c, True) for c in reversed(children))
        return "\n".join(line.rstrip() for line in self.lines[0].done().split("\n")).strip()

    def enter(self, node: Node) -> None:
        tag, lines = node.tag, self.lines[-1]
        if tag == "br":
            lines.line_end()
        elif tag == "img":
            self._say(node.attrs.get("alt", ""))
        elif tag == "input":
            if node.attrs.get("type", "").strip().lower() not in SILENT_INPUTS:
                self._say(node.attrs.get("value") or node.attrs.get("placeholder", ""))
        elif tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in _CELLS and self.tables or tag in ("li", "dd", "blockquote"):
            self.lines.append(Lines())
        elif tag in ("ol", "ul", "menu"):
            down = tag == "ol" and "reversed" in node.attrs
            start = _whole(node, "start")
            if start is None:
                start = sum(isinstance(c, Node) and c.tag == "li" for c in node.children) if down else 1
            self.lists.append([tag, start, -1 if down else 1, node.attrs.get("type", "1")])
            lines.gap(1 if len(self.lists) > 1 else 2)
        elif tag in GAP:
            lines.gap(GAP[tag])
        elif tag in SVG_TEXT:
            lines.gap(1)
        if tag in ("pre", "textarea"):
            self.pre += 1

    def leave(self, node: Node) -> None:
        tag = node.tag
        if tag in ("pre", "textarea"):
            self.pre -= 1
        if tag == "table":
            rows = self.tables.pop()
            self._place(_table(rows), 2)
        elif tag in _CELLS and self.tables:
            text = self.lines.pop().done()
            if not self.tables[-1]:
                self.tables[-1].append([])
            self.tables[-1][-1].append((text, _span(node, "colspan", 1000), _span(node, "rowspan", 65534)))
        elif tag == "li":
            kind = self.lists[-1] if self.lists else ["ul", 1, 1, "1"]
            marker = "- "
            if kind[0] == "ol":
                value = _whole(node, "value")
                kind[1] = kind[1] if value is None else value
                marker = f"{_marker(node.attrs.get('type', kind[3]), kind[1])}. "
                kind[1] += kind[2]
            text = self.lines.pop().done()
            self._place(_indent(text, marker) if text else "", 1)
        elif tag in ("dd", "blockquote"):
            text = self.lines.pop().done()
            self._place(_indent(text, "    " if tag == "dd" else "  ") if text else "", GAP[tag])
        elif tag in ("ol", "ul", "menu"):
            self.lists.pop()
            self.lines[-1].gap(1 if self.lists else 2)
        elif tag in GAP:
            self.lines[-1].gap(GAP[tag])
        elif tag in SVG_TEXT:
            self.lines[-1].gap(1)

    def _say(self, text: str) -> None:
        """Text that an attribute holds."""
        if self.visible[-1]:
            self.lines[-1].text(text)

    def _place(self, block: str, gap: int) -> None:
        lines = self.lines[-1]
        lines.gap(gap)
        lines.raw(block)
        lines.gap(gap)


def visible_text(html: str | None) -> str:
    """The visible text of a page; an empty text for null."""
    page = _CUT_TAG.sub("", (html or "").replace("\0", "�"))
    builder = Builder()
    builder.feed(page)
    builder.close()
    return Renderer(Cascade("\n".join(builder.styles))).render(builder.root)


def _extract(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batch, "html"):
        texts = [visible_text(h) for h in part.column("html").to_pylist()]
        yield pa.record_batch([part.column("page_id"), pa.array(texts, pa.string()), pa.array([t.count("\n") + 1 if t else 0 for t in texts])],
                              names=["page_id", "text", "n_lines"])


def extract_text(pages: DataFrame) -> DataFrame:
    """``(page_id, text, n_lines)`` for each row of ``pages(page_id, html)``.

    Null and empty pages give an empty text; a page without tags is its own text with white space collapsed. Rows repeat as they come, null
    ids stay null, other columns are ignored. One map without a shuffle.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "html")
    return map_arrow(pages, _extract, "page_id long, text string, n_lines long")
