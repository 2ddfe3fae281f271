"""HTML extraction: a tree builder and a layout-aware text renderer.

The builder implies the tags that HTML lets authors leave out (``</p>`` before
a block, ``</li>``, ``</td>``, ``</tr>``, ``</option>`` ...), closes what an
end tag leaves open and ignores end tags without a start. The renderer emits
all visible text: white space collapses as a browser shows it, blocks stand
on lines of their own, paragraphs, headings, lists and tables are set off by
a blank line, list items get their bullet or number and indent, and the cells
of a table are aligned in columns (wide characters count two columns), those
that span rows or columns keep their place. A table whose padding would exceed
16 times its text gets narrower columns, which long cells overflow, in the end
none. Block or inline display is that of the tag or of an applied rule.

Not visible (``visibility`` is inherited, what is visible again inside shows): ``head``, scripts, styles, templates, ``noscript``, comments,
elements with ``hidden`` or ``display:none`` / ``visibility:hidden`` (in their
style, or by a tag, class or id rule of a ``style`` element, the winning one by
importance, specificity and order), closed ``details`` but for their summary,
and replaced content. Of formulas (``math``) all but annotations and phantoms
is visible; parts that stand above or below each other are set apart by a
space. Of drawings (``svg``) the ``text`` and ``foreignObject`` elements are,
outside definitions and descriptions, a space around each placed piece; what
``use`` repeats of a definition is not. Rules for other media than screens never count. Rules
under a condition (a width, ``@supports`` ...) never hide, but they show: what
some screen shows is kept. Rules with other selectors are not applied.

Edge cases: null or empty html gives the empty text; unclosed markup runs to
the end of the page; elements nested deeper than 200 are laid out as siblings,
with the visibility of what they stand in; spans count up to column 65,536.
Repeated rows give repeated results; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from unicodedata import combining, east_asian_width

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import pieces, texts

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript iframe noembed noframes object video audio canvas datalist title meta link param source track".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul".split())
ENDS_P = BLOCK - frozenset("body html legend caption tbody td tfoot th thead tr option optgroup".split())
#: A start tag closes these open elements, up to the nearest of the limits.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "optgroup", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
CLOSES["tbody"] = CLOSES["tfoot"] = CLOSES["thead"]
#: Parts of drawings and formulas that are not shown where they stand.
UNDRAWN = {"svg": frozenset("defs metadata desc title symbol clippath mask pattern marker filter".split()), "math": frozenset("annotation annotation-xml mphantom".split())}
#: Elements inside them whose content is HTML again.
INTEGRATES = {"svg": frozenset(["foreignobject"]), "math": frozenset("mi mo mn ms mtext annotation-xml".split())}
KEEPS_P = frozenset(["table", "td", "th", "button", "object"]).union(*INTEGRATES.values())
#: HTML elements that end an open drawing or formula.
BREAKS_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: Formula elements that lay out their children above each other or in cells.
STACKS = frozenset("mfrac mroot munder mover munderover mtable mtr mlabeledtr".split())
#: Display values that set an element on lines of its own, and those that do not.
ON_LINES = frozenset("block flex grid flow-root table list-item table-row table-caption table-row-group".split())
IN_LINE = frozenset("inline inline-block inline-flex inline-grid inline-table table-cell".split())
_DEPTH = 200
_COLUMNS = 1 << 16
_PADDING = 16
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>]+)))?""")
#: What structures style text: comments and wrappers (skipped), strings, URLs and escapes (kept whole), braces and semicolons.
_CSS = re.compile(r"""(/\*.*?(?:\*/|\Z)|<!--|-->|<!\[CDATA\[|\]\]>)|"(?:[^"\\\n]|\\.)*"?|'(?:[^'\\\n]|\\.)*'?|url\(\s*[^"')\s][^)]*\)?|\\.|([{};])""", re.S | re.I)
_DECLARED = re.compile(r"\s*(display|visibility|content-visibility)\s*:\s*([\w-]+)[^!]*(!\s*important\b)?", re.I)
_HIDES = frozenset([("display", "none"), ("visibility", "hidden"), ("visibility", "collapse"), ("content-visibility", "hidden")])
_SELECTOR = re.compile(r"([.#]?)((?:[\w-]|\\[0-9a-fA-F]{1,6}\s?|\\.)+)", re.S)
_INNER = re.compile(r"\([^()]*\)|\[[^\[\]]*\]")
_AT = re.compile(r"@([\w-]+)\s*(.*)", re.S)
_MAY_HIDE = re.compile(r"display|visibility", re.I)
_ESCAPE = re.compile(r"\\(?:([0-9a-fA-F]{1,6})\s?|(.))", re.S)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    #: ``space``: what the content is ("" HTML, "svg", "text" of a drawing, "math"); ``apart``: a placed piece of those; ``undrawn``: never shown there
    #: ``up``: of elements below the depth limit, what they stand in; ``state``: (drawn, visible, display) once known
    __slots__ = ("tag", "attrs", "inside", "space", "apart", "undrawn", "up", "state")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, outer: Node | None = None):
        self.tag, self.attrs, self.inside = tag, attrs or {}, []
        self.space, self.apart, self.undrawn, self.up, self.state = "", False, False, None, None
        around = outer.space if outer else ""
        if tag in UNDRAWN:
            self.space = tag
        elif around:
            kind = "math" if around == "math" else "svg"
            a = self.attrs
            self.undrawn = tag in UNDRAWN[kind] or a.get("display") == "none"
            self.space = "" if tag in INTEGRATES[kind] else "text" if kind == "svg" and tag in ("text", "title", "desc", "style") else around
            self.apart = outer.tag in STACKS if kind == "math" else tag in ("text", "foreignobject") or tag == "tspan" and ("x" in a or "y" in a)


def _attrs(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(source):
        out.setdefault(m[1].lower(), unescape(next((v for v in m.groups()[1:] if v is not None), "")))
    return out


def parse(html: str) -> Node:
    root = Node("#root")
    open_ = [root]
    places: dict[str, list[int]] = {}  # where the open elements of a tag stand

    def cut(i: int) -> None:
        while len(open_) > i:
            places[open_.pop().tag].pop()

    def last(names) -> int:
        return max((places[x][-1] for x in names if places.get(x)), default=0)

    def close(names, limits) -> None:
        # an implied end may end several (td, tr, tbody)
        while (i := last(names)) > last(limits - names):
            cut(i)

    def put(node: Node) -> None:
        if len(open_) > _DEPTH:
            node.up = open_[-1]
            open_[_DEPTH - 1].inside.append(node)
        else:
            open_[-1].inside.append(node)

    def add(text: str) -> None:
        # a drawing shows no text but that of its text elements
        if not text or open_[-1].space == "svg":
            return
        if len(open_) > _DEPTH:
            floor, inner = open_[_DEPTH - 1].inside, open_[-1]
            part = floor[-1] if floor else None
            if part is not inner and not (isinstance(part, Node) and part.tag == "#part" and part.up is inner):
                part = Node("#part")
                put(part)
            part.inside.append(text)
        else:
            open_[-1].inside.append(text)

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if not m:
            add(unescape(html[at:]))
            break
        add(unescape(html[at : m.start()]))
        at = m.end()
        cdata, end, start, attrs = m.groups()
        if cdata is not None:
            add(cdata)
        elif end is not None:
            tag = end.lower()
            if tag == "br":
                put(Node("br"))
                continue
            limit = last(["table"]) if tag not in ("table", "html", "body", "div", "section", "article") else 0
            if (i := last([tag])) > limit:
                cut(i)
            elif tag == "p" and not limit:  # one without a start makes an empty paragraph
                put(Node("p"))
        elif start is not None:
            tag = start.lower()
            while tag in BREAKS_OUT and open_[-1].space:
                cut(len(open_) - 1)
            if tag in ENDS_P:
                close({"p"}, KEEPS_P)
            if tag in CLOSES:
                close(*CLOSES[tag])
            elif tag not in UNSEEN and tag != "html" and open_[-1].tag == "head":
                cut(len(open_) - 1)
            around = open_[-1].space
            node = Node(tag, _attrs(attrs) if attrs and attrs.strip() else None, open_[-1])
            put(node)
            if tag in RAW and not (around and (tag not in ("script", "style") or attrs.rstrip().endswith("/"))):
                stop = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)", re.I).search(html, at)
                text = html[at : stop.start() if stop else n]
                at = stop.end() if stop else n
                if text:
                    node.inside.append(unescape(text) if tag in ("title", "textarea") else text)
            elif tag not in VOID and not attrs.rstrip().endswith("/") or tag in BLOCK and tag not in VOID:
                places.setdefault(tag, []).append(len(open_))
                open_.append(node)
    return root


def _walk(node: Node) -> Iterator[Node]:
    todo = [node]
    while todo:
        x = todo.pop()
        yield x
        todo += [y for y in reversed(x.inside) if isinstance(y, Node)]


def on_screen(query: str) -> bool | None:
    """Whether a media query list holds on a screen: True (on each), False
    (on some: it has conditions) or None (on none)."""
    out = None
    for part in query.lower().split(",") if query.strip() else ["all"]:
        words = part.split("(")[0].split()
        negated = words[:1] == ["not"]
        kind = next((w for w in words if w not in ("not", "only", "and")), "all")
        if kind not in ("all", "screen"):
            holds = True if negated else None
        else:
            holds = False if "(" in part else None if negated else True
        out = holds if out is None else out or bool(holds)
    return out


def _selectors(prelude: str) -> list[str]:
    """The tag, class and id selectors of a list; others are left out."""
    n = 1 if "(" in prelude or "[" in prelude else 0
    while n:  # commas in :not(...) and the like part no selectors
        prelude, n = _INNER.subn(":", prelude)
    out = []
    for x in prelude.split(","):
        if m := _SELECTOR.fullmatch(x.strip()):
            name = _ESCAPE.sub(lambda e: e[2] or chr(min(int(e[1], 16), 0x10FFFF)), m[2])
            out.append(m[1] + (name if m[1] else name.lower()))
    return out


def declared(css: str, media: str = "", own: list[str] | None = None) -> Iterator[tuple[list[str], str, str, bool, bool]]:
    """What style text declares for screens: (selectors, property, value,
    important, in a layer; the value of a declaration under conditions is ""), blocks read with their nesting. ``own``: the
    selectors of declarations outside blocks (a style attribute)."""
    if not _MAY_HIDE.search(css):
        return
    # open blocks: selectors (None: of a list of rules), whether they hold (as on_screen), in a layer
    blocks: list[tuple[list[str] | None, bool | None, bool]] = [(own, on_screen(media), False)]
    text: list[str] = []
    at = 0

    def ended() -> Iterator[tuple[list[str], str, str, bool, bool]]:
        selectors, holds, layer = blocks[-1]
        m = _DECLARED.match("".join(text)) if selectors and holds is not None else None
        text.clear()
        if m:
            what, value = m[1].lower(), m[2].lower()
            if holds or (what, value) not in _HIDES:
                yield selectors, what, value if holds else "", bool(m[3]), layer

    for m in _CSS.finditer(css):
        text.append(css[at : m.start()])
        at = m.end()
        if m[2] is None:
            text.append("" if m[1] else m[0])
        elif m[2] == "{":
            selectors, holds, layer = blocks[-1]
            prelude = "".join(text).strip()
            text.clear()
            if rule := _AT.match(prelude):
                name = rule[1].lower()
                layer = layer or name == "layer"
                here = on_screen(rule[2]) if name == "media" else True if name == "layer" else False if name in ("supports", "container", "scope") else None
                holds = None if holds is None or here is None else holds and here
            elif selectors is None:
                selectors = _selectors(prelude)
            elif prelude != "&":  # of elements inside the outer rule's
                selectors = []
            blocks.append((selectors, holds, layer))
        else:
            yield from ended()
            if m[2] == "}" and len(blocks) > 1:
                blocks.pop()
    text.append(css[at:])
    yield from ended()


class Renderer:
    def __init__(self, root: Node):
        #: selector -> (property, value, its rank among declarations)
        self.rules: dict[str, list[tuple[str, str, tuple]]] = {}
        self.visible = True  # of the element that is laid out
        todo, order = [root], 0
        while todo:
            node = todo.pop()
            if node.tag == "style" and node.attrs.get("type", "").strip().lower() in ("", "text/css"):
                for selectors, what, value, important, layer in declared("".join(x for x in node.inside if isinstance(x, str)), node.attrs.get("media", "")):
                    order += 1
                    for x in selectors:
                        rank = important, layer == important, 0, ".#".find(x[0]), order
                        self.rules.setdefault(x, []).append((what, value, rank))
            elif node.tag not in ("noscript", "template"):
                todo += [y for y in reversed(node.inside) if isinstance(y, Node)]

    def style(self, node: Node) -> tuple[bool, bool, str]:
        """(drawn, visible, display) of an element inside the one laid out."""
        if node.state is None:
            up, a = node.up, node.attrs
            drawn, visible = (up.state or self.style(up))[:2] if up else (True, self.visible)
            if up and up.tag == "details" and "open" not in up.attrs and node.tag != "summary":
                drawn = False
            if not drawn or node.tag in UNSEEN or node.undrawn or node.tag == "input":
                node.state = False, visible, ""
            elif not self.rules and "style" not in a and "hidden" not in a and "visibility" not in a:
                node.state = True, visible, ""
            else:
                node.state = self._styled(node, visible)
        return node.state

    def _styled(self, node: Node, visible: bool) -> tuple[bool, bool, str]:
        a = node.attrs
        best: dict[str, tuple[tuple, str]] = {}
        found = [r for x in {node.tag, "#" + a.get("id", ""), *("." + c for c in a.get("class", "").split())} for r in self.rules.get(x, ())]
        if node.space:  # an attribute of drawings is the weakest rule
            found.append(("visibility", a.get("visibility", ""), (False, False, -1, 0, 0)))
        for _, what, value, important, _ in declared(a["style"], own=["style"]) if "style" in a else ():
            found.append((what, value, (important, True, 1, 0, len(found))))
        for what, value, rank in found:
            if what not in best or rank > best[what][0]:
                best[what] = rank, value
        value = {what: x for what, (_, x) in best.items()}
        own = value.get("visibility")
        if own in ("hidden", "collapse"):
            visible = False
        elif own in ("visible", "initial") or own == "" and not node.space:
            visible = True
        drawn = "hidden" not in a and value.get("display") != "none" and value.get("content-visibility") != "hidden"
        return drawn, visible, value.get("display", "")

    def seen(self, node: Node) -> bool:
        return self.style(node)[0]

    def lines(self, nodes: list, pre: bool = False) -> list[str]:
        """Nodes laid out as lines; an empty line separates spaced blocks."""
        out: list[str] = []
        line: list[str] = []  # the open line, its white space collapsed
        state = {"gap": False, "lead": False}

        def flush() -> None:
            text = "".join(line)
            line.clear()
            text = text.rstrip("\n") if pre else text.strip(" ")
            if text:
                put([text])

        def put(block: list[str], before: bool = False, after: bool = False) -> None:
            if not block:
                return
            if not out:
                state["lead"] = before
            elif before or state["gap"]:
                out.append("")
            state["gap"] = after
            out.extend(block)

        def inline(items: list) -> None:
            for x in items:
                if isinstance(x, str):
                    if not self.visible:
                        continue
                    if pre:
                        *whole, rest = x.split("\n")
                        for w in whole:
                            line.append(w)
                            put(["".join(line).rstrip()])
                            line.clear()
                        line.append(rest)
                        continue
                    text = _SPACE.sub(" ", x)
                    if text.startswith(" ") and (not line or line[-1].endswith(" ")):
                        text = text[1:]
                    if text:
                        line.append(text)
                    continue
                if x.tag == "br":
                    flush()
                    continue
                drawn, visible, display = self.style(x)
                if not drawn:
                    continue
                around, self.visible = self.visible, visible
                if display in ON_LINES or x.tag in BLOCK and display not in IN_LINE:
                    flush()
                    block = self.block(x, pre)
                    if x.tag in SPACED:
                        self.lead = self.trail = not (x.tag in ("ul", "ol") and self.nested)
                    elif x.tag in ("menu", "dir", "li"):
                        self.lead = self.trail = False
                    put(block, self.lead, self.trail)
                else:
                    apart(x)
                    inline(x.inside)
                    apart(x)
                self.visible = around

        def apart(x: Node) -> None:
            if (x.apart or x.tag in BLOCK) and line and not line[-1].endswith(" "):
                line.append(" ")

        inline(nodes)
        flush()
        # a block's outer gaps are those of its first and last child
        self.lead, self.trail = state["lead"], state["gap"]
        return out

    nested = 0
    lead = trail = False

    def block(self, node: Node, pre: bool) -> list[str]:
        tag = node.tag
        if tag == "table":
            return self.table(node)
        if tag in ("ul", "ol", "menu", "dir"):
            return self.list(node, pre)
        if tag == "details" and "open" not in node.attrs:
            first = next((x for x in node.inside if isinstance(x, Node) and x.tag == "summary"), None)
            return self.lines([first], pre) if first else []
        if tag == "blockquote" or tag == "dd":
            return [("  " + x).rstrip() for x in self.lines(node.inside, pre)]
        return self.lines(node.inside, pre or tag == "pre")

    def list(self, node: Node, pre: bool) -> list[str]:
        out: list[str] = []
        items = sum(isinstance(x, Node) and x.tag == "li" and self.seen(x) for x in node.inside)
        step = -1 if node.tag == "ol" and "reversed" in node.attrs else 1
        number = _int(node.attrs.get("start"), items if step < 0 else 1)
        kind = node.attrs.get("type", "1").strip()
        self.nested += 1
        loose: list = []

        def rest() -> None:
            out.extend(self.lines(loose, pre))
            loose.clear()

        for x in node.inside:
            if isinstance(x, Node) and x.tag == "li":
                rest()
                if not self.seen(x):
                    continue
                if node.tag == "ol":
                    number = _int(x.attrs.get("value"), number)
                    mark = f"{ordinal(number, x.attrs.get('type', kind).strip())}. "
                    number += step
                else:
                    mark = "- "
                around, self.visible = self.visible, self.style(x)[1]
                inner = self.lines(x.inside, pre)
                self.visible = around
                if inner:
                    out += [mark + inner[0], *((" " * len(mark) + y).rstrip() for y in inner[1:])]
            else:
                loose.append(x)
        rest()
        self.nested -= 1
        return out

    def table(self, node: Node) -> list[str]:
        outer, self.nested = self.nested, 0
        above: list[str] = []
        rows: list[tuple[int, list[tuple[list[str], int, int]]]] = []  # (row group, cells)
        todo: list = [(x, self.visible, 0) for x in reversed(node.inside)]
        loose: list = []
        around, groups = self.visible, 0
        while todo:
            x, self.visible, group = todo.pop()
            if isinstance(x, str):
                if self.visible:
                    loose.append(x)
                continue
            if x.tag in ("tr", "tbody", "thead", "tfoot", "caption"):
                drawn, self.visible, _ = self.style(x)
                if not drawn:
                    continue
            if x.tag == "tr":
                rows.append((group, self.cells(x.inside, above)))
            elif x.tag in ("tbody", "thead", "tfoot"):
                groups += 1
                todo += [(y, self.visible, groups) for y in reversed(x.inside)]
            elif x.tag in ("td", "th"):
                rows.append((group, self.cells([x], above)))
            elif x.tag == "caption":
                above += self.lines(x.inside)
            elif x.tag not in ("colgroup", "col"):
                self.style(x)  # with the visibility that holds here
                loose.append(x)
        self.visible = around
        above = self.lines(loose) + above  # what is no cell stands before the table
        self.nested = outer
        return above + aligned(placed(rows))

    def cells(self, row: list, above: list[str]) -> list[tuple[list[str], int, int]]:
        """(lines, columns, rows) of the cells."""
        out: list[tuple[list[str], int, int]] = []
        around = self.visible
        for x in row:
            if isinstance(x, Node) and x.tag in ("td", "th"):
                drawn, self.visible, _ = self.style(x)
                if drawn:
                    down = _int(x.attrs.get("rowspan"), 1)
                    out.append((self.lines(x.inside), min(max(_int(x.attrs.get("colspan"), 1), 1), 1000), down if 0 < down <= 65534 else 65534 if down else 0))
                self.visible = around
            elif isinstance(x, Node) or x.strip():
                above += self.lines([x])
        return out


def _int(text: str | None, other: int) -> int:
    m = re.match(r"\s*([+-]?[0-9]{1,9})(?![0-9])", text or "")
    return int(m[1]) if m else other


def ordinal(n: int, kind: str) -> str:
    """The number of a list item as ``type`` wants it (1, a, A, i, I)."""
    if kind in ("a", "A") and n > 0:
        out = ""
        while n:
            n, x = divmod(n - 1, 26)
            out = chr(97 + x) + out
        return out if kind == "a" else out.upper()
    if kind in ("i", "I") and 0 < n < 4000:
        out = ""
        for value, sign in zip((1000, 900, 500, 400, 100, 90, 50, 40, 10, 9, 5, 4, 1), "m cm d cd c xc l xl x ix v iv i".split()):
            out += sign * (n // value)
            n %= value
        return out if kind == "i" else out.upper()
    return str(n)


def placed(rows: list[tuple[int, list[tuple[list[str], int, int]]]]) -> list[list[tuple[int, list[str]]]]:
    """(column, lines) of the cells of each row; cells from above that span
    rows push the others on, within their row group."""
    plain = all(down == 1 for _, row in rows for _, _, down in row)
    until = np.zeros(0, np.int64)  # by column: the first row that is free again
    out: list[list[tuple[int, list[str]]]] = []
    group = None
    for r, (g, row) in enumerate(rows):
        if g != group:
            until, group = until[:0], g
        taken = np.flatnonzero(until > r).tolist() if not plain and len(until) else []
        taken.append(-1)  # none left
        k, col, here = 0, 0, []
        for lines, wide, down in row:
            while taken[k] == col:
                k, col = k + 1, col + 1
            here.append((col, lines))
            end = min(col + wide, max(col + 1, _COLUMNS))
            if not plain and down != 1 and end <= _COLUMNS:
                if end > len(until):
                    until = np.concatenate([until, np.zeros(end - len(until), np.int64)])
                until[col:end] = r + down if down else len(rows)
            col = end
            while 0 <= taken[k] < col:
                k += 1
        out.append(here)
    return out


def width(text: str) -> int:
    """Columns on a screen: wide characters take two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(0 if combining(c) else 2 if east_asian_width(c) in "WF" else 1 for c in text)


def aligned(rows: list[list[tuple[int, list[str]]]]) -> list[str]:
    """The rows as lines, cells in columns. Columns in which no cell begins are
    left out."""
    number = {c: i for i, c in enumerate(sorted({c for row in rows for c, _ in row}))}
    cells = [[(number[c], lines, [width(y) for y in lines]) for c, lines in row if lines] for row in rows]
    text = sum(sum(w) + 2 for row in cells for _, _, w in row)
    for most in (None, 80, 40, 20, 10):
        wide = [0] * len(number)
        for row in cells:
            for i, _, w in row:
                wide[i] = max(wide[i], *(x for x in w if most is None or x <= most), 0)
        start = [0]
        for w in wide:
            start.append(start[-1] + w + 2)
        # at most: up to the last cell of each row, for each of its lines
        if sum(max((start[i + 1] for i, _, _ in row), default=0) * max((len(y) for _, y, _ in row), default=0) for row in cells) <= _PADDING * text + 4096:
            break
    else:
        start = []
    out: list[str] = []
    for row in cells:
        for k in range(max((len(y) for _, y, _ in row), default=0)):
            line, at = [], 0
            for i, lines, w in row:
                if k < len(lines):
                    gap = max(start[i] - at if start else 0, 2 if at else 0)
                    line.append(" " * gap + lines[k])
                    at += gap + w[k]
            out.append("".join(line).rstrip())
    return out


def render(html: str) -> str:
    """The visible text of a page."""
    if not html:
        return ""
    root = parse(html)
    return "\n".join(Renderer(root).lines(root.inside))


def title(html: str) -> str | None:
    for node in _walk(parse(html)):
        if node.tag == "title":
            return _SPACE.sub(" ", "".join(x for x in node.inside if isinstance(x, str))).strip()
    return None


def rendered(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, the visible text, its code points and lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "html"):
            out = [render(h) for h in texts(b.column("html"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in out], pa.int64())],
                names=["page_id", "text", "n_chars", "n_lines"],
            )

    rows = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").cast("binary").alias("html"))
    return rows.mapInArrow(run, "page_id long, text string, n_chars long, n_lines long")
