"""Text of HTML pages as a browser lays it out.

Tags open and close elements on a stack, with the end and start tags that HTML implies (a
paragraph ends where a block begins, an item where the next one does, a cell belongs to
a row). Elements that are not laid out are left out with all they hold: head, scripts, styles,
templates, embedded media, a dialog that is not open, the hidden attribute (unless the style says another
``display``) and ``display:none``. ``visibility`` is inherited: what is hidden or collapsed gives no
text, but what is visible again inside it does. Style attributes are read declaration by declaration, names
compared as a whole, the last one counts. No script is run, so noscript is shown; what a closed
details element holds is shown too, as a reader can open it.
All other text is emitted: blocks on lines of their own, paragraphs, headings, lists and
tables with a blank line around them, list items with a bullet or number and their depth's
indent, preformatted text as it stands, and table cells in aligned columns.

Defined results: null gives null, an empty page the empty text; text outside any tag, unclosed
and stray tags are taken as browsers do; a broken tag at the end is dropped. Cells longer
than ``WIDEST`` are not padded to; a cell that spans rows keeps its columns taken to the end of
its row group at most, up to column ``MOST_COLUMNS``; containers nested deeper than ``DEEPEST`` are
plain blocks; none of these loses text. Repeated rows give equal texts.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from html import unescape

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WIDEST, DEEPEST = 60, 40
MOST_COLUMNS = 10_000

# a quote opens a quoted run directly after = only, elsewhere it is part of a name or value
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+)*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.S
)
ATTR = re.compile(r"([^\s/>][^\s/>=]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
BLANK = re.compile(r"[ \t\n\r\f]+")
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)

# Element kinds of HTML.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title script style template noembed noframes iframe object audio video canvas datalist".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
IN_HEAD = frozenset("title meta link script style base noscript template".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure fieldset hr menu".split())
BLOCK = SPACED | frozenset(
    "address article aside body center dd details dialog dir div dt figcaption footer form header hgroup html legend li main nav "
    "optgroup option search section summary caption".split()
)
ENDS_P = BLOCK - frozenset("body html dd dt li legend option optgroup caption".split()) | frozenset(("li", "dd", "dt"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
LISTS = frozenset(("ul", "ol", "menu", "dir"))
CELLS, SECTIONS = frozenset(("td", "th")), frozenset(("thead", "tbody", "tfoot"))
BARRIER = frozenset(("td", "th", "table", "caption", "html"))
P_BARRIER = BARRIER | {"button"}
# a start tag ends open elements of the second set, up to one of the third
IMPLIED = {
    "li": (frozenset(("li",)), LISTS | BARRIER), "dt": (frozenset(("dt", "dd")), BARRIER | {"dl"}), "dd": (frozenset(("dt", "dd")), BARRIER | {"dl"}),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))), "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "td": (CELLS | {"caption"}, frozenset(("tr", "table"))), "th": (CELLS | {"caption"}, frozenset(("tr", "table"))),
    "tr": (CELLS | {"tr", "caption", "colgroup"}, frozenset(("table",))),
    "thead": (CELLS | SECTIONS | {"tr", "caption", "colgroup"}, frozenset(("table",))),
    "tbody": (CELLS | SECTIONS | {"tr", "caption", "colgroup"}, frozenset(("table",))),
    "tfoot": (CELLS | SECTIONS | {"tr", "caption", "colgroup"}, frozenset(("table",))),
}


class Flow:
    """Lines of one block container (the page, an item, a cell)."""

    __slots__ = ("gap", "line", "lines", "spaced")

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0  # line ends asked for before what comes next
        self.spaced = True  # a blank now would be at a line's start or after another

    def text(self, s: str) -> None:
        """Inline text whose runs of blanks count as one."""
        if s[:1] in " \t\n\r\f" or s[-1:] in " \t\n\r\f" or "\n" in s or "  " in s or "\t" in s or "\r" in s or "\f" in s:
            s = BLANK.sub(" ", s)
            if self.spaced and s[:1] == " ":
                s = s[1:]
        if s:
            self._open()
            self.line.append(s)
            self.spaced = s[-1] == " "

    def exact(self, s: str) -> None:
        """Preformatted text."""
        first, *more = s.split("\n")
        if first:
            self._open()
            self.line.append(first)
        for x in more:
            self._open()
            self._end()
            self.line.append(x)
        self.spaced = not self.line or not "".join(self.line[-1:])

    def _open(self) -> None:
        if self.gap:
            if self.lines and self.gap > 1:
                self.lines.append("")
            self.gap = 0

    def _end(self) -> None:
        self.lines.append("".join(self.line).rstrip(" "))
        self.line, self.spaced = [], True

    def broken(self) -> None:
        """A forced line end."""
        self._open()
        self._end()

    def block(self, ends: int) -> None:
        """A block's edge: what follows begins a line, after a blank line if ``ends`` is 2."""
        if "".join(self.line).strip(" "):
            self._end()
        else:
            self.line, self.spaced = [], True
        self.gap = max(self.gap, ends)

    def put(self, lines: list[str], ends: int) -> None:
        """Finished lines as a block of their own."""
        if lines:
            self.block(ends)
            self._open()
            self.lines += lines
            self.gap = ends

    def done(self) -> list[str]:
        self.block(1)
        while self.lines and not self.lines[-1].strip():
            self.lines.pop()
        start = 0
        while start < len(self.lines) and not self.lines[start].strip():
            start += 1
        return self.lines[start:]


class Element:
    __slots__ = ("down", "flow", "groups", "hidden", "mark", "number", "rows", "tag", "visible")

    def __init__(self, tag: str, hidden: bool, visible: bool):
        self.tag, self.hidden, self.visible = tag, hidden, visible
        self.flow: Flow | None = None  # set where the element collects lines of its own
        self.mark = ""
        self.number: int | None = None  # of an ordered list's next item; columns of a cell
        self.down = 1  # rows of a cell, 0 for all that follow
        self.rows: list[list[tuple[list[str], int, int]]] | None = None  # of a table
        self.groups: set[int] = set()  # the table's rows that begin a row group


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in ATTR.findall(source):
        out.setdefault(name.lower(), unescape(value[1:-1] if value[:1] in "\"'" else value) if value else "")
    return out


def declarations(style: str) -> dict[str, str]:
    """Names and values of a style attribute, lower-case; of repeated names the last (a more important one stays)."""
    out: dict[str, str] = {}
    weight: dict[str, bool] = {}
    for part in COMMENT.sub(" ", style).split(";"):
        name, colon, value = part.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        head, mark, _ = value.partition("!")
        important = bool(mark) and value[len(head) + 1 :].strip() == "important"
        if colon and not (weight.get(name) and not important):
            out[name], weight[name] = head.strip(), important
    return out


def shown(attrs: str, tag: str) -> tuple[bool, bool | None]:
    """Whether an element with these attributes is laid out, and whether they make its text visible (None: as around it)."""
    low = attrs.lower()
    if tag != "dialog" and not ("hidden" in low or "style" in low):
        return True, None
    a = attributes(attrs)
    own = declarations(a.get("style", ""))
    laid = (a.get("hidden", "until-found").lower() == "until-found") and (tag != "dialog" or "open" in a)
    if "display" in own:
        laid = own["display"] != "none"
    seen = own.get("visibility")
    return laid, True if seen in ("visible", "initial") else False if seen in ("hidden", "collapse") else None


def _whole(value: str | None, default: int, most: int = 10_000) -> int:
    m = re.match(r"\s*(-?\d{1,9})", value or "")
    return min(int(m[1]), most) if m else default


def placed(rows: list[list[tuple[list[str], int, int]]], groups: set[int]) -> list[list[tuple[list[str], int]]]:
    """Rows of cells (lines, columns), with an empty cell for each column that a cell above takes."""
    out = []
    taken: dict[int, int] = {}  # column: the last row that it is taken in
    for r, row in enumerate(rows):
        if r in groups:
            taken = {}
        own, at = [], 0
        for lines, span, down in row:
            while taken.get(at, -1) >= r:
                own.append(([], 1))
                at += 1
            own.append((lines, span))
            if down != 1:
                for c in range(at, min(at + span, MOST_COLUMNS)):
                    taken[c] = max(taken.get(c, -1), r + down - 1 if down else len(rows))
            at += span
        out.append(own)
    return out


def aligned(rows: list[list[tuple[list[str], int]]]) -> list[str]:
    """Lines of a table: each column is as wide as its widest cell that takes one column, up to ``WIDEST``."""
    width: dict[int, int] = {}
    for row in rows:
        at = 0
        for lines, span in row:
            if span == 1:
                widest = max(map(len, lines), default=0)
                width[at] = max(width.get(at, 0), widest if widest <= WIDEST else 0)
            at += span
    out = []
    for row in rows:
        for k in range(max((len(lines) for lines, _ in row), default=0)):
            parts, at = [], 0
            for lines, span in row:
                room = sum(width.get(c, 0) for c in range(at, min(at + span, len(width)))) + 2 * (span - 1) if span < 1000 else 0
                parts.append((lines[k] if k < len(lines) else "").ljust(room))
                at += span
            out.append("  ".join(parts).rstrip())
    return [x for x in out if x]


class Page:
    """The stack of open elements and the lines that they have emitted."""

    def __init__(self):
        self.flows = [Flow()]
        self.open: list[Element] = []
        self.hidden = 0
        self.pre = 0
        self.at: dict[str, list[int]] = {}  # where elements of a kind stand on the stack
        self.tables: list[Element] = []  # open tables that collect rows

    def has(self, tag: str) -> bool:
        return bool(self.at.get(tag))

    def last(self, tags) -> int:
        """Where the innermost open element of these kinds stands; -1 without any."""
        at = self.at
        return max((at[t][-1] for t in tags if at.get(t)), default=-1)

    def _push(self, tag: str, attrs: str) -> None:
        hidden, visible = tag in UNSEEN, not self.open or self.open[-1].visible
        if not hidden and (attrs or tag == "dialog"):
            laid, own = shown(attrs, tag)
            hidden, visible = not laid, visible if own is None else own
        e = Element(tag, hidden, visible)
        self.at.setdefault(tag, []).append(len(self.open))
        self.open.append(e)
        self.hidden += hidden
        if tag == "pre" or tag == "textarea":
            self.pre += 1
        if self.hidden:
            return
        if tag in SECTIONS:
            self._group()
        flow = self.flows[-1]
        nested = sum(len(self.at.get(t, ())) for t in LISTS) > 1
        if tag in LISTS:
            flow.block(1 if nested else 2)
            if tag == "ol":
                e.number = _whole(attributes(attrs).get("start"), 1) if attrs else 1
        elif tag in BLOCK:
            flow.block(2 if tag in SPACED else 1)
        if len(self.flows) > DEEPEST:
            return
        if tag == "li":
            holder = self.last(LISTS)
            owner = self.open[holder] if holder >= 0 else None
            if owner is not None and owner.number is not None:
                owner.number = _whole(attributes(attrs).get("value"), owner.number) if attrs else owner.number
                e.mark = f"{owner.number}. "
                owner.number += 1
            else:
                e.mark = "- "
            e.flow = Flow()
        elif tag == "blockquote" or tag == "dd":
            e.mark, e.flow = "  ", Flow()
        elif tag == "table":
            e.rows, e.flow = [], Flow()  # the flow takes text that stands between cells
            self.tables.append(e)
        elif tag in CELLS:
            e.flow = Flow()
            a = attributes(attrs) if attrs else {}
            e.number, e.down = max(1, _whole(a.get("colspan"), 1, 1000)), _whole(a.get("rowspan"), 1, 65534)
            e.down = e.down if e.down >= 0 else 1
        if e.flow is not None:
            self.flows.append(e.flow)

    def _group(self) -> None:
        """The table's next row begins a row group."""
        if self.tables:
            self.tables[-1].groups.add(len(self.tables[-1].rows))

    def _pop(self) -> None:
        e = self.open.pop()
        self.at[e.tag].pop()
        if e.rows is not None:
            self.tables.pop()
        if e.tag == "pre" or e.tag == "textarea":
            self.pre -= 1
        laid = not self.hidden
        self.hidden -= e.hidden
        if not laid:
            return
        if e.tag in SECTIONS:
            self._group()
        if e.flow is not None:
            lines = self.flows.pop().done()
            out = self.flows[-1]
            if e.tag in CELLS:
                if not self.tables:
                    out.put(lines, 1)
                else:
                    rows = self.tables[-1].rows
                    if not rows:
                        rows.append([])
                    rows[-1].append((lines, e.number or 1, e.down))
            elif e.rows is not None:
                body = aligned(placed(e.rows, e.groups))
                out.put(lines + ([""] if lines and body else []) + body, 2)
            elif lines:
                pad = " " * len(e.mark)
                out.put([(e.mark if i == 0 else pad) + x if x else x for i, x in enumerate(lines)], 2 if e.tag == "blockquote" else 1)
            elif e.tag == "li":
                out.put([e.mark.rstrip()], 1)
            if e.tag != "li" and e.tag not in CELLS and e.tag != "dd":
                out.block(2)
        elif e.tag in LISTS:
            self.flows[-1].block(1 if self.last(LISTS) >= 0 else 2)
        elif e.tag in BLOCK:
            self.flows[-1].block(2 if e.tag in SPACED else 1)
        elif e.tag in CELLS:
            self.flows[-1].text(" ")

    def _close_to(self, i: int) -> None:
        while len(self.open) > i:
            self._pop()

    def start(self, tag: str, attrs: str) -> None:
        if tag == "body" or tag == "html":
            if self.has("head"):
                self.end("head")
            if self.has(tag):
                return
        if self.has("head") and tag not in IN_HEAD and tag != "head":
            self.end("head")
        if tag in ENDS_P and self.has("p"):
            at = self.at["p"][-1]
            if at > self.last(P_BARRIER):
                self._close_to(at)
        if tag in HEADINGS and self.open and self.open[-1].tag in HEADINGS:
            self._pop()
        rule = IMPLIED.get(tag)
        if rule is not None:
            ends, until = rule
            edge = self.last(until)
            places = (self.at.get(t, ()) for t in ends)
            lowest = min((own[bisect_right(own, edge)] for own in places if own and own[-1] > edge), default=None)
            if lowest is not None:
                self._close_to(lowest)
        if tag in CELLS and self.has("table") and self.last(("table",)) > self.last(("tr",)):
            self.start("tr", "")
        if tag == "tr" and self.has("table"):
            table = self.open[self.at["table"][-1]]
            if table.rows is not None and not self.hidden:
                table.rows.append([])
        if tag in VOID:
            if not self.hidden:
                if tag == "br":
                    self.flows[-1].broken()
                elif tag == "hr":
                    self.flows[-1].block(2)
            return
        self._push(tag, attrs)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", "")
            return
        if tag in ("body", "html"):
            return
        if not self.has(tag):
            if tag == "p" and not self.hidden:
                self.flows[-1].block(2)
            return
        scoped = tag not in ("td", "th", "tr", "table", "caption") and tag not in SECTIONS
        at = self.last(HEADINGS if tag in HEADINGS else (tag,))
        if at >= self.last(BARRIER if scoped else ("table",)):
            self._close_to(at)

    def text(self, s: str) -> None:
        if not s or self.hidden or (self.open and not self.open[-1].visible):
            return
        if "&" in s:
            s = unescape(s)
        if self.pre:
            self.flows[-1].exact(s.replace("\r\n", "\n"))
        else:
            self.flows[-1].text(s)


def rendered(html: str | None) -> str | None:
    """The visible text of a page."""
    if html is None:
        return None
    page, at, n = Page(), 0, len(html)
    while at < n:
        m = TOKEN.search(html, at)
        if m is None:
            page.text(html[at:])
            break
        if m.start() > at:
            page.text(html[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            page.end(tag)
            continue
        if at == n and html[-1] != ">":
            break  # a tag that the page's end cuts off
        page.start(tag, m[3])
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            stop = end.start() if end else n
            page.text(html[at:stop])
            at = stop
        elif tag == "pre" and html.startswith("\n", at):
            at += 1
    page._close_to(0)
    return "\n".join(page.flows[0].done())


def visible_text(html: Column) -> Column:
    """The rendered text of an HTML column; tasks work page by page."""

    @F.pandas_udf("string")
    def render(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: rendered(p) if isinstance(p, str) else None)

    return render.asNondeterministic()(html)
