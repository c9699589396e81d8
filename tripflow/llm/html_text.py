"""HTML extraction by layout.

A tree builder turns tags into a well-formed sequence of opened and closed
elements: void elements, elements whose end another start implies (head, p, li,
dt, dd, option, table parts), unknown and unmatched end tags, and the raw text of
script, style, textarea and title. Visibility rules (never rendered elements,
``hidden``, ``display: none``, ``visibility: hidden``) leave out what a reader
doesn't see; everything else is emitted: blocks on lines of their own with blank
lines where a page has margins, list markers with nesting, table cells in
aligned columns, preformatted text as it stands. Elements inside svg and math
are named apart from HTML's ("svg text"), up to where HTML begins again. An SVG
gives the text of its text elements where they stand in the source (what ``use``
repeats is not repeated), MathML its tokens, a drop-down the option that it
shows, a list box all options, a text area its text. The tree is walked as that
sequence with explicit stacks, so depth is no limit.

Defined results: NULL or empty html gives empty text; markup that is cut off
counts up to where it ends; one row in, one row out, whatever the ids; an empty
table gives an empty table; columns other than the id are not returned.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.words import pieces, text_buffer
from tripflow.session import ship_package

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Never rendered.
UNSEEN = frozenset("head script style title template noscript iframe object audio video canvas datalist noembed noframes meta link base".split()) | frozenset(
    [f"svg {x}" for x in "title desc metadata defs symbol clippath mask pattern marker lineargradient radialgradient filter style script".split()]
    + ["math annotation", "math annotation-xml"])
#: Elements of SVG and MathML that hold HTML.
HOLDS_HTML = frozenset(["svg foreignobject", "svg desc", "svg title", *(f"math {x}" for x in "mi mo mn ms mtext".split())])
#: Starts that end open SVG and MathML.
BREAKS = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: MathML whose parts stand apart, and of whose parts only the first shows.
APART = frozenset(f"math {x}" for x in "mfrac msub msup msubsup munder mover munderover mroot mmultiscripts mtable mtr mlabeledtr".split())
FIRST_SHOWS = frozenset({"math semantics", "math maction"})
#: An unquoted value at the end of a tag takes the slash in.
UNQUOTED = re.compile(r"=\s*+[^\s\"'][^\s\"']*/\Z")
#: Blank lines around a block.
MARGINS = dict.fromkeys("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset menu".split(), 1) | dict.fromkeys(
    "html body div section article aside header footer main nav address form li dt dd tr td th caption thead tbody tfoot figcaption details summary center legend option dir hgroup search".split(), 0)
_ITEMS = frozenset({"li"})
_PARTS = frozenset({"thead", "tbody", "tfoot"})
#: Open elements that a start tag ends, and what bounds the search for them.
IMPLIES = {
    "li": (_ITEMS, frozenset({"ul", "ol", "menu", "table"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl", "table"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl", "table"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select", "datalist"})),
    "td": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "th": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "tr": (frozenset({"tr", "td", "th", "caption"}), frozenset({"table"})),
} | dict.fromkeys(_PARTS, (_PARTS | {"tr", "td", "th", "caption", "colgroup"}, frozenset({"table"})))
#: Starts that leave a head open; any other start, or text, ends it.
IN_HEAD = frozenset("title meta link base script style noscript noframes template".split())
#: Starts of these end an open paragraph.
ENDS_P = frozenset(MARGINS) - frozenset("html body tr td th thead tbody tfoot caption option legend".split())

#: Elements whose inside is searched on its own for end tags and paragraphs.
SCOPES = frozenset({"table", "td", "th", "caption", "button", "object"}) | HOLDS_HTML
#: End tags that reach out of a scope, up to the table they belong to.
REACHING = SCOPES | _PARTS | {"tr"}

# Each alternative is possessive and ends at the end of the text at the latest,
# so a page is read once.
MARKUP = re.compile(
    r"<!--(?:(?!-?>).*?(?:--!?>|\Z)|-?>)|<[!?][^>]*+>?+|</(?![a-zA-Z])[^>]*+>?+"
    r"|<(/?)([a-zA-Z][^\s/>]*+)"
    r"((?:[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>]*+))?+|[\s/=]++)*+)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
HIDES = re.compile(r"display\s*:\s*none")
FADES = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)")
SPACE = re.compile(r"[ \t\n\f\r]+")
OPEN, CLOSE, TEXT = 1, 2, 3
#: Longer lines of a cell are broken between words; a longer word doesn't widen
#: its column.
WRAP = 72


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), html.unescape(value.strip("\"'") if value[:1] in "\"'" else value))
    return out


def tree(source: str) -> Iterator[tuple[int, str, dict]]:
    """The document as (what, name or text, attributes), each opened element
    closed in order."""
    stack: list[str] = []
    modes: list[str] = []  # svg or math, where an open element's inside is that
    foreign: dict[str, int] = {}  # open elements of SVG and MathML, by name
    count: list[dict[str, int]] = [{}]  # open elements by name, for each scope
    places: dict[str, list[int]] = {}  # where open elements are, by name
    scopes: list[int] = []  # where open scopes are

    def opened(name: str, mode: str = "") -> None:
        places.setdefault(name, []).append(len(stack))
        if name in SCOPES:
            scopes.append(len(stack))
        stack.append(name)
        modes.append(mode)
        if " " in name:
            own = name.partition(" ")[2]
            foreign[own] = foreign.get(own, 0) + 1
        count[-1][name] = count[-1].get(name, 0) + 1
        if name in SCOPES:
            count.append({})

    def close_to(k: int) -> Iterator[tuple[int, str, dict]]:
        while len(stack) > k:
            name = stack.pop()
            modes.pop()
            places[name].pop()
            if " " in name:
                foreign[name.partition(" ")[2]] -= 1
            if name in SCOPES:
                scopes.pop()
                count.pop()
            count[-1][name] -= 1
            yield CLOSE, name, {}

    def innermost(name: str) -> int:
        """Place of the element that an end tag closes, or -1: the last of its
        name, unless a table (for what reaches) or a scope was opened after it."""
        own = places.get(name)
        if not own:
            return -1
        wall = places.get("table") if name in REACHING else scopes
        return own[-1] if not wall or own[-1] >= wall[-1] else -1

    def outermost(names: frozenset, bounds: frozenset) -> int:
        """Place of the outermost of ``names`` this side of ``bounds``, or -1."""
        wall = max((own[-1] for b in bounds if (own := places.get(b))), default=-1)
        found = -1
        if names & REACHING or any(count[-1].get(n) for n in names):
            for n in names:
                own = places.get(n, ())
                k = bisect_right(own, wall)
                if k < len(own) and (found < 0 or own[k] < found):
                    found = own[k]
        return found

    def text(s: str) -> Iterator[tuple[int, str, dict]]:
        if stack and stack[-1] == "head" and s.strip(" \t\n\f\r"):
            yield from close_to(len(stack) - 1)
        yield TEXT, s, {}

    at = 0
    while at < len(source):
        m = MARKUP.search(source, at)
        if not m:
            yield from text(html.unescape(source[at:]))
            break
        if m.start() > at:
            yield from text(html.unescape(source[at: m.start()]))
        at = m.end()
        name = (m[2] or "").lower()
        mode = modes[-1] if modes else ""
        if not name:
            if mode and source.startswith("<![CDATA[", m.start()):
                end = source.find("]]>", m.start())
                yield TEXT, source[m.start() + 9: end if end >= 0 else len(source)], {}
                at = end + 3 if end >= 0 else len(source)
            continue
        if source[at - 1] != ">":  # cut off inside a tag
            continue
        if m[1]:
            k = len(stack) - 1 if foreign.get(name) else -1
            while k >= 0 and " " in stack[k] and stack[k].partition(" ")[2] != name:
                k -= 1
            if k >= 0 and " " in stack[k]:
                yield from close_to(k)
                continue
            if name == "br" and stack and stack[-1] == "head":
                yield from close_to(len(stack) - 1)
            if name in ("br", "p") and innermost(name) < 0:
                yield OPEN, name, {}
                yield CLOSE, name, {}
            elif (k := innermost(name)) >= 0:
                yield from close_to(k)
            continue
        if stack and stack[-1] == "head":
            if name in ("html", "head"):  # no second one inside
                continue
            if name not in IN_HEAD:
                yield from close_to(len(stack) - 1)
        attrs = attributes(m[3]) if m[3].strip(" /\t\n") else {}
        if mode and (name in BREAKS or (name == "font" and attrs.keys() & {"color", "face", "size"})):
            k = len(stack)
            while k and modes[k - 1]:
                k -= 1
            yield from close_to(k)
            mode = ""
        if mode or name in ("svg", "math"):
            mode = name if name == "svg" and stack and stack[-1] == "math annotation-xml" else mode or name
            name = f"{mode} {name}"
            yield OPEN, name, attrs
            if m[3].endswith("/") and not UNQUOTED.search(m[3]):
                yield CLOSE, name, {}
            else:
                html_inside = name == "math annotation-xml" and attrs.get("encoding", "").lower() in ("text/html", "application/xhtml+xml")
                opened(name, "" if html_inside or name in HOLDS_HTML else mode)
            continue
        if name in ENDS_P and count[-1].get("p") and (k := innermost("p")) >= 0:
            yield from close_to(k)
        if name in IMPLIES and (k := outermost(*IMPLIES[name])) >= 0:
            yield from close_to(k)
        yield OPEN, name, attrs
        if name in VOID:
            yield CLOSE, name, {}
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
            body = source[at: end.start() if end else len(source)]
            if name == "textarea":  # its first line break isn't part of it
                body = re.sub(r"\A\r?\n", "", body)
            yield TEXT, html.unescape(body) if name in ("textarea", "title") else body, {}
            yield CLOSE, name, {}
            at = end.end() if end else len(source)
        else:
            opened(name)
    yield from close_to(0)


class Flow:
    """Lines of one box: the page or a table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.gap = 0
        self.pending = False  # white space that shows only between words
        self.indent: list[str] = []
        self.marker = ""
        self.empty = True

    def text(self, s: str) -> None:
        words = SPACE.split(s)
        if len(words) == 1 and not words[0]:
            return
        body = " ".join(w for w in words if w)
        if not body:
            self.pending = True
            return
        if self.inline and (self.pending or not words[0]):
            self.inline.append(" ")
        self.inline.append(body)
        self.pending = not words[-1]

    def keep(self, s: str) -> None:
        """Preformatted text."""
        for k, line in enumerate(s.replace("\r\n", "\n").split("\n")):
            if k:
                self.end_line(always=True)
            if line:
                self.inline.append(line)

    def end_line(self, always: bool = False) -> None:
        body = "".join(self.inline).rstrip()
        self.inline, self.pending = [], False
        if body or (always and not self.empty):
            self.put(body)

    def put(self, body: str) -> None:
        if self.lines and self.gap:
            self.lines += [""] * self.gap
        self.gap, self.empty = 0, False
        lead = "".join(self.indent)
        if self.marker:
            lead = lead[: len(lead) - len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append((lead + body).rstrip())

    def block(self, margin: int) -> None:
        self.end_line()
        self.gap = max(self.gap, margin)


def wrapped(lines: list[str]) -> list[str]:
    """Long lines broken between words; what is laid out already stays."""
    out = []
    for line in lines:
        if len(line) <= WRAP or "  " in line.strip():
            out.append(line)
            continue
        lead = line[: len(line) - len(line.lstrip())]
        now = lead
        for word in line.split():
            if now != lead and len(now) + 1 + len(word) > WRAP:
                out.append(now)
                now = lead
            now += word if now == lead else " " + word
        out.append(now)
    return out


#: Lines of a cell, and the columns and rows that it spans.
Cell = tuple[list[str], int, int]


def aligned(rows: list[list[Cell]]) -> Iterator[str]:
    """Lines of a table: a cell starts where its column starts in every row; the
    columns that a cell of a row above still spans are left out."""
    widths: dict[int, int] = {}
    placed: list[list[tuple[int, list[str], int]]] = []
    taken: dict[int, int] = {}  # rows that a column is still spanned for
    for row in rows:
        column, own, now = 0, [], {}
        for lines, span, down in row:
            while taken.get(column, 0):
                column += 1
            lines = wrapped(lines)
            own.append((column, lines, span))
            if span == 1:
                widths[column] = max(widths.get(column, 0), *(len(x) for x in lines if len(x) <= WRAP), 0, 0)
            if down > 1:
                now |= dict.fromkeys(range(column, column + span), down)
            column += span
        taken = {c: n - 1 for c, n in (taken | now).items() if n > 1}
        placed.append(own)
    for row in placed:
        for k in range(max([len(lines) for _, lines, _ in row], default=0)):
            out, column, due = "", 0, 0
            for at, lines, span in row:
                due += sum(widths.get(c, 0) + 2 for c in range(column, at))
                column = at
                part = lines[k] if k < len(lines) else ""
                if part:
                    out = out.ljust(due) if len(out) < due or not out else out + "  "
                    out += part
                due += sum(widths.get(c, 0) + 2 for c in range(column, column + span))
                column += span
            yield out.rstrip()


def _count(value: str | None, otherwise: int) -> int:
    return int(value) if value and re.fullmatch(r"-?[0-9]{1,6}", value) else otherwise


class Select:
    """Options of one select: text, whether chosen, whether disabled."""

    def __init__(self, attrs: dict):
        self.all = "multiple" in attrs or _count(attrs.get("size"), 1) > 1
        self.options: list[tuple[str, bool, bool]] = []
        self.group_off = False

    def shown(self) -> list[str]:
        if self.all:
            return [text for text, _, _ in self.options]
        chosen = [text for text, on, _ in self.options if on][-1:]
        return chosen or [text for text, _, off in self.options if not off][:1]


def render(source: str) -> str:
    """All visible text of a page, laid out."""
    flows, hidden, faded, kept = [Flow()], 0, [False], 0
    lists: list[list] = []  # kind and number of each open list
    tables: list[list[list[Cell]]] = []
    cells: list[tuple[int, int]] = []
    selects: list[Select] = []
    options: list[dict] = []
    drawn = [True]  # does text show here? In an SVG only inside text elements
    parts = [0]  # elements so far in each open element
    folded, summed = [False], [False]  # closed details, with a summary so far?
    undo: list[tuple] = []
    for what, name, attrs in tree(source):
        flow = flows[-1]
        if what == TEXT:
            if not hidden and not faded[-1] and drawn[-1] and not folded[-1]:
                (flow.keep if kept else flow.text)(name)
            continue
        if what == OPEN:
            style = attrs.get("style", "").lower()
            dark = name in UNSEEN or "hidden" in attrs or bool(style and HIDES.search(style)) or (name == "dialog" and "open" not in attrs)
            if name == "option" and selects and not selects[-1].all:
                dark = False  # a closed drop-down shows its choice all the same
            around = undo[-1][0] if undo else ""
            if folded[-1]:  # of a closed details only its first summary shows
                dark = dark or name != "summary" or summed[-1]
                summed[-1] = summed[-1] or name == "summary"
            if " " in name:
                dark = dark or attrs.get("display") == "none" or (around in FIRST_SHOWS and parts[-1] > 0)
                drawn.append(name in ("svg text", "svg foreignobject") or (name != "svg svg" and drawn[-1]))
            else:
                drawn.append(drawn[-1])
            parts[-1] += 1
            parts.append(0)
            folded.append(name == "details" and "open" not in attrs)
            summed.append(False)
            undo.append((name, dark))
            hidden += dark
            fade = FADES.search(style) if style else None
            if not fade and " " in name:
                fade = FADES.search("visibility:" + ("hidden" if name == "math mphantom" else attrs.get("visibility", "")))
            faded.append(fade[1] != "visible" if fade else faded[-1])
            if hidden:
                continue
            if around in APART or name == "svg text" or (name == "svg tspan" and attrs.keys() & {"x", "y"}):
                flow.pending = True
            if name == "select":
                selects.append(Select(attrs))
                flows.append(Flow())  # what isn't in an option doesn't show
            elif name == "optgroup" and selects:
                selects[-1].group_off = "disabled" in attrs
            elif name == "option" and selects:
                options.append(attrs)
                flows.append(Flow())
            elif name == "textarea" or (name == "math math" and attrs.get("display") == "block"):
                flow.block(0)
                kept += name == "textarea"
            elif name == "svg foreignobject":
                flow.block(0)
            elif name == "br":
                flow.end_line(always=True)
            elif name == "hr":
                flow.block(1)
                flow.put("---")
            elif name == "table":
                flow.block(1)
                tables.append([])
            elif name == "tr" and tables:
                flow.end_line()
                tables[-1].append([])
            elif name in ("td", "th") and tables:
                if not tables[-1]:
                    tables[-1].append([])
                down = _count(attrs.get("rowspan"), 1)
                cells.append((max(1, min(1000, _count(attrs.get("colspan"), 1))), min(65534, down) if down > 0 else 1 if down < 0 else 65534))
                flows.append(Flow())
            elif name in MARGINS:
                flow.block(0 if name in ("ul", "ol", "menu") and lists else MARGINS[name])
            if name in ("ul", "ol", "menu"):
                lists.append([name, _count(attrs.get("start"), 1)])
            elif name == "li":
                kind = lists[-1] if lists else ["ul", 1]
                number = _count(attrs.get("value"), kind[1])
                kind[1] = number + 1
                flow.marker = f"{number}. " if kind[0] == "ol" else "- "
                flow.indent.append(" " * len(flow.marker))
            elif name in ("dd", "blockquote"):
                flow.indent.append("    ")
            elif name == "pre":
                kept += 1
            continue
        was, dark = undo.pop()
        faded.pop()
        drawn.pop()
        parts.pop()
        folded.pop()
        summed.pop()
        if hidden:
            hidden -= dark
            continue
        if name in APART or name == "svg text":
            flow.pending = True
        if name == "option" and selects:
            flow.end_line()
            flows.pop()
            of = options.pop()
            label = of.get("label") or " ".join(" ".join(flow.lines).split())
            selects[-1].options.append((label, "selected" in of, "disabled" in of or selects[-1].group_off))
        elif name == "optgroup" and selects:
            selects[-1].group_off = False
        elif name == "select":
            flows.pop()
            flow, box = flows[-1], selects.pop()
            for label in box.shown() if not faded[-1] else []:
                flow.block(0) if box.all else flow.text(" ")
                flow.text(label)
            flow.block(0) if box.all else flow.text(" ")
        elif name in ("textarea", "svg foreignobject"):
            kept -= name == "textarea"
            flow.block(0)
        elif name in ("td", "th") and tables and cells:
            flow.end_line()
            flows.pop()
            tables[-1][-1].append((flow.lines, *cells.pop()))
        elif name == "table" and tables:
            flow.end_line()
            rows = tables.pop()
            for line in aligned(rows):
                flow.put(line)
            flow.block(1)
        elif name in MARGINS and name != "hr":
            flow.block(0 if name in ("ul", "ol", "menu") and len(lists) > 1 else MARGINS[name])
        if name == "hr":
            flow.block(1)
        elif name in ("ul", "ol", "menu") and lists:
            lists.pop()
        elif name in ("li", "dd", "blockquote") and flow.indent:
            flow.indent.pop()
            flow.marker = ""
        elif name == "pre":
            kept -= 1
    flows[0].end_line()
    return "\n".join(flows[0].lines).strip("\n")


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id_col`` and ``text`` of every page."""
    ship_package(pages.sparkSession)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            _, offsets = text_buffer(batch.column(1))
            for lo, hi in pieces(offsets):
                texts = [render(x) if x else "" for x in batch.column(1).slice(lo, hi - lo).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(texts, pa.string())], names=["_id", "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    out = pages.select(F.col(id_col).alias("_id"), F.col(html_col).alias("_html"))
    return out.mapInArrow(run, f"_id {kind}, text string").withColumnRenamed("_id", id_col)
