"""Visible text of web pages, laid out as a reader sees it.

A page is read once. An open-element stack with the implied end tags of HTML gives
the tree; what rules hide is left out; blocks, paragraphs, lists, preformatted text
and tables write to the page or, within a table, to their cell. A table's cells are
padded to the width of their column.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from presswire.llm.common import table, text_slices, texts_of

TURN = 4 << 20
GAP = "  "  # between cells

_TAG = re.compile(r"<(?:!--(.*?)(?:--!?>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[!?/][^>]*>)", re.S)
_ATTR = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_BLANK = re.compile(r"[ \t\n\r\f]+")
_HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title iframe noembed noframes datalist object audio video canvas".split())
#: Hidden within a drawing or a formula only.
UNDRAWN = frozenset("desc metadata defs symbol clippath mask annotation annotation-xml mphantom".split())
#: What an open head may hold; any other start tag ends it.
HEADED = frozenset("head html base basefont bgsound link meta title style script noscript template noframes".split())
#: Elements of a formula whose parts stand apart.
APART = frozenset("mfrac mroot msub msup msubsup munder mover munderover mmultiscripts mtr mtable".split())
#: Start tags of HTML that end a drawing or a formula.
BREAKS = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strike strong sub sup table tt u ul var".split())
#: Where HTML goes on within a drawing or a formula.
INNER = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr menu".split())
BLOCK = SPACED | frozenset("html body address article aside center dd details dialog div dt figcaption footer form header legend li main nav section summary tr caption option optgroup".split())
CLOSES_P = BLOCK - frozenset("html body tr caption option optgroup legend".split())
#: What an opening tag ends, and where the search for it stops.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "input": ({"select"}, {"table", "td", "th"}),
    "textarea": ({"select"}, {"table", "td", "th"}),
    "select": ({"select"}, {"table", "td", "th"}),
}
#: Their end tags reach up to their table; those of others stay within a cell.
GRID = frozenset("table caption thead tbody tfoot tr td th".split())
#: End tags do not reach beyond these.
SCOPE = frozenset("table td th caption html".split())


class Sheet:
    """Lines under way: text runs, the gap before the next line, and its margin."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.run: list[str] = []
        self.gap = 0
        self.margin: list[str] = []
        self.bullet = ""

    def text(self, s: str) -> None:
        self.run.append(s)

    def end_line(self, gap: int = 0, forced: bool = False) -> None:
        line = _BLANK.sub(" ", "".join(self.run)).strip(" ")
        self.run.clear()
        if line or forced:
            self._put(line)
            self.gap = 0
        self.gap = max(self.gap, gap)

    def _put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        margin = "".join(self.margin)
        if self.bullet:
            margin = margin[: max(0, len(margin) - len(self.bullet))] + self.bullet
            self.bullet = ""
        self.lines.append((margin + line).rstrip(" "))

    def plain(self, lines: list[str]) -> None:
        """Lines kept as they are."""
        self.end_line()
        for line in lines:
            self._put(line)
            self.gap = 0

    def done(self) -> list[str]:
        self.end_line()
        return self.lines


def aligned(rows: list[list[tuple[list[str], int]]]) -> list[str]:
    """Rows of cells (lines, columns spanned) as lines with each column at one width."""
    width: dict[int, int] = {}
    for row in rows:
        at = 0
        for lines, span in row:
            if span == 1:
                width[at] = max(width.get(at, 0), max(map(len, lines), default=0))
            at += span
    out = []
    for row in rows:
        for k in range(max((len(lines) for lines, _ in row), default=0)):
            parts, at = [], 0
            for lines, span in row:
                line = lines[k] if k < len(lines) else ""
                room = sum(width.get(c, 0) for c in range(at, at + span)) + len(GAP) * (span - 1)
                parts.append(line.ljust(room))
                at += span
            out.append(GAP.join(parts).rstrip(" "))
    return out


class _Page:
    def __init__(self) -> None:
        self.open: list[tuple[str, bool]] = []  # tags, and whether each hides
        self.count: dict[str, int] = {}
        self.hidden = 0
        self.pre = 0
        self.sheets = [Sheet()]
        self.tables: list[list[list[tuple[list[str], int]]]] = []
        self.spans: list[int] = []
        self.lists: list[int | None] = []
        self.margins: list[int] = []
        self.selects: list[tuple[bool, list]] = []  # whether all options show, and (chosen, disabled, lines) of each
        self.options: list[tuple[bool, bool, str]] = []  # chosen, disabled, label of those open

    def drawn(self) -> bool:
        """Whether the next tag belongs to a drawing or a formula."""
        if self.count.get("svg") or self.count.get("math"):
            for tag, _ in reversed(self.open):
                if tag in ("svg", "math"):
                    return True
                if tag in INNER:
                    return False
        return False

    def start(self, tag: str, attrs: str) -> bool:
        """Open an element; False if it has no content."""
        if self.open and (tag == "html" or (tag == "head" and self.open[-1][0] != "html")):
            return False
        if tag not in HEADED and self.open and self.open[-1][0] == "head":
            self.close()
        drawn = self.drawn()
        if drawn and tag in BREAKS:
            self.upto({"svg", "math"}, set())
            drawn = self.drawn()
        if tag in CLOSES_P and self.count.get("p"):
            self.upto({"p"}, SCOPE)
        if tag in IMPLIED:
            ends, stop = IMPLIED[tag]
            while any(self.count.get(e) for e in ends) and self.upto(ends, stop):
                pass
        a = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)} if attrs.strip(" /\n\t") else {}
        hides = tag in UNSEEN or "hidden" in a or bool(_HIDING.search(a.get("style", ""))) or (drawn and tag in UNDRAWN)
        # A closed select shows its option even if the list hides it.
        option = tag == "option" and bool(self.selects) and not self.hidden
        if option and not self.selects[-1][0]:
            hides = False
        if tag in VOID:
            if not hides and not self.hidden:
                if tag == "br":
                    self.sheets[-1].end_line(forced=True)
                elif tag == "hr":
                    self.sheets[-1].end_line(1)
            return False
        if attrs.endswith("/") and (drawn or tag in ("svg", "math")):
            return False
        if drawn and not self.hidden and (tag == "text" or self.open[-1][0] in APART):
            self.sheets[-1].text(" ")
        self.open.append((tag, hides))
        self.count[tag] = self.count.get(tag, 0) + 1
        self.hidden += hides
        if self.hidden:
            return True
        sheet = self.sheets[-1]
        if option:
            self.options.append(("selected" in a, "disabled" in a, unescape(a.get("label", ""))))
            self.sheets.append(Sheet())
            return True
        if tag == "select":
            size = a.get("size", "1")
            self.selects.append(("multiple" in a or bool(re.fullmatch(r"0*(?:[2-9]|[1-9]\d+)", size)), []))
            self.sheets.append(Sheet())  # text outside its options is not shown
            return True
        if tag == "optgroup" and self.selects and self.selects[-1][0] and a.get("label"):
            self.selects[-1][1].append((False, True, [unescape(a["label"])]))
        if tag in BLOCK or tag == "textarea":
            sheet.end_line(1 if tag in SPACED and not (tag in ("ul", "ol", "menu") and self.lists) else 0)
        if tag in ("ul", "menu"):
            self.lists.append(None)
        elif tag == "ol":
            start = a.get("start", "1")
            self.lists.append(int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1)
        elif tag == "li":
            mark = "- "
            if self.lists and self.lists[-1] is not None:
                mark = f"{self.lists[-1]}. "
                self.lists[-1] += 1
            sheet.margin.append(" " * len(mark))
            sheet.bullet = mark
        elif tag in ("blockquote", "dd"):
            sheet.margin.append("    ")
        elif tag in ("pre", "textarea"):
            self.pre += 1
        elif tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables:
            if not self.tables[-1]:
                self.tables[-1].append([])
            span = a.get("colspan", "1")
            self.spans.append(min(1000, max(1, int(span))) if re.fullmatch(r"\d{1,6}", span) else 1)
            self.sheets.append(Sheet())
        return True

    def upto(self, tags: set | frozenset, stop: set | frozenset) -> bool:
        """Close the innermost of ``tags`` and what is open within, unless ``stop`` comes first."""
        for k in range(len(self.open) - 1, -1, -1):
            tag = self.open[k][0]
            if tag in tags:
                while len(self.open) > k:
                    self.close()
                return True
            if tag in stop:
                return False
        return False

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", "")
        elif tag in ("html", "body"):
            return  # what follows still belongs to the page
        elif self.count.get(tag):
            self.upto({tag}, ({"table"} if tag in GRID else SCOPE) - {tag})
        elif tag == "p":
            self.start("p", "")
            self.upto({"p"}, SCOPE)

    def close(self) -> None:
        tag, hides = self.open.pop()
        self.count[tag] -= 1
        seen = not self.hidden
        self.hidden -= hides
        if not seen:
            return
        sheet = self.sheets[-1]
        if tag == "option" and self.selects:
            chosen, disabled, label = self.options.pop()
            lines = self.sheets.pop().done()
            self.selects[-1][1].append((chosen, disabled, [label] if label.strip() else lines))
            return
        if tag == "select":
            self.sheets.pop()
            every, options = self.selects.pop()
            sheet = self.sheets[-1]
            if every:
                sheet.plain([line for _, _, lines in options for line in lines])
            else:
                shown = [o[2] for o in options if o[0]][-1:] or [o[2] for o in options if not o[1]][:1]
                for lines in shown:
                    sheet.text(" " + " ".join(lines) + " ")
            return
        if tag == "text" and self.count.get("svg"):
            sheet.text(" ")
        if tag in ("td", "th") and self.spans and len(self.sheets) > 1:
            self.sheets.pop()
            self.tables[-1][-1].append((sheet.done(), self.spans.pop()))
            return
        if tag == "table" and self.tables:
            sheet.plain(aligned([r for r in self.tables.pop() if r]))
        if tag in BLOCK:
            sheet.end_line(1 if tag in SPACED and not (tag in ("ul", "ol", "menu") and len(self.lists) > 1) else 0)
        if tag in ("ul", "ol", "menu") and self.lists:
            self.lists.pop()
        elif tag in ("li", "blockquote", "dd") and sheet.margin:
            sheet.margin.pop()
            if tag == "li":
                sheet.bullet = ""
        elif tag in ("pre", "textarea"):
            self.pre -= 1

    def data(self, s: str) -> None:
        top = self.open[-1][0] if self.open else ""
        if top == "head" and unescape(s).strip(" \t\n\r\f"):
            self.close()
        if self.hidden or not s:
            return
        s = unescape(s) if "&" in s else s
        if top in ("svg", "g", "math") and not s.strip(" \t\n\r\f"):
            return
        if not self.pre:
            self.sheets[-1].text(s)
            return
        sheet = self.sheets[-1]
        lines = s.expandtabs(8).replace("\r\n", "\n").split("\n")
        if len(lines) > 1 or s.strip():
            head = "".join(sheet.run)
            sheet.run.clear()
            lines[0] = head + lines[0]
            if not lines[0]:
                lines = lines[1:]
            if lines and not lines[-1].strip():
                lines = lines[:-1]
            for line in lines:
                sheet._put(line)
                sheet.gap = 0


def visible_text(html: str) -> str:
    """All text of a page that its own markup does not hide."""
    page = _Page()
    at = 0
    for m in iter(lambda: _TAG.search(html, at), None):
        if m.start() > at:
            page.data(html[at : m.start()])
        at = m.end()
        tag = m.group(3)
        if not tag:
            continue
        tag = tag.lower()
        if m.group(2):
            page.end(tag)
            continue
        if page.start(tag, m.group(4)) and tag in RAW:
            stop = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, at)
            upto = stop.start() if stop else len(html)
            page.data(html[at:upto])
            at = upto
    page.data(html[at:])
    while page.open:
        page.close()
    return "\n".join(page.sheets[0].done())


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` plus ``text``: the laid-out visible text of ``html``.

    Null or empty html gives empty text; broken markup is read as far as it goes,
    unclosed elements end with the page. Equal pages get equal texts. A column named
    ``text`` is replaced, others pass through.
    """
    pages = pages.drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, TURN, "html"):
            text = pa.array([visible_text(h) for h in texts_of(batch, "html")], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], [*batch.schema.names, "text"])

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField("text", T.StringType())]))


def op4_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of all ``pages``."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "html")).drop("html")
