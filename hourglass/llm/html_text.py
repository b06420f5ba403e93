"""Main text of web pages by smoothed text-to-tag ratios.

The standard library's parser streams a page's events.  Block tags cut the
page into lines; each line has its text, its number of tags and the element
that holds it.  The ratio of characters to tags per line is smoothed with a
Gaussian, lines at or above the standard deviation form the content clusters,
and a cluster then stands for the whole element around it, so that short
paragraphs and headings between long ones stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SIGMA, RADIUS = 1.0, 3

# HTML elements by role.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul head title script style noscript template".split()
)
NO_TEXT = frozenset(
    "head title script style noscript template iframe object svg canvas audio video map math select option textarea".split()
)
BOILERPLATE = frozenset("nav header footer aside form menu dialog button search".split())
HOLDERS = frozenset("article main section div td body".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in class and id, and roles, of what is not the article.
NAMES = frozenset(
    "ad ads advert advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer header masthead comment comments disqus cookie cookies consent notice gdpr newsletter "
    "subscribe signup related share sharing social popup modal pagination pager widget skip".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
# Elements whose end tag may be left out, by the start tags that end them, and where the search for them stops.
_CELLS = frozenset("td th caption".split())
_ROWS = _CELLS | {"tr"}
_PARTS = _ROWS | {"tbody", "thead", "tfoot"}
_ITEM = frozenset("dt dd".split())
ENDS = {
    "li": frozenset(["li"]),
    **dict.fromkeys(_ITEM, _ITEM),
    "option": frozenset(["option"]),
    "optgroup": frozenset("option optgroup".split()),
    **dict.fromkeys(("td", "th"), _CELLS),
    "tr": _ROWS,
    **dict.fromkeys(("caption", "tbody", "thead", "tfoot"), _PARTS),
}
ENDS_P = BLOCKS - set("body caption head html legend optgroup option tbody td tfoot th thead title tr script style noscript template".split())
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
#: Blocks and datalist are always on the stack, so that their end ends what is left open in them.
KEPT = (BLOCKS | {"datalist"}) - {"hr", "html"}
# Where the search for an open element stops: what has no text is closed to the outside.
_OPAQUE = NO_TEXT - {"option"}
_TABLE = _OPAQUE | {"table"}
_SCOPE = _TABLE | set("button caption td th".split())
#: By start tag; li, dt, dd and options are not looked for outside other blocks.
START_STOPS = {t: _TABLE if t in _PARTS else _OPAQUE | KEPT - ends - set("address div p".split()) for t, ends in ENDS.items()}
#: By end tag; those that are not here end their element however far out it is.
END_STOPS = {t: _SCOPE for t in KEPT - _OPAQUE - BOILERPLATE - HOLDERS}
END_STOPS |= {t: _TABLE for t in _PARTS - HOLDERS} | {"table": _OPAQUE, "li": _SCOPE | {"ol", "ul", "menu"}}
_NAME = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")


#: tag, silent, dropped, innermost holder, outermost article (or main) around.
_PAGE = ("", False, False, 0, 0)


class _Lines(HTMLParser):
    """Collects lines as (text, tags, holder, in an article or main, dropped)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool]] = []
        self.open: list[tuple[str, bool, bool, int, int]] = []
        self.parts: list[str] = []
        self.tags = 0
        self.holders = 0
        self.articles = 0  # open article elements
        self.top = _PAGE

    def cut(self) -> None:
        """Ends the current line."""
        if self.parts or self.tags:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text or self.tags:
                _, _, dropped, holder, article = self.top
                self.lines.append((text, self.tags, -1 if dropped else article or holder, article > 0))
            self.parts, self.tags = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.cut()
        self.end_implied(tag)
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        marked = bool(attrs) and tag not in ("html", "body", "main") and self.marked(attrs)
        if tag in VOID or not (marked or tag in KEPT or tag in NO_TEXT or tag in BOILERPLATE):
            return
        _, silent, dropped, holder, article = self.top
        silent = silent or tag in NO_TEXT or marked and tag not in BLOCKS
        dropped = dropped or tag in BOILERPLATE or marked
        if tag in HOLDERS:
            self.holders += 1
            holder = self.holders
            if not dropped and (tag == "article" and not self.articles or tag == "main" and not article):
                article = holder
            self.articles += tag == "article"
        self.top = (tag, silent, dropped, holder, article)
        self.open.append(self.top)

    @staticmethod
    def marked(attrs: list[tuple[str, str | None]]) -> bool:
        for key, value in attrs:
            value = (value or "").lower()
            if key in ("class", "id") and not NAMES.isdisjoint(_NAME.findall(value)):
                return True
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in ROLES:
                return True
            if key == "style" and "display:none" in value.replace(" ", ""):
                return True
        return False

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.cut()
        stops = END_STOPS.get(tag, ())
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                return self.end(k)
            if self.open[k][0] in stops:
                return

    def end(self, k: int) -> None:
        """Ends the open elements from place ``k`` on."""
        self.articles -= sum(x[0] == "article" for x in self.open[k:])
        del self.open[k:]
        self.top = self.open[-1] if self.open else _PAGE

    def end_head(self) -> None:
        """Ends a head whose end tag is left out."""
        self.cut()
        self.end(len(self.open) - 1)

    def end_implied(self, tag: str) -> None:
        """Ends the elements without an end tag that the start of ``tag`` ends."""
        if self.top[0] == "head" and tag not in IN_HEAD:
            self.end_head()
        ends, at = ENDS.get(tag), None
        if ends:
            stops = START_STOPS[tag]
            for k in range(len(self.open) - 1, -1, -1):
                name = self.open[k][0]
                if name in ends:
                    at = k
                    if name in ("li", "dt", "dd"):
                        break
                elif name in stops:
                    break
            if at is not None:
                self.end(at)
        if tag in ENDS_P:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == "p":
                    return self.end(k)
                if self.open[k][0] in _SCOPE:
                    return

    def handle_data(self, data: str) -> None:
        if self.top[0] == "head" and not data.isspace():
            self.end_head()
        if not self.top[1]:
            self.parts.append(data)


def smoothed(ratios: np.ndarray, sigma: float = SIGMA, radius: int = RADIUS) -> np.ndarray:
    """Gaussian smoothing; at the ends the kernel is cut, not the values."""
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")[radius : radius + len(ratios)]
    return np.convolve(ratios, kernel, "full")[radius : radius + len(ratios)] / weight


def main_text(html: str | None) -> str:
    """The article's blocks, white space collapsed, joined by one line feed.

    Null, empty or text-free pages give "".  Truncated and misnested markup is
    read as far as it goes; nothing is dropped for its length.
    """
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.close()
    page.cut()
    lines = page.lines
    articles = any(text and inside and holder >= 0 for text, _, holder, inside in lines)
    able = np.array([bool(x[0]) and x[2] >= 0 and (x[3] or not articles) for x in lines], bool)
    if not able.any():
        return ""
    ratios = np.array([len(x[0]) / max(x[1], 1) for x in lines]) * able
    curve = smoothed(ratios)
    content = able & (curve >= curve.std())
    if not content.any():
        content = able & (curve >= curve[able].max())
    chosen = {lines[i][2] for i in np.flatnonzero(content)}
    return "\n".join(lines[i][0] for i in np.flatnonzero(able) if lines[i][2] in chosen)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; ids and urls as they are
    (null too), repeated rows as often as they come, other columns not read."""
    rows = pages.select(id_col, url_col, html_col)
    ids, urls = rows.schema[0].dataType, rows.schema[1].dataType
    schema = T.StructType(
        [T.StructField("page_id", ids), T.StructField("url", urls), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            sizes = pa.array([len(x) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, schema)
