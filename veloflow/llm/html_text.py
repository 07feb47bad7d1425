"""Main text of web pages: parser events, text-to-tag ratio of each line, Gaussian smoothing, threshold clustering.

Pages often come as one physical line, so a line here is what stands between two block tags. Scripts and the like have no
lines. Elements that markup or a name declares to be no content are doubted: their lines take part in the smoothing, and an
element that turns out to hold most of the smoothed text is a wrapper, so its doubt is lifted ("content-sidebar-wrap", a form
around the page). Articles count twice against other regions, and the smoothed ratios choose among the regions left. All lines
of a chosen region stay, short ones too.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SIGMA = 1.0

BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never text of the page.
UNSEEN = frozenset("applet audio button canvas datalist embed head iframe label map noframes noscript object option output script select style svg template textarea title video".split())
#: No content, whatever they hold.
BESIDES = frozenset("aside dialog footer menu nav".split())
#: No content unless they hold most of the page.
DOUBTED = frozenset("form header".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
REGIONS = frozenset("article main section div td body".split())
#: Names in class and id that mark what is no content, as whole parts of the name. The first are believed in any case.
NO_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disclaimer discussion disqus gdpr newsletter related recommended replies reply respond sponsor sponsored".split()
)
NAMES = NO_NAMES | frozenset(
    "banner dialog footer header login masthead menu modal nav navbar navigation notice notices notification overlay pager pagination popup promo promoted promotion recommendation search share sharing sidebar sidenav signup skip social subscribe teaser toolbar topbar widget".split()
)
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Next to these a name says what the element is with or without ("with-sidebar"), not what it is.
BESIDE = frozenset("has no not with without".split())
#: On these a name is about the page as a whole, unless it says comment or advert.
WHOLE = frozenset("html body main article".split())
ON_WHOLE = frozenset("ad ads advert advertisement comment comments reply sponsored promo related teaser".split())
#: Characters from which a line counts as running text.
RUNNING = 80
#: Smoothed text of articles counts this much against that of other regions.
ARTICLE_WEIGHT = 2


class Line(NamedTuple):
    text: str
    tags: int
    linked: int  # characters in links
    region: int
    in_article: bool
    doubt: int

    def links(self) -> bool:
        return not self.in_article and self.linked * 2 >= len(self.text)


class Open(NamedTuple):
    tag: str
    unseen: bool
    doubted: bool
    in_header: bool


class Lines(HTMLParser):
    """Collects lines. Every tag costs a bounded number of steps and one step when it is closed, however deep the page is."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[Open] = []
        self.count: Counter[str] = Counter()  # open elements by tag
        self.unseen = self.tags = self.linked = 0
        self.regions: list[tuple[int, bool]] = [(0, False)]
        self.made = 0
        self.doubts: list[int] = [0]
        self.outer: list[int] = [0]  # of each doubted element, the one around it; 0 is the page
        self.believed: list[bool] = [False]
        self.headers: list[int] = []  # open headings within each open header of an article
        self.parts: list[str] = []
        self.lines: list[Line] = []

    def line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(Line(text, max(self.tags, 1), self.linked, *self.regions[-1], self.doubts[-1]))
        self.parts, self.tags, self.linked = [], 0, 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body" or (tag not in IN_HEAD and self.count["head"]):
            self.close_to("head")
        if tag in BLOCKS:
            self.line()
            if self.open and self.open[-1].tag == "p":
                self.close_to("p")
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        in_article = self.regions[-1][1]
        doubt = self.doubt(tag, attrs)
        unseen = doubt is not None and (doubt == "unseen" or tag not in BLOCKS)
        doubted = doubt is not None and not unseen
        in_header = tag == "header" and in_article  # the article's own title; what else is in it is dropped line by line
        self.open.append(Open(tag, unseen, doubted, in_header))
        self.count[tag] += 1
        self.unseen += unseen
        if doubted:
            self.outer.append(self.doubts[-1])
            self.believed.append(doubt == "believed")
            self.doubts.append(len(self.outer) - 1)
        if in_header:
            self.headers.append(0)
        elif tag in HEADINGS and self.headers:
            self.headers[-1] += 1
        if tag in REGIONS:
            self.made += 1
            self.regions.append((self.regions[-1][0] if in_article else self.made, in_article or tag in ("article", "main")))

    def doubt(self, tag: str, attrs: list[tuple[str, str | None]]) -> str | None:
        """``unseen``, ``believed`` to be no content, ``doubted``, or None."""
        if tag in UNSEEN:
            return "unseen"
        given = dict(attrs)
        if "hidden" in given or given.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", given.get("style") or ""):
            return "unseen"
        if tag in BESIDES or (given.get("role") or "").lower() in ROLES:
            return "believed"
        found = None
        if tag in DOUBTED and not (tag == "header" and self.regions[-1][1]):
            found = "doubted"
        if tag in HEADINGS or not attrs or (tag == "header" and found is None):
            return found
        for name in f"{given.get('class') or ''} {given.get('id') or ''}".split():
            parts = set(re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()))
            if parts & BESIDE:
                continue
            if parts & (ON_WHOLE if tag in WHOLE else NO_NAMES):
                return "believed"
            if tag not in WHOLE and parts & NAMES:
                found = "doubted"
        return found

    def close_to(self, tag: str) -> None:
        """Close the innermost open ``tag`` and all that is open within it; nothing if there is none."""
        if not self.count[tag]:
            return
        while True:
            e = self.open.pop()
            self.count[e.tag] -= 1
            self.unseen -= e.unseen
            if e.doubted:
                self.doubts.pop()
            if e.in_header:
                self.headers.pop()
            elif e.tag in HEADINGS and self.headers:
                self.headers[-1] -= 1
            if e.tag in REGIONS:
                self.regions.pop()
            if e.tag == tag:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.line()
        self.tags += 1
        self.close_to(tag)

    def handle_data(self, data: str) -> None:
        if self.unseen or (self.headers and not self.headers[-1]):
            return
        self.parts.append(data)
        if self.count["a"]:
            self.linked += len(data.strip())


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; at the ends the weights within the page count."""
    reach = math.ceil(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weights = np.convolve(np.ones(len(ratios)), kernel, "full")[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel, "full")[reach : reach + len(ratios)] / weights


def left_out(parser: Lines, weights: np.ndarray) -> list[bool]:
    """Of each doubted element whether it stays out.

    The doubt of one not believed in any case is lifted if it holds more than half of the smoothed text that is not in
    believed ones, at least half of that in articles, and an article's text or two lines of running text.
    """
    n = len(parser.outer)
    out = [False] * n
    for d in range(1, n):
        out[d] = parser.believed[d] or out[parser.outer[d]]
    held, articles, running = np.zeros(n), np.zeros(n), np.zeros(n)
    for line, weight in zip(parser.lines, weights, strict=True):
        if not out[line.doubt] and not line.links():
            held[line.doubt] += weight
            articles[line.doubt] += weight * line.in_article
            running[line.doubt] += len(line.text) >= RUNNING
    for d in range(n - 1, 0, -1):  # an element comes before those in it
        for sums in (held, articles, running):
            sums[parser.outer[d]] += sums[d]
    for d in range(1, n):
        wrapper = held[d] * 2 > held[0] and articles[d] * 2 >= articles[0] and (articles[d] > 0 or running[d] >= 2)
        out[d] = parser.believed[d] or out[parser.outer[d]] or not wrapper
    return out


def main_text(html: str) -> str:
    """Lines of the chosen regions, white space within a line as one space, lines joined by an empty line.

    Where the articles' smoothed text, counted twice, is at least that of the other regions, only articles are considered.
    A region is chosen when one of its lines has a smoothed ratio of at least the threshold: the deviation of the smoothed
    ratios, or half the largest if that is less, so that some region is always chosen. Lines that are mostly links are
    dropped outside articles.
    """
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.line()
    if not parser.lines:
        return ""
    ratios = smoothed(np.array([len(x.text) / x.tags for x in parser.lines]))
    out = left_out(parser, ratios)
    lines = [(x, r) for x, r in zip(parser.lines, ratios, strict=True) if not out[x.doubt] and not x.links()]
    in_articles = [(x, r) for x, r in lines if x.in_article]
    if in_articles and ARTICLE_WEIGHT * sum(r for _, r in in_articles) >= sum(r for x, r in lines if not x.in_article):
        lines = in_articles
    if not lines:
        return ""
    seen = np.array([r for _, r in lines])
    threshold = min(float(seen.std()), float(seen.max()) / 2)
    chosen = {x.region for x, r in lines if r >= threshold}
    return "\n\n".join(x.text for x, _ in lines if x.region in chosen)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of each page; one row per input row.

    A null or empty page has an empty text. Pages are parsed whole, one at a time. Broken markup is read as far as it can
    be: unclosed elements end with what surrounds them. Repeated rows are parsed each; other columns are ignored.
    """

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py() or "") for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    columns = pages.select("page_id", "url", "html")
    types = {f.name: f.dataType.simpleString() for f in columns.schema}
    return columns.mapInArrow(parsed, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
