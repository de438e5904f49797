"""Main text of HTML pages by text-to-tag ratio.

The standard library's parser streams a page's events. They become lines: the text between two block tags, with the
number of tags met in it. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments are left out while streaming, by element and by class, id or role. A name that consists of marks only, as in
``cookie-notice``, always counts. One that merely has a mark in it does not count for an article or main element, nor for a wrapper
that holds most of the page's text (the page is parsed again without it), and never after a word such as ``has``.
The lines that stay form regions: an article or main element is one, and outside of those each run of lines that nothing left out
interrupts. Articles are the content, whole. On a page without any, the ratio of characters to tags of each line is smoothed with a
Gaussian along the page, and a threshold parts the smoothed ratios into two clusters; if these are clearly apart, the regions
without a line in the upper cluster are dropped, else all stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.0
RADIUS = 2
APART = 3

# Elements of HTML.
SILENT = frozenset("head title script style noscript template nav header footer aside form menu dialog button select textarea svg math iframe object canvas audio video map datalist".split())
BLOCKS = frozenset("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
REGIONS = frozenset(("article", "main"))
NESTED = SILENT | REGIONS | frozenset("html body div section table tbody thead tfoot tr td th ul ol dl li blockquote figure figcaption fieldset details center span p".split())
IMPLIED_END = frozenset(("p", "li", "tr", "td", "th", "span"))
RAW_TEXT = frozenset(("script", "style"))
# Words in class, id or role that mark what is not the article.
MARKS = frozenset("ad ads adv advert adverts advertisement advertisements advertising adsense banner banners breadcrumb breadcrumbs comment comments commentlist complementary contentinfo cookie cookies consent copyright disclaimer disqus dropdown footer footers form gdpr header headers login masthead menu menus modal nav navbar navigation newsletter notice notices notification pagination pager popup promo promotion recommended related replies reply respond search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


# Words that begin a name which tells what an element has, not what it is.
MODIFIERS = frozenset("has have with without no".split())
HELD, MARKED, PARTLY = 0, 2, 1


def _mark(tag: str, attributes: list[tuple[str, str | None]]) -> int:
    """``MARKED`` by a name of marks only or if hidden, ``PARTLY`` by a name with a mark in it."""
    found = HELD
    for name, value in attributes:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return MARKED
        for token in (value or "").split() if name in ("class", "id", "role") else ():
            own = [word.lower() for word in WORDS.findall(token) if not word.isdigit()]
            if own and all(word in MARKS for word in own):
                return MARKED
            if tag not in REGIONS and any(word in MARKS for word in own) and own[0] not in MODIFIERS:
                found = PARTLY
    return found


class Lines(HTMLParser):
    """Collects (text, tags, region) per line; region 0 is outside of any article, with a number per run."""

    def __init__(self, spared: frozenset[int] = frozenset()) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, tuple[int, int]]] = []
        self.open: list[tuple[str, bool, bool]] = []  # element, left out from here on, a comment section
        self.spared = spared  # partly marked elements, by number, that stay
        self.partly = self.total = 0  # such elements so far; characters that only a partly marked element leaves out, and others
        self.lost: list[bool] = []  # of each open element, whether more than a partly marked element leaves it out
        self.sizes: list[tuple[int, int]] = []  # of each open element, its number if partly marked, else 0, and ``total`` before it
        self.held: dict[int, int] = {}  # characters in partly marked elements
        self.parts: list[str] = []
        self.tags = 0
        self.articles = self.runs = 0
        self.region = (0, 0)

    def close_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            self.lines.append((text, max(1, self.tags), self.region))
            self.tags = 0

    def silent(self) -> bool:
        return bool(self.open) and self.open[-1][1]

    def _close(self, depth: int) -> None:
        """Close the open elements from ``depth`` on."""
        for number, before in self.sizes[depth:]:
            if number:
                self.held[number] = self.total - before
        del self.open[depth:], self.lost[depth:], self.sizes[depth:]

    def large(self) -> frozenset[int]:
        """The partly marked elements that hold most of the page's text."""
        self._close(0)
        return frozenset(number for number, size in self.held.items() if 2 * size > self.total)

    def _place(self) -> None:
        """The region of what follows."""
        inside = any(tag in REGIONS and not silent for tag, silent, _ in self.open)
        self.region = (self.articles, 0) if inside else (0, self.runs)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.close_line()
        self.tags += 1
        if tag in VOID or tag not in NESTED:
            return
        if tag in IMPLIED_END and self.open and self.open[-1][0] == tag:
            self._close(len(self.open) - 1)
        mark = HELD if tag in ("html", "body") else _mark(tag, attrs)
        marked = bool(mark)
        comments = marked and any("comment" in (value or "").lower() for _, value in attrs)
        number = 0
        if mark == PARTLY and not comments:
            self.partly += 1
            number, marked = self.partly, self.partly not in self.spared
        if tag in REGIONS and not marked and not any(section for _, _, section in self.open):
            while self.silent():  # an article does not lie inside a menu that was never closed
                self._close(len(self.open) - 1)
            if not any(name in REGIONS for name, _, _ in self.open):
                self.articles += 1
        was = self.silent()
        silent = was or marked or tag in SILENT
        self.lost.append(bool(self.lost) and self.lost[-1] or tag in SILENT or marked and not number)
        self.sizes.append((number, self.total))
        self.open.append((tag, silent, comments or (bool(self.open) and self.open[-1][2])))
        if silent and not was:
            self.runs += 1
        self._place()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.close_line()
        self.tags += 1
        for depth in range(len(self.open) - 1, -1, -1):
            name, silent, _ = self.open[depth]
            if name == tag:
                self._close(depth)
                break
            if name in ("td", "th") and tag in ("p", "li", "span") or name in REGIONS and tag not in ("html", "body"):
                break  # a stray end tag does not reach out of a cell or an article
        self._place()

    def handle_data(self, data: str) -> None:
        if not (self.lost and self.lost[-1]):
            self.total += len("".join(data.split()))
        if not self.silent():
            self.parts.append(data)


def smoothed_ratios(lines: list[tuple[str, int, tuple[int, int]]]) -> np.ndarray:
    """Characters per tag of each line, smoothed with a Gaussian over its neighbours."""
    ratios = np.array([len(text) / tags for text, tags, _ in lines])
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    weights = np.convolve(np.ones(len(ratios)), kernel, "same") if len(ratios) > 2 * RADIUS else None
    if weights is None:
        offsets = np.arange(len(ratios))
        near = np.exp(-0.5 * ((offsets[:, None] - offsets[None, :]) / SIGMA) ** 2)
        return near @ ratios / near.sum(1)
    return np.convolve(ratios, kernel, "same") / weights


def threshold(ratios: np.ndarray) -> float:
    """The cut between a low and a high cluster: two means, moved until they stay."""
    low, high = float(ratios.min()), float(ratios.max())
    while True:
        cut = (low + high) / 2
        upper = ratios >= cut
        new = (float(ratios[~upper].mean()) if not upper.all() else low, float(ratios[upper].mean()))
        if new == (low, high):
            return cut
        low, high = new


def main_text(html: str | None) -> str:
    """The article's text, blocks joined by one space; empty for NULL, for no text and for boilerplate alone."""
    if not html:
        return ""
    parser = _parsed(html)
    if large := parser.large():
        parser = _parsed(html, large)
    lines = parser.lines
    if any(region[0] for _, _, region in lines):
        return " ".join(text for text, _, region in lines if region[0])
    if not lines:
        return ""
    ratios = smoothed_ratios(lines)
    cut = threshold(ratios)
    upper = ratios >= cut
    if upper.all() or ratios[upper].mean() < APART * ratios[~upper].mean():
        return " ".join(text for text, _, _ in lines)
    content = {line[2] for line, high in zip(lines, upper, strict=True) if high}
    return " ".join(text for text, _, region in lines if region in content)


def _parsed(html: str, spared: frozenset[int] = frozenset()) -> Lines:
    parser = Lines(spared)
    parser.feed(html[: _complete(html)])
    parser.close()
    parser.close_line()
    return parser


def _complete(html: str) -> int:
    """Where a tag begins that the end of the page cuts off; else the page's length."""
    start = html.rfind("<")
    cut = start >= 0 and html.find(">", start) < 0 and re.match(r"</?[A-Za-z]|<!", html[start : start + 3])
    return start if cut else len(html)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: id, url, text, n_chars.

    NULL or empty HTML gives an empty text. Repeated rows stay rows; an empty table gives no rows. Other columns are
    not read.
    """
    columns = pages.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html) for html in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], ["id", "url", "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    found = columns.mapInArrow(work, f"id {kind}, url string, text string")
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
