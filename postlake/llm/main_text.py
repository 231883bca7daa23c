"""Main text of web pages from parser events, text-to-tag ratios and smoothed threshold clusters.

The standard library's parser streams events over the whole page. Block-level tags and line breaks end a line; each
line has its text and the number of tags met in it. Parts that are never content by their element, role or class
(scripts, styles, menus, headers, footers, sidebars, notices, adverts, forms, reader comments) are left out. Names are
whole words of a class or id, made of listed words alone ("site-footer", not "has-sidebar"). A part that holds an article
or main element stays, and so does a form or named part with most of the page's text, save reader comments.

The lines' text-to-tag ratios are smoothed with a Gaussian; lines that reach a share of the median ratio, themselves or
smoothed, form clusters. Lines mostly of links count for neither, where there are others. If at least half of the clusters' text is in article and main elements, all lines in such
elements are the text. Otherwise it is all lines of the innermost container around the clusters; where that is the page
itself, lines of links before the first cluster line and after the last one are left out.

Defined results: a null or empty page, or one without content lines, gives an empty text. Unclosed and stray tags are
tolerated: a part left out ends with its own end tag, or with that of an element around it, or with the page. Repeated
rows keep their rows; null page_id and url are carried along; other columns are ignored.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from postlake.llm.tables import table, with_columns

SIGMA = 1.0
#: Share of the median ratio that a content line must reach.
THRESHOLD = 0.5
FEED_CHARS = 1 << 16

#: Elements of HTML by how they lay out text.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary "
    "table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset(
    "aside button canvas datalist dialog footer form head header iframe menu nav noscript object script select style "
    "svg template textarea".split()
)
CONTENT = frozenset(["article", "main"])
#: Elements left out that stay if an article or main element is inside.
WRAPPERS = frozenset("aside dialog footer form header menu nav".split())
CONTAINERS = frozenset(["div", "section", "td"])
_COMMENTS = frozenset("comment comments disqus".split())
_NAMES = _COMMENTS | frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies footer header "
    "menu nav navbar navigation newsletter notice popup promo related share sharing sidebar social sponsor sponsored "
    "subscribe toolbar widget".split()
)
#: Words that say where or in what form a named part is.
_BESIDE = frozenset(
    "area articles bar block blocks bottom box button buttons container global google group icons inner item items left "
    "links list main mobile page panel post posts primary right secondary section site slot sub thread top unit wrap wrapper".split()
)
_PARTS = re.compile("[-_]+")
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_SPACE = re.compile(r"\s+")


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[str] = []
        self.tags: list[int] = []
        self.regions: list[int] = []  # of each line, 0 outside article and main
        self.linked: list[int] = []  # characters in links
        self.inside: list[int] = []  # innermost container of each line, 0 outside any
        self.parts: list[int] = []  # innermost part of each line that may be left out, 0 outside any
        self.above = [0]  # container around each container
        self.part_above = [0]
        self.part_stays = [True]
        self.part_chars = [0]
        self.part_may_stay = [True]  # for its size
        self._open: list[str] = []  # open elements that aren't void
        self._skip = 0  # length of _open when the part left out began, 0 outside one
        self._region: list[tuple[int, int]] = []  # number and length of _open
        self._container: list[tuple[int, int]] = []
        self._part: list[tuple[int, int, int]] = []  # and tags met before
        self._links = 0
        self._seen = 0
        self._parts: list[str] = []
        self._link_chars = 0
        self._met = 0

    def end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self._parts)).strip()
        if text:
            self.lines.append(text)
            self.tags.append(self._met)
            self.regions.append(self._region[-1][0] if self._region else 0)
            self.linked.append(self._link_chars)
            self.inside.append(self._container[-1][0] if self._container else 0)
            part = self._part[-1][0] if self._part else 0
            self.parts.append(part)
            self.part_chars[part] += len(text)
            self._met = 0
        self._parts = []
        self._link_chars = 0

    def handle_starttag(self, tag, attrs) -> None:
        if not self._skip:
            self._met += 1
            if tag in BLOCKS:
                self.end_line()
        if tag in VOID:
            return
        self._open.append(tag)
        if self._skip:
            return
        self._links += tag == "a"
        left_out = tag in LEFT_OUT and not (self._region and tag == "header")
        why = self._named(tag, attrs)
        if (left_out and tag not in WRAPPERS) or why == "hidden":
            self.end_line()
            self._skip = len(self._open)
            self._links -= tag == "a"
        elif left_out or why:
            self.end_line()
            self.part_above.append(self._part[-1][0] if self._part else 0)
            self.part_stays.append(False)
            self.part_chars.append(0)
            self.part_may_stay.append(why != "comments" and (not left_out or tag == "form"))
            self._part.append((len(self.part_above) - 1, len(self._open), self._met))
        elif tag in CONTENT:
            self._seen += 1
            self._region.append((self._seen, len(self._open)))
            part = self._part[-1][0] if self._part else 0
            while not self.part_stays[part]:
                self.part_stays[part] = True
                part = self.part_above[part]
        if tag in CONTAINERS and not self._skip:
            self.above.append(self._container[-1][0] if self._container else 0)
            self._container.append((len(self.above) - 1, len(self._open)))

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    @staticmethod
    def _named(tag: str, attrs) -> str:
        """Why an element is never content: hidden, comments or named; empty if it may be."""
        if tag in CONTENT or tag in ("html", "body"):
            return ""
        given = {k: v or "" for k, v in attrs}
        if "hidden" in given or given.get("aria-hidden") == "true":
            return "hidden"
        why = "named" if given.get("role", "").lower() in _ROLES else ""
        for token in f"{given.get('class', '')} {given.get('id', '')}".lower().split():
            words = {w for w in _PARTS.split(token) if w}
            if words & _NAMES and words <= _NAMES | _BESIDE:
                if words & _COMMENTS:
                    return "comments"
                why = "named"
        return why

    def handle_endtag(self, tag) -> None:
        if not self._skip:
            self._met += 1
            if tag in BLOCKS:
                self.end_line()
        if tag not in self._open:
            return
        at = len(self._open) - 1
        while self._open[at] != tag:
            at -= 1
        if self._part and at < self._part[-1][1]:
            self.end_line()
        if not self._skip:
            self._links -= self._open[at:].count("a")
        elif at < self._skip:
            self._links -= self._open[at : self._skip - 1].count("a")
            self._skip = 0
        del self._open[at:]
        for stack in (self._region, self._container):
            while stack and at < stack[-1][1]:
                stack.pop()
        while self._part and at < self._part[-1][1]:
            self._met = self._part.pop()[2]

    def handle_data(self, data) -> None:
        if not self._skip:
            self._parts.append(data)
            if self._links:
                self._link_chars += len(data.strip())

    def kept(self) -> list[int]:
        """Lines outside the parts left out."""
        for part in range(len(self.part_above) - 1, 0, -1):
            self.part_chars[self.part_above[part]] += self.part_chars[part]
        out = [False] * len(self.part_above)
        for part, above in enumerate(self.part_above):
            most = self.part_may_stay[part] and 2 * self.part_chars[part] > self.part_chars[0]
            out[part] = not part or (out[above] and (self.part_stays[part] or most))
        return [i for i, part in enumerate(self.parts) if out[part]]

    def around(self, one: int, other: int) -> int:
        """The innermost container of both containers; numbers grow inwards."""
        while one != other:
            one, other = (self.above[one], other) if one > other else (one, self.above[other])
        return one

    def within(self, container: int) -> list[bool]:
        inner = [False] * len(self.above)
        for n, above in enumerate(self.above):
            inner[n] = n == container or (n > 0 and inner[above])
        return inner


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel, mode="full")[reach : reach + len(ratio)]
    return np.convolve(ratio, kernel, mode="full")[reach : reach + len(ratio)] / weight


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = _Page()
    for at in range(0, len(html), FEED_CHARS):
        page.feed(html[at : at + FEED_CHARS])
    page.close()
    page.end_line()
    kept = page.kept()
    if not kept:
        return ""
    length = np.array([len(page.lines[i]) for i in kept])
    ratio = length / np.maximum([page.tags[i] for i in kept], 1)
    links = 2 * np.array([page.linked[i] for i in kept]) > length
    plain = ~links if not links.all() else links
    least = THRESHOLD * np.median(ratio[plain])
    content = plain & ((ratio >= least) | (smoothed(ratio) >= least))
    regions = np.array([page.regions[i] for i in kept]) > 0
    if 2 * length[content & regions].sum() >= length[content].sum():
        chosen = regions
    else:
        first, last = np.flatnonzero(content)[[0, -1]]
        container = page.around(page.inside[kept[first]], page.inside[kept[last]])
        inner = page.within(container)
        chosen = np.array([inner[page.inside[i]] for i in kept])
        if not container:
            place = np.arange(len(kept))
            chosen = ~links | ((first <= place) & (place <= last))
    return " ".join(page.lines[i] for i, c in zip(kept, chosen) if c)


def extracted(pages: DataFrame, html: str, keep: list[str]) -> DataFrame:
    def extract(column: pa.Array) -> list[pa.Array]:
        texts = [main_text(v.as_py()) for v in column]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return with_columns(pages, html, extract, "text string, n_chars long", keep)


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    return extracted(table(spark, sf_dir, "pages"), "html", ["page_id", "url"])
