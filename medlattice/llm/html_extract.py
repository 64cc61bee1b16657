"""Main text of web pages by text-to-tag ratio.

The standard library's streaming parser turns a page into lines, one per block, each with the number
of tags met and the elements it lies in. Lines in menus, forms and the like count as tags without
text. The ratios of text to tags are smoothed with a Gaussian and split by their standard deviation;
the lines above it vote, with their lengths, for the innermost element that holds most of them. The
article around it, or without one the innermost element that holds all lines above the deviation
and all prose, is the content region, and all of its lines are the text.

A part is dropped for what it is (a menu, a form, hidden) or for its name. A name is a whole class or id
(``sidebar``, ``site-footer``), not one word of it (``has-sidebar``, ``related-work``). A part that holds
most of the page's text in several lines is never dropped for its name.

One narrow pass over the pages, a page at a time: memory is bounded by the longest page of a batch.

Defined cases: null, empty or tag-only pages give an empty text; unclosed and stray tags are allowed;
a null ``page_id`` or ``url`` is kept; repeated rows are extracted each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from medlattice.llm.common import in_small_batches

#: smoothing (in lines) and the share of the selected text that a region must hold
SIGMA, RADIUS, HOLDS = 1.0, 2, 0.8
#: characters a tag that make a line prose, whatever stands on the rest of the page
PROSE = 60

# Elements of the HTML standard by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data dfn em font i kbd mark q s samp small span strike strong sub sup time tt u var".split()
)
UNCLOSED = frozenset("p li dt dd option tr".split())
REGIONS = frozenset("article main section div body td".split())
ARTICLES = frozenset(("article", "main"))
DROPPED = frozenset(
    "script style noscript template head nav menu footer aside form button select textarea dialog iframe object svg canvas".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices alert popup modal newsletter subscribe signup login sidebar widget menu nav navbar navigation breadcrumb breadcrumbs "
    "header footer masthead comment comments commentlist disqus reply replies share sharing social related search".split()
)
#: words that leave a name what it is; with any other word (has-sidebar, entry-header, social-impact) it is none
NEUTRAL = frozenset(
    "site page global main primary secondary top bottom left right sticky fixed box block bar container wrapper wrap inner outer area "
    "section list item items link links button buttons icon icons form posts post media id js slot slots unit units zone space placement "
    "google dfp leaderboard rectangle holder reader readers user users visitor privacy legal policy articles stories thread count title".split()
)
#: names that an id of a section has for what it is, not from its title
CERTAIN = frozenset("comment comments commentlist disqus respond replies sidebar newsletter advert adverts advertisement advertising ads cookie cookies breadcrumbs".split())
HEADERS = frozenset(("header", "masthead"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_WORD = re.compile(r"[a-z]+")


@dataclass(slots=True)
class _Part:
    """An open region, or a part with a name to drop; numbers grow, so a part's number is above its parent's."""

    number: int
    parent: _Part | None
    #: the outermost article around it, itself included
    article: _Part | None = None


@dataclass(slots=True)
class _Line:
    """A block: its text, the tags met, the innermost region and the innermost part with a name around it."""

    text: str
    tags: int
    region: _Part | None
    named: _Part | None


class _Lines(HTMLParser):
    """Collects ``lines``. A line that is dropped for what it is has no text. Elements point to their parents, so a page is
    read in time proportional to its length, however deep it nests."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.regions: list[_Part] = []
        self._texts: list[str] = []
        self._tags = 0
        # block elements, whether each is dropped, and the region and named part around it
        self._open: list[tuple[str, bool, _Part | None, _Part | None]] = []
        self._opened: Counter[str] = Counter()
        self._region: _Part | None = None
        self._named: _Part | None = None
        self._dropped = 0
        self._next = 0

    def end_line(self) -> None:
        text = " ".join("".join(self._texts).split())
        self._texts.clear()
        if text or self._tags:
            self.lines.append(_Line(text, self._tags, self._region, self._named))
            self._tags = 0

    def _in_article(self) -> bool:
        return self._region is not None and self._region.article is not None

    def _drops(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in DROPPED or (tag == "header" and not self._in_article()):
            return True
        if not attrs or tag in ("html", "body") or tag in ARTICLES:
            return False
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name == "role" and value in ROLES:
                return True
            if name == "style" and value and _HIDDEN.search(value):
                return True
        return False

    def _has_name(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if not attrs or tag in ("html", "body") or tag in ARTICLES:
            return False
        names = NAMES - HEADERS if self._in_article() else NAMES
        for name, value in attrs:
            # ids of sections and headings are made from their titles
            if value and (name == "class" or name == "id" and tag not in HEADINGS):
                for token in value.lower().split():
                    words = _WORD.findall(token)
                    known = CERTAIN if name == "id" and tag == "section" else names
                    if not known.isdisjoint(words) and all(word in names or word in NEUTRAL for word in words):
                        return True
        return False

    def _pop(self) -> str:
        name, dropped, self._region, self._named = self._open.pop()
        self._opened[name] -= 1
        self._dropped -= dropped
        return name

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._tags += 1
        if tag in INLINE:
            return
        if tag in VOID:
            self._texts.append(" ")
            return
        self.end_line()
        while self._open and (self._open[-1][0] == "p" or self._open[-1][0] == tag and tag in UNCLOSED):
            self._pop()
        drops, named = self._drops(tag, attrs), self._has_name(tag, attrs)
        # elements that may stay unclosed are kept only while they drop their content
        if tag in UNCLOSED and not drops and not named:
            return
        self._open.append((tag, drops, self._region, self._named))
        self._opened[tag] += 1
        self._dropped += drops
        self._next += 1
        if named:
            self._named = _Part(self._next, self._named)
        if tag in REGIONS:
            region = _Part(len(self.regions), self._region, self._region.article if self._region else None)
            if tag in ARTICLES and region.article is None:
                region.article = region
            self.regions.append(region)
            self._region = region

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in INLINE:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        if tag in INLINE or tag in VOID:
            return
        self.end_line()
        if not self._opened[tag]:
            return
        while self._open and self._pop() != tag:
            pass

    def handle_data(self, data: str) -> None:
        if not self._dropped:
            self._texts.append(data)


def _smoothed(ratio: np.ndarray) -> np.ndarray:
    weight = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    return np.convolve(np.pad(ratio, RADIUS, mode="edge"), weight / weight.sum(), mode="valid")


def _kept_lines(raw: list[_Line]) -> list[_Line]:
    """Lines without the text of parts dropped for their names; textless lines in a row are one."""
    held: Counter[int] = Counter()
    parts: Counter[int] = Counter()
    inner: dict[int, _Part] = {}
    for line in raw:
        if line.text and line.named:
            held[line.named.number] += len(line.text)
            parts[line.named.number] += 1
            inner[line.named.number] = line.named
    # a part holds what the parts within it hold: from the innermost out
    heap = [-n for n in inner]
    heapq.heapify(heap)
    while heap:
        part = inner[-heapq.heappop(heap)]
        if part.parent:
            up = part.parent.number
            if up not in inner:
                inner[up] = part.parent
                heapq.heappush(heap, -up)
            held[up] += held[part.number]
            parts[up] += parts[part.number]
    total = sum(len(line.text) for line in raw)
    lines: list[_Line] = []
    for line in raw:
        # what holds for the innermost part holds for those around it
        name = line.named.number if line.named else None
        if name is not None and not (held[name] >= HOLDS * total and parts[name] > 1):
            line = _Line("", line.tags, line.region, line.named)
        if line.text or (lines and lines[-1].text):
            lines.append(_Line(line.text, line.tags, line.region, line.named))
        elif lines:
            lines[-1].tags += line.tags
    return lines


def _gathered(regions: list[_Part], lines: list[tuple[_Part | None, int]]) -> np.ndarray:
    """Per region the sum of the weights of the lines in it, those of the regions within it included."""
    sums = np.zeros(len(regions), np.int64)
    for region, weight in lines:
        if region:
            sums[region.number] += weight
    for region in reversed(regions):
        if region.parent:
            sums[region.parent.number] += sums[region.number]
    return sums


def _last(marks: np.ndarray) -> int | None:
    """The innermost of nested regions that are marked: the last in page order."""
    found = np.flatnonzero(marks)
    return int(found[-1]) if len(found) else None


def main_text(html: str | None) -> str:
    """The blocks of the content region of one page, joined by empty lines."""
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    parser.end_line()
    regions, lines = parser.regions, _kept_lines(parser.lines)
    if not any(line.text for line in lines):
        return ""
    plain = np.array([len(line.text) / max(1, line.tags) for line in lines])
    ratio = _smoothed(plain)
    chosen = ratio > ratio.std()
    dense = chosen | (plain > min(ratio.std(), PROSE))
    voting = [(line.region, len(line.text)) for line, take in zip(lines, chosen, strict=True) if take and line.text]
    if not voting:
        most = max(lines, key=lambda line: len(line.text))
        voting = [(most.region, len(most.text))]
    region = _last(_gathered(regions, voting) >= HOLDS * sum(n for _, n in voting))
    if region is not None and regions[region].article:
        region = regions[region].article.number
    elif region is not None:
        held = [(line.region, 1) for line, take in zip(lines, dense, strict=True) if take and line.text]
        if held:
            region = _last(_gathered(regions, held) == len(held))
    if region is None:
        return "\n\n".join(line.text for line in lines if line.text)
    inside = np.zeros(len(regions), bool)
    for part in regions:
        inside[part.number] = part.number == region or part.parent is not None and inside[part.parent.number]
    return "\n\n".join(line.text for line in lines if line.text and line.region and inside[line.region.number])


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    wanted = in_small_batches(pages).selectExpr("cast(page_id AS long) AS page_id", "url", "html")
    return wanted.mapInArrow(run, "page_id long, url string, text string, n_chars long")
