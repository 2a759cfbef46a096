"""Main text of web pages from streaming parser events and text-to-tag ratios.

The standard library's parser feeds one event at a time; text is gathered into blocks, the lines of the method. A block's
ratio is its text outside links over its tags. Names of elements and classes are hints: what stands in menus, headers, footers, sidebars,
notices, adverts, forms and comments, or outside the article of a page that marks one, counts as no text. The logarithms of
the ratios are smoothed with a Gaussian over the neighbouring blocks of the same region and split into two clusters.
Regions most of whose text is in the upper cluster are the content, inside articles as elsewhere, so that a box of
bylines or offers goes without a telling name, and titles and short paragraphs stay with their neighbours.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SIGMA = 1.0
RADIUS = 2

# Fixed values of HTML: elements without content of their own, and elements that begin a new block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
UNSEEN = frozenset("head script style noscript template iframe object svg canvas select textarea audio video".split())
LEFT_OUT = UNSEEN | frozenset("nav header footer aside form button dialog menu map search".split())
REGION = frozenset("article main section div td body".split())
LEFT_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments respond disqus "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay footer header masthead menu menus nav "
    "navbar navigation sidebar sidebars widget widgets share sharing social related recommended newsletter subscribe "
    "subscription promo promotion sponsor sponsored pagination pager toolbar login signup search form complementary "
    "contentinfo".split()
)
KEPT_WORDS = frozenset("content main article entry story has with no without body wrapper container layout".split())
NEVER_BY_NAME = frozenset("html body main".split())

_NAME = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _named_out(attrs: list[tuple[str, str | None]]) -> bool:
    """Whether class, id or role name a part that is not content, or the element is hidden."""
    for key, value in attrs:
        if key in ("class", "id", "role") and value:
            for word in value.lower().split():
                parts = set(_NAME.findall(word))
                if parts & LEFT_OUT_WORDS and not parts & KEPT_WORDS:
                    return True
        elif key == "hidden" or (key == "style" and value and _HIDDEN.search(value.lower())):
            return True
    return False


ASIDE = -1  # the region of parts that are not content by their names


class _Blocks(HTMLParser):
    """Collects ``(text, linked characters, tags, region, inside an article)`` per block; a part left out is one block."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, int, int, bool]] = []
        self._open: list[str] = []
        self._places: dict[str, list[int]] = {}  # where each element is open
        self._aside: list[str] = []
        self._out: list[tuple[int, str, bool]] = []  # depth, element and kind of what is left out
        self._regions: list[tuple[int, int]] = [(0, 0)]
        self._count = 0
        self._text: list[str] = []
        self._linked = self._links = self._tags = self._articles = 0

    def flush(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            self.blocks.append((text, min(self._linked, len(text)), self._tags, self._regions[-1][1], self._articles > 0))
        self._text, self._linked, self._tags = [], 0, 0

    def _enter(self) -> None:
        """End what is left out, as one block."""
        text = " ".join("".join(self._aside).split())
        if text:
            self.blocks.append((text, 0, 1, ASIDE, False))
        self._out, self._aside = [], []

    def _cut(self, at: int) -> None:
        """Close all elements from a depth on."""
        for tag in self._open[at:]:
            self._places[tag].pop()
        del self._open[at:]

    def close(self) -> None:
        super().close()
        self.flush()
        self._enter()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("article", "main") and self._out and not self._out[-1][2]:
            # content begins: an element before it was never closed
            self._cut(self._out[0][0])
            self._enter()
        if tag in BLOCK and not self._out:
            self.flush()
        if tag == "br" and not self._out:
            self._text.append(" ")
        if not self._out:
            self._tags += 1
        if tag in VOID:
            return
        by_name = tag not in NEVER_BY_NAME and _named_out(attrs)
        if not self._out and (tag in LEFT_OUT or by_name):
            self._out.append((len(self._open), tag, by_name))
        self._places.setdefault(tag, []).append(len(self._open))
        self._open.append(tag)
        if not self._out:
            if tag in REGION:
                self._count += 1
                self._regions.append((len(self._open), self._count))
            self._articles += tag in ("article", "main")
            self._links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "p" and "p" not in self._open[-8:] and not self._out:
            self.flush()
        if tag in VOID or not self._places.get(tag):
            return
        at = self._places[tag][-1]
        if self._out and at > self._out[0][0]:
            self._aside.append(" ")
            self._cut(at)
            return
        if self._out and at < self._out[0][0] and tag not in BLOCK:
            return
        was_out = bool(self._out)
        if was_out and at <= self._out[0][0]:
            self._enter()
        if not was_out:
            if tag in BLOCK:
                self.flush()
            self._tags += 1
            for closed in self._open[at:]:
                self._articles -= closed in ("article", "main")
                self._links -= closed == "a"
        while self._regions[-1][0] > at:
            self._regions.pop()
        self._cut(at)
        self._articles, self._links = max(self._articles, 0), max(self._links, 0)

    def handle_data(self, data: str) -> None:
        if self._out:
            if self._open and self._open[-1] not in UNSEEN and self._out[0][1] not in UNSEEN:
                self._aside.append(data)
            return
        self._text.append(data)
        if self._links:
            self._linked += len(data.strip())


def ratios(blocks: list[tuple[str, int, int, int, bool]]) -> np.ndarray:
    """Logarithm of one plus the text outside links per tag; none for what hints say is not content.

    If all text of the page that hints leave is linked, links count as text.
    """
    marked = any(b[4] for b in blocks)
    held = np.array([b[3] != ASIDE and (b[4] or not marked) for b in blocks])
    size, linked, tags = (np.array(x, float) for x in zip(*((len(b[0]), b[1], max(b[2], 1)) for b in blocks)))
    own = (size - linked) * held
    return np.log1p((own if own.any() else size * held) / tags)


def smoothed(values: np.ndarray, regions: np.ndarray) -> np.ndarray:
    """Gaussian means over the neighbouring blocks of the same region, weights scaled to what exists at its borders."""
    weights = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    out = np.empty(len(values))
    cuts = [0, *(np.flatnonzero(np.diff(regions)) + 1), len(values)]
    for a, b in zip(cuts, cuts[1:]):
        of = lambda x: np.convolve(x, weights)[RADIUS : RADIUS + len(x)]
        out[a:b] = of(values[a:b]) / of(np.ones(b - a))
    return np.round(out, 9)  # so that equal ratios stay equal


def threshold(values: np.ndarray) -> float:
    """The border between the means of two clusters of the ratios, found by alternating assignment."""
    border = float(values.mean())
    for _ in range(20):
        high, low = values[values >= border], values[values < border]
        if not len(high) or not len(low):
            break
        new = (high.mean() + low.mean()) / 2
        if abs(new - border) < 1e-9:
            break
        border = float(new)
    return min(border, float(values.max()))


def content(blocks: list[tuple[str, int, int, int, bool]], values: np.ndarray) -> list[bool]:
    """Which blocks are content, by their smoothed ratios.

    A region of which at least half the text is in blocks at or above the threshold is kept whole, but for blocks below it
    that are mostly links; of other regions the blocks above it are kept. Nothing without text of its own is.
    """
    above = (values >= threshold(values)) & (values > 0)
    share: dict[int, list[int]] = {}
    for block, high in zip(blocks, above):
        sums = share.setdefault(block[3], [0, 0])
        sums[0] += len(block[0])
        sums[1] += len(block[0]) * int(high)
    whole = {region for region, (size, high) in share.items() if 2 * high >= size}
    return [bool(high) or (b[3] in whole and 2 * b[1] < len(b[0])) for b, high in zip(blocks, above)]


def main_text(html: str | None) -> str:
    """The main text: the content blocks in page order, joined by line breaks; empty if there is none."""
    if not html:
        return ""
    parser = _Blocks()
    try:
        parser.feed(html)
        parser.close()
    except AssertionError:  # what the parser refuses are broken "<![" sections; they are read as text
        parser = _Blocks()
        parser.feed(html.replace("<![", "&lt;!["))
        parser.close()
    blocks = parser.blocks
    if not blocks:
        return ""
    values = smoothed(ratios(blocks), np.array([b[3] for b in blocks]))
    return "\n".join(b[0] for b, kept in zip(blocks, content(blocks, values)) if kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            found = [main_text(x.as_py()) for x in part.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in part.schema.names if c != "html"),
                    pa.array(found, pa.string()),
                    pa.array(map(len, found), pa.int64()),
                ],
                names=[*(c for c in part.schema.names if c != "html"), "text", "n_chars"],
            )


def extract(pages: DataFrame) -> DataFrame:
    """Per page ``page_id, url, text, n_chars``.

    Null and empty pages, and pages without content, get empty text. Pages are read whole and independent of each other;
    repeated rows get equal texts.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
