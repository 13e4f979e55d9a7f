"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines: one per block of the page, with the text of menus, page headers, footers, asides, forms,
scripts, notices, adverts and comments left out, as the tags, roles and class names of their containers tell. Text lengths
are summed over sliding windows of lines on every page; the sums surge where text begins and dive where it ends. An <article>
or <main> element in which they surge carries surge and dive to its own ends. The stretch with most text is the article:
  - if it stands in such an element, every other such element with a surge belongs to it;
  - if not, other stretches do, where the short lines between stand in the same box of the page (verse, dialogue, lists)
    or are headings and sentences, and so do short lines of the same box at its edges.
A page where nothing surges keeps its <article> and <main> elements, or if it has none, all lines.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from parcelmart.llm import bytehash as H

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
_DROP = frozenset(
    "head title script style noscript template nav footer aside form button select textarea input label iframe object svg math canvas audio video dialog menu".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar".split())
_NAME = (
    r"(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?s?|banner|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay"
    r"|newsletter|subscribe|subscription|signup|login|sidebar|side|aside|widgets?|related|recommended|recommendations|trending|popular|menu|nav|navbar"
    r"|navigation|breadcrumbs?|footer|site-?header|page-?header|masthead|topbar|toolbar|share|sharing|social|comments?|commentlist|replies|respond|disqus"
    r"|pagination|pager|skip|hidden|tags|outbrain|taboola)"
)
_PART = r"(?:site|page|main|global|top|bottom|left|right|primary|secondary|bar|wrap|wrapper|container|inner|box|area|section|block|list|links?|items?|content|slot|[0-9]+)"
# a whole class name that says no more than that: "has-sidebar" or "popular-science" do not
_NAMES = re.compile(rf"(?<!\S)(?:{_PART}[_-])*{_NAME}(?:[_-](?:{_NAME}|{_PART}))*(?!\S)", re.IGNORECASE)
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
_ENDS_P = _BLOCK - frozenset("body head html option legend".split())
_BOXES = frozenset("body div section article main td th center details".split())
_HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SENTENCE = tuple(".!?\u2026:;\"\u201d\u2019\u00bb\u3002\uff01\uff1f")
_SCOPE = frozenset("ul ol dl table select article section main body".split())


class _Lines(HTMLParser):
    """Lines as (text, container, box, is heading): container numbers the <article> or <main> the line stands in, 0 for none.

    outer holds per box the box around it; 0 is the page.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int, int]] = []
        self.open: Counter[str] = Counter()  # elements on the stack, so that a tag that closes none costs nothing
        self.held: list[str] = []
        self.lines: list[tuple[str, int, int, bool]] = []
        self.containers = 0
        self.outer = [0]

    def line(self) -> None:
        text = " ".join("".join(self.held).split())
        self.held = []
        if text:
            _, _, inside, box = self.stack[-1] if self.stack else ("", False, 0, 0)
            self.lines.append((text, inside, box, any(x[0] in _HEADS for x in self.stack[-3:])))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _ENDS_P:
            self.close_inside(("p",))
        if tag in _CLOSES:
            self.close_inside(_CLOSES[tag])
        if tag == "br":
            self.held.append(" ")
            return
        if tag in _BLOCK:
            self.line()
        if tag in _VOID:
            return
        _, dropped, inside, box = self.stack[-1] if self.stack else ("", False, 0, 0)
        if not dropped:
            dropped = tag in _DROP or tag == "header" and not inside
            for name, value in attrs:
                if name in ("class", "id") and value and tag not in ("html", "body", "article", "main"):
                    dropped = dropped or bool(_NAMES.search(value))
                elif name == "role" and value:
                    dropped = dropped or value.lower() in _ROLES and not (inside and value.lower() == "banner")
                elif name == "hidden" or name == "aria-hidden" and value == "true":
                    dropped = True
                elif name == "style" and value:
                    dropped = dropped or "display:none" in value.replace(" ", "").lower()
        if tag in ("article", "main") and not dropped and not inside:
            self.containers += 1
            inside = self.containers
        if tag in _BOXES and not dropped:
            self.outer.append(box)
            box = len(self.outer) - 1
        self.stack.append((tag, dropped, inside, box))
        self.open[tag] += 1

    def close_inside(self, tags: tuple[str, ...]) -> None:
        """Closes the innermost open element of these, if no list, table or section stands between."""
        if not any(self.open[t] for t in tags):
            return
        for k in range(len(self.stack) - 1, -1, -1):
            name = self.stack[k][0]
            if name in tags:
                self.line()
                self.close_from(k)
                return
            if name in _SCOPE or name == "div" and "p" in tags:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCK:
            self.line()
        if self.open[tag]:
            self.close_from(next(k for k in range(len(self.stack) - 1, -1, -1) if self.stack[k][0] == tag))

    def close_from(self, k: int) -> None:
        self.open.subtract(x[0] for x in self.stack[k:])
        del self.stack[k:]

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """A marked section that the parser does not know is a comment up to the next `>`."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.rawdata.find(">", i + 2) + 1 or len(self.rawdata)

    def handle_data(self, data: str) -> None:
        if not (self.stack and self.stack[-1][1]):
            self.held.append(data)


def _boxes(lines: list[tuple[str, int, int, bool]], outer: list[int]) -> list[int]:
    """Per line the innermost box around it that holds another line too."""
    held = [0] * len(outer)
    for _, _, box, _ in lines:
        held[box] += 1
    for box in range(len(outer) - 1, 0, -1):  # boxes stand after those around them
        held[outer[box]] += held[box]
    out = []
    for _, _, box, _ in lines:
        while box and held[box] < 2:
            box = outer[box]
        out.append(box)
    return out


def _surges(size: np.ndarray, window: int, surge: int) -> list[tuple[int, int]]:
    """First and last + 1 line of every stretch between a surge and a dive of the block sums."""
    sums = np.convolve(size, np.ones(window, np.int64), "full")[window - 1 :]  # this line and those after it
    high = (sums >= surge) & (size > 0)
    high &= (size >= surge / 4) | np.append(False, high[:-1])
    edges = np.flatnonzero(np.diff(np.concatenate([[0], high.astype(np.int8), [0]])))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def main_text(html: str, window: int = 3, surge: int = 80) -> str:
    """The page's main text: lines joined by an empty line; empty if there is none."""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.line()
    lines = parser.lines
    if not lines:
        return ""
    size = np.array([len(x[0]) for x in lines])
    inside = np.array([x[1] for x in lines])
    keep = np.zeros(len(lines), bool)
    # stretches of lines outside all containers, and of each container as a whole
    runs: list[tuple[int, int]] = []
    chosen: dict[int, int] = {}
    total = np.bincount(inside, size).astype(np.int64)
    for lo, hi in _surges(size, window, surge):
        for c in np.unique(inside[lo:hi][inside[lo:hi] > 0]).tolist():
            chosen[c] = int(total[c])
        free = np.flatnonzero(np.diff(np.concatenate([[0], (inside[lo:hi] == 0).astype(np.int8), [0]])))
        runs += [(lo + int(a), lo + int(b)) for a, b in zip(free[::2], free[1::2], strict=True)]
    if not runs and not chosen:
        keep[:] = inside > 0 if inside.any() else True
        return "\n\n".join(x[0] for x, k in zip(lines, keep, strict=True) if k)
    box = _boxes(lines, parser.outer)
    plain = [heading or text.endswith(_SENTENCE) for text, _, _, heading in lines]
    joined: list[tuple[int, int]] = []
    for lo, hi in runs:
        last = joined[-1][1] if joined else 0
        between = range(last, lo)
        near = joined and not inside[last:lo].any() and (box[last - 1] == box[lo] and all(box[i] == box[lo] for i in between) or all(plain[i] for i in between))
        if near:
            joined[-1] = joined[-1][0], hi
        else:
            joined.append((lo, hi))
    best = max(joined, key=lambda r: size[r[0] : r[1]].sum()) if joined else None
    if best is None or sum(chosen.values()) >= size[best[0] : best[1]].sum():
        keep = np.isin(inside, list(chosen))
        # short lines of other containers beside one that is kept
        for order, by in ((range(1, len(lines)), -1), (range(len(lines) - 2, -1, -1), 1)):
            for i in order:
                keep[i] |= bool(inside[i]) and plain[i] and keep[i + by]
    else:
        lo, hi = best
        edge = lambda i, by: not inside[i] and box[i] == box[by] and (plain[i] or size[i] >= surge / 4)
        while lo and edge(lo - 1, lo):
            lo -= 1
        while hi < len(lines) and edge(hi, hi - 1):
            hi += 1
        keep[lo:hi] = True
    return "\n\n".join(x[0] for x, k in zip(lines, keep, strict=True) if k)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in H.pieces(whole, "html"):
            texts = [main_text(h or "") for h in batch.column("html").to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"]
            )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of pages (page_id, url, html). Null or empty html, or none but markup: empty text."""
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(_extracted, f"page_id {kind}, url string, text string, n_chars long")
