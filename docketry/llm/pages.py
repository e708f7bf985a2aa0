"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clusters.

The standard-library parser is fed piece by piece. Its events make lines (blocks)
with their text and tags, and drop elements that are furniture by name. The smoothed
ratio of text to tags marks the lines of content. An element whose class names
furniture is only a suspect: the whole page read, it stays if it holds the content.
The region is the container that holds the content lines, whose other lines (headings,
short paragraphs) belong to the text as well.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import map_batches

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
FURNITURE = frozenset(
    "head script style noscript template svg math iframe object canvas audio video nav footer aside button select textarea dialog menu".split()
)
CONTAINERS = frozenset("html body main article section div td table center blockquote".split())
PARTS = frozenset("table td blockquote".split())  # containers of a part of a text
#: words in class, id or role that make an element suspect of being furniture
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar footer masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup "
    "comment comments commentlist reply replies respond disqus related recommended share sharing social toolbar pagination pager skip".split()
)
WORDS = re.compile(r"[a-z]+")


class Line:
    __slots__ = ("text", "tags", "holder", "suspect")

    def __init__(self, holder: int, suspect: int):
        self.text: list[str] = []
        self.tags = 0
        self.holder = holder
        self.suspect = suspect


class Lines(HTMLParser):
    """Lines of text outside furniture, each with its tags and the innermost container and suspect around it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, bool, bool]] = []  # name, furniture, suspect, container
        self.open: Counter[str] = Counter()
        self.names = [""]  # of containers; number 0 is the page
        self.parents = [0]
        self.holder = 0
        self.above = [0]  # of suspects: the suspect around each; number 0 is none
        self.depths = [0]
        self.suspect = 0
        self.within = [0]  # of containers: the suspect around each
        self.hidden = 0
        self.kept: list[Line] = []
        self.line = Line(0, 0)

    def end_line(self) -> None:
        if self.line.text:
            self.line.text = ["".join(self.line.text)]
            if not self.line.text[0].isspace():
                self.kept.append(self.line)
        self.line = Line(self.holder, self.suspect)

    def furniture(self, name: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool]:
        """Whether an element is furniture, and whether it may be, by its class or as a form."""
        if name in FURNITURE:
            return True, False
        inside = self.open["article"] or self.open["main"]
        if name == "header" and not inside:
            return True, False
        suspect = name == "form"
        for key, value in attrs:
            value = (value or "").lower()
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
                return True, False
            if key in ("class", "id", "role") and name not in ("html", "body", "main", "article"):
                found = WORDS.findall(value)
                suspect = suspect or not NAMES.isdisjoint(found) or not inside and "header" in found
        return False, suspect

    def handle_starttag(self, tag, attrs):
        self.line.tags += 1
        if tag not in INLINE:
            self.end_line()
        if tag in VOID:
            return
        (hide, doubt), hold = self.furniture(tag, attrs), tag in CONTAINERS
        if hide or doubt:
            self.end_line()
        self.stack.append((tag, hide, doubt, hold))
        self.open[tag] += 1
        self.hidden += hide
        if doubt:
            self.above.append(self.suspect)
            self.depths.append(self.depths[self.suspect] + 1)
            self.suspect = self.line.suspect = len(self.above) - 1
        if hold:
            self.names.append(tag)
            self.parents.append(self.holder)
            self.within.append(self.suspect)
            self.holder = self.line.holder = len(self.names) - 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math", "iframe", "script", "canvas"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.line.tags += 1
        if tag not in INLINE:
            self.end_line()
        if tag in VOID or not self.open[tag]:
            return
        if tag in INLINE:  # an inline end closes no block
            at = len(self.stack) - 1
            while self.stack[at][0] != tag and self.stack[at][0] in INLINE:
                at -= 1
            if self.stack[at][0] != tag:
                return
        while self.stack:
            name, hide, doubt, hold = self.stack.pop()
            self.open[name] -= 1
            self.hidden -= hide
            if hold:
                self.holder = self.parents[self.holder]
            if hide or doubt:
                self.end_line()
            if doubt:
                self.suspect = self.above[self.suspect]
            if name == tag:
                break
        self.line.holder, self.line.suspect = self.holder, self.suspect

    def handle_data(self, data):
        if not self.hidden:
            self.line.text.append(data)


def lines_of(html: str, piece: int = 1 << 16) -> Lines:
    parser = Lines()
    for at in range(0, len(html), piece):
        parser.feed(html[at : at + piece])
    parser.close()
    parser.end_line()
    return parser


def content_lines(lines: list[Line], sigma: float = 1.0, radius: int = 2) -> np.ndarray:
    """Lines whose smoothed ratio of text to tags reaches the standard deviation of the smoothed ratios."""
    ratio = np.array([len(x.text[0]) / max(1, x.tags) for x in lines])
    kernel = np.exp(-np.square(np.arange(-radius, radius + 1)) / (2 * sigma * sigma))
    weight = np.convolve(np.ones(len(ratio)), kernel, "full")[radius:-radius]
    smooth = np.convolve(ratio, kernel, "full")[radius:-radius] / weight
    return smooth >= min(smooth.std(), smooth.max())


def held_by(places: list[int], sizes: list[int], parents: list[int]) -> list[int]:
    """Sum of the sizes placed in each element or below; parents are numbered before their children, 0 holds all."""
    held = [0] * len(parents)
    for place, n in zip(places, sizes, strict=True):
        held[place] += n
    for c in range(len(held) - 1, 0, -1):
        held[parents[c]] += held[c]
    return held


def marked_sizes(lines: list[Line]) -> list[int]:
    """Length of each content line, 0 for the others."""
    return [len(x.text[0]) if marked else 0 for x, marked in zip(lines, content_lines(lines), strict=True)]


def without_suspects(parser: Lines, own: float = 0.2) -> list[Line]:
    """Lines outside the suspects that do not hold the content.

    The page's own article or main is the first among those within fewest suspects that
    hold at least a share `own` of the content; suspects around it stay. On a page
    without one, suspects stay that hold most of the content, and all of them if the
    others would take more of it than they leave.
    """
    lines = parser.kept
    if not any(x.suspect for x in lines):
        return lines
    sizes = marked_sizes(lines)
    held = held_by([x.holder for x in lines], sizes, parser.parents)
    named = [c for c, name in enumerate(parser.names) if name in ("article", "main") and held[c] and held[c] >= own * held[0]]
    stay = [False] * len(parser.above)
    if named:
        at = parser.within[min(named, key=lambda c: parser.depths[parser.within[c]])]
        while at:
            stay[at] = True
            at = parser.above[at]
    else:
        weights = held_by([x.suspect for x in lines], sizes, parser.above)
        stay = [2 * w > weights[0] for w in weights]
    stay[0] = True
    for i in range(1, len(stay)):
        stay[i] = stay[i] and stay[parser.above[i]]
    left = sum(n for x, n in zip(lines, sizes, strict=True) if stay[x.suspect])
    if not named and 2 * left < held[0]:
        return lines
    return [x for x in lines if stay[x.suspect]]


def region(parser: Lines, lines: list[Line], share: float = 0.7) -> list[int]:
    """Numbers of the containers of the content.

    The outermost articles with content, if they hold `share` of it, else the outermost
    mains that do; else the smallest container that holds all of it, the page at last. A
    table, a cell or a quotation is part of a text, not its container.
    """
    held = held_by([x.holder for x in lines], marked_sizes(lines), parser.parents)
    for name in ("article", "main"):
        inside, found = [False] * len(held), []
        for c in range(1, len(held)):
            inside[c] = inside[parser.parents[c]] or parser.names[c] == name
            if inside[c] and not inside[parser.parents[c]] and held[c]:
                found.append(c)
        if found and sum(held[c] for c in found) >= share * held[0]:
            return found
    part = [False] * len(held)
    for c in range(1, len(held)):
        part[c] = part[parser.parents[c]] or parser.names[c] in PARTS
    return [max(c for c, n in enumerate(held) if n == held[0] and not part[c])]


def main_text(html: str | None) -> str:
    """Main text of one whole page; white space is one space, blocks are joined by one space."""
    parser = lines_of(html or "")
    lines = without_suspects(parser)
    if not lines:
        return ""
    found = set(region(parser, lines))
    inside = [False] * len(parser.names)
    for c, parent in enumerate(parser.parents):
        inside[c] = c in found or inside[parent]
    return " ".join(" ".join(x.text[0].split()) for x in lines if inside[x.holder])


def extract(pages: DataFrame, html: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, url, text, n_chars), one row per input row.

    Null and empty html give an empty text; markup that never closes is read to its
    end; a page without any text outside furniture gives an empty text; repeated rows
    give equal texts; ids and urls may be null and are passed on; other columns are not read.
    """

    def make(keys, urls, texts):
        return keys, urls, [main_text(t) for t in texts]

    kind = pages.schema[key].dataType.simpleString()
    narrow = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    found = map_batches(narrow, ["page_id", "url", "html"], "html", make, f"page_id {kind}, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
