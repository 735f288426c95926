"""Main text of web pages: parser events, text-to-tag ratios, smoothing and clustering."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import pick

#: Characters fed to the parser at a time.
FEED = 1 << 16
#: Width of the Gaussian, in lines, and the share of the smoothed ratios' deviation from which a line is content.
SIGMA, LEAST = 1.5, 0.5
#: The share of the mean from which a line is content by its own ratio.
FIRM = 0.25
#: A container is entered while it holds this share of the content; articles beside an article count from the other share.
MOST, FAIR = 0.85, 0.05
#: The share that an article needs if it has all headlines.
HEADED = 0.25

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
BOXES = frozenset("article body center div main section".split())
CONTAINERS = BOXES | frozenset("table tbody td tr".split())
HEADINGS = frozenset("h1 h2".split())
NOISE = frozenset(
    "aside audio button canvas datalist dialog embed fieldset footer head iframe input map menu nav noscript object script select"
    " style svg template textarea title video".split()
)
NOISE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Names of elements that are noise unless they hold most of the content, and names that are so only where no line of theirs is content by its own ratio.
NOISE_NAMES = re.compile(
    r"(?:^|[\s_-])(ad|ads|advert|adverti\w+|adsense|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|gdpr|masthead"
    r"|menu|modal|nav|navbar|navigation|newsletter|notices?|overlay|pagination|pager|popup|promo|promotion|replies|responses|share|sharing|sidebar"
    r"|skip|social|sponsor|sponsored|subscribe|toolbar)(?=$|[\s_-])",
    re.IGNORECASE,
)
WEAK_NAMES = re.compile(r"(?:^|[\s_-])(adv|byline-links|disclaimer|header|related|tags|widget)(?=$|[\s_-])", re.IGNORECASE)


@dataclass
class Node:
    """A container, or an element whose names or tag may make it noise; nodes are numbered as they open."""

    parent: int
    tag: str
    words: frozenset[str] = frozenset()
    weak: bool = False
    last: int = 0  # greatest number inside


@dataclass
class Line:
    text: str
    ratio: float  # characters outside links to tags
    linked: bool  # most of it is links
    node: int
    noise: bool  # by its tags alone
    heading: bool


class _Lines(HTMLParser):
    """Cuts a page into lines at block tags, and keeps the tree of what holds them.

    Every tag costs a fixed time, and every element is left once, so that a page costs time
    in proportion to its length however deep it is.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int]] = []  # tag, noise, number of its node or -1
        self.held: Counter = Counter()  # open elements by tag
        self.nodes, self.path, self.lines = [Node(-1, "")], [0], []
        self.text: list[str] = []
        self.tags, self.noise, self.links = 0, 0, 0

    def end_line(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                links = min(self.links, len(text))
                heading = any(self.held[h] for h in HEADINGS)
                self.lines.append(Line(text, 0.0 if self.noise else (len(text) - links) / max(1, self.tags), 2 * links > len(text), self.path[-1], self.noise > 0, heading))
            self.text = []
        self.tags = self.links = 0

    def _pop(self, at: int) -> None:
        if any(noise for _, noise, _ in self.open[at:]):
            self.end_line()
        for tag, noise, node in reversed(self.open[at:]):
            self.held[tag] -= 1
            self.noise -= noise
            if node >= 0:
                self.nodes[node].last = len(self.nodes) - 1
                self.path.pop()
        del self.open[at:]

    def _close_before(self, tag: str) -> None:
        """A block ends an open paragraph, an item the item before it."""
        ends = ("p", "li") if tag == "li" else ("p",) if tag != "br" else ()
        if not any(self.held[t] for t in ends):
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in ends:
                self._pop(i)
                return
            if self.open[i][0] in CONTAINERS or self.open[i][0] in ("ul", "ol"):
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
            self._close_before(tag)
        self.tags += 1
        if tag in VOID:
            return
        own = dict(attrs)
        noise = tag in NOISE or (tag == "header" and not self.held["article"]) or (own.get("role") or "").lower() in NOISE_ROLES or "hidden" in own
        words, weak = frozenset(), False
        if not noise and tag not in ("html", "body", "article", "main"):
            named = " ".join(filter(None, (own.get("class"), own.get("id"))))
            words = frozenset(w.lower() for w in NOISE_NAMES.findall(named)) | ({"<form>"} if tag == "form" else frozenset())
            weak = not words and bool(WEAK_NAMES.search(named))
        if noise or words or weak:
            self.end_line()
        node = -1
        if tag in CONTAINERS or words or weak:
            node = len(self.nodes)
            self.nodes.append(Node(self.path[-1], tag, words, weak))
            self.path.append(node)
        self.open.append((tag, noise, node))
        self.held[tag] += 1
        self.noise += noise

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # in HTML a slash doesn't close an element

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        if not self.held[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                if self.open[i][2] >= 0:
                    self.end_line()
                self._pop(i)
                break

    def handle_data(self, data: str) -> None:
        self.text.append(data)
        if self.held["a"]:
            self.links += len(data)

    def read(self, html: str) -> None:
        """Feed a whole page, in parts that grow with what waits for its end, so that none is looked at often."""
        at = 0
        while at < len(html):
            size = max(FEED, len(self.rawdata))
            self.feed(html[at : at + size])
            at += size
        if self.rawdata[:1] == "<" and len(self.rawdata) > 1:  # a tag or comment that never ends holds no text
            self.rawdata = ""
        self.close()
        self.end_line()
        for node in self.path:
            self.nodes[node].last = len(self.nodes) - 1


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """The ratios under a Gaussian, which at the ends weighs only what is there."""
    reach = int(np.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    inner = slice(reach, reach + len(ratios))
    return np.convolve(ratios, kernel)[inner] / np.convolve(np.ones(len(ratios)), kernel)[inner]


def _within(nodes: list[Node], lines: list[Line], values: list[int]) -> np.ndarray:
    """The sum of the lines' values in each node and all nodes inside."""
    out = np.zeros(len(nodes), np.int64)
    np.add.at(out, [x.node for x in lines], values)
    for i in range(len(nodes) - 1, 0, -1):  # what is inside has a greater number
        out[nodes[i].parent] += out[i]
    return out


def _guilty(nodes: list[Node], weights: np.ndarray, strong: np.ndarray) -> list[bool]:
    """Which nodes lie in an element that is noise by its names, or is one.

    Names only tell the odds: an element that holds most of the content isn't noise for its
    names or for being a form, and where all elements of a name hold it together none is;
    a weak name counts only where no line is content by its own ratio.
    """
    least = MOST * weights[0]
    own = [bool(n.words) and w < least or n.weak and not c and w < least for n, w, c in zip(nodes, weights, strong, strict=True)]
    by_word: Counter = Counter()
    above: list[frozenset[str]] = []
    for n, w, g in zip(nodes, weights, own, strict=True):
        seen = above[n.parent] if above else frozenset()
        for word in n.words - seen if g else ():
            by_word[word] += w
        above.append(seen | n.words if g else seen)
    for i, n in enumerate(nodes):
        own[i] = i > 0 and (own[n.parent] or own[i] and (n.weak or any(by_word[word] < least or not least for word in n.words)))
    return own


def _region(nodes: list[Node], weights: np.ndarray, headings: np.ndarray) -> tuple[list[int], bool, list[int]]:
    """The nodes side by side that hold the text: the innermost container that holds most of
    the content and no fewer headlines, or the articles that do together; whether it's articles; what these stand in.
    An article with all headlines needs a smaller share. An article isn't entered further."""
    inside: list[list[int]] = [[] for _ in nodes]
    box = [0] * len(nodes)  # the nearest container around
    for i, n in enumerate(nodes[1:], 1):
        box[i] = n.parent if n.parent == 0 or nodes[n.parent].tag in CONTAINERS else box[n.parent]
        if n.tag in CONTAINERS:
            inside[box[i]].append(i)
    kept, held, seen = [0], weights[0], headings[0]
    while True:
        own = [i for k in kept for i in inside[k]]
        best = max(own, key=lambda i: (weights[i], -i), default=None)
        if best is None:
            return kept, False, kept
        headed = next((i for i in own if nodes[i].tag == "article" and 0 < seen == headings[i] and weights[i] >= HEADED * held), None)
        best = best if headed is None else headed
        tag, new = nodes[best].tag, [best]
        if tag == "article":
            # Parts of one text, or a text with others of a fair share; with a text that holds most, teasers don't count.
            new = [i for i in own if i == best or nodes[i].tag == "article" and (weights[best] < MOST * held or weights[i] >= FAIR * held)]
        within = sum(weights[i] for i in new)
        if within < MOST * held and tag != "body" and headed is None:
            return kept, False, kept
        if tag not in ("article", "main", "body") and sum(headings[i] for i in new) < seen:
            return kept, False, kept
        around, kept, held, seen = kept, new, within, sum(headings[i] for i in new)
        if tag == "article":
            return kept, True, around


def _headline(nodes: list[Node], lines: list[Line], depth: np.ndarray, around: list[int]) -> int:
    """The line of the last heading before an article without one, right in what the article stands in or in a box there; else -1."""
    first = next((i for i, x in enumerate(lines) if depth[x.node]), 0)
    if any(x.heading and depth[x.node] for x in lines):
        return -1
    near = [i for i in range(first) if lines[i].heading and (lines[i].node in around or nodes[lines[i].node].parent in around)]
    return near[-1] if near else -1


def main_text(html: str | None) -> str:
    """The article's text.

    Lines, cut at block tags, have a ratio of characters outside links to tags. Smoothed over
    neighbours, ratios from a share of their deviation on mark content; what tags, roles and
    names say only shifts the odds (see :func:`_guilty`; lists of links, forms, scripts and
    the like by their tags have no ratio at all). Content selects the region (see
    :func:`_region`). In it, lines go that are mostly links where nothing around them is
    content by its own ratio; outside of an article, lines below the threshold go too, and
    those at the region's ends, unless they are headlines, whose box holds no content.
    Short lines between content, in one box with it, or right in the region stay.
    """
    parser = _Lines()
    parser.read(html or "")
    nodes, lines = parser.nodes, parser.lines
    if all(x.noise for x in lines):
        return ""
    ratios = smoothed(np.array([x.ratio for x in lines]))
    least = LEAST * ratios.std()
    rows = [(x, r >= least) for x, r in zip(lines, ratios, strict=True) if not x.noise]
    lines, content = [x for x, _ in rows], [c for _, c in rows]
    weights = [len(x.text) if c else 0 for x, c in rows]
    if not any(weights):
        weights = [len(x.text) for x in lines]
    firm = max(least, FIRM * ratios.mean())
    strong = [x.ratio >= firm and not x.linked for x in lines]
    bad = _guilty(nodes, _within(nodes, lines, weights), _within(nodes, lines, strong))
    if not all(bad[x.node] for x in lines):
        rows = [(x, c, w, s) for x, c, w, s in zip(lines, content, weights, strong, strict=True) if not bad[x.node]]
        lines, content, weights, strong = (list(v) for v in zip(*rows, strict=True))
    if not any(weights):
        weights = [len(x.text) for x in lines]
    kept, article, around = _region(nodes, _within(nodes, lines, weights), _within(nodes, lines, [x.heading for x in lines]))
    depth = np.zeros(len(nodes) + 1, np.int64)  # how many of the kept nodes are around each
    for k in kept:
        depth[k] += 1
        depth[nodes[k].last + 1] -= 1
    depth = depth.cumsum()
    headline = _headline(nodes, lines, depth, around) if article and len(kept) == 1 else -1
    rows = [(x, c, s) for i, (x, c, s) in enumerate(zip(lines, content, strong, strict=True)) if depth[x.node] or i == headline]
    lines, content, strong = (list(v) for v in zip(*rows, strict=True))
    box = list(range(len(nodes)))  # the nearest box around, so that the cells of a table count with what is around it
    for i, n in enumerate(nodes[1:], 1):
        box[i] = i if n.tag in BOXES else box[n.parent]
    full = {box[x.node] for x, s in zip(lines, strong, strict=True) if s} | {box[k] for k in kept}
    stops = [i for i, x in enumerate(lines) if strong[i] or not x.linked and (x.heading or box[x.node] in full)]
    if not stops:
        return " ".join(x.text for x in lines)
    out = []
    for i, x in enumerate(lines):
        beside = box[x.node] in full
        ends = stops[0] <= i <= stops[-1]
        if article:
            stays = beside or not x.linked or i == 0 and headline >= 0
        else:
            stays = ends and (beside and (content[i] or not x.linked) or not x.linked and (content[i] or x.heading))
        if stays:
            out.append(x.text)
    return " ".join(out)


@F.pandas_udf(StringType())
def extract(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield pd.Series([main_text(h) for h in batch], dtype="object")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars for every row of ``pages``.

    A null page counts as empty and has the empty text, as has a page without content.
    Null ids and urls stay; rows that repeat are each returned; other columns, whatever
    their names, are left out; an empty table gives no rows. Memory is that of one page.
    """
    rows = pick(pages, id_col, url_col, html_col)
    done = rows.select(id_col, url_col, extract(html_col).alias("text"))
    return done.select(id_col, url_col, "text", F.length("text").cast("long").alias("n_chars"))
