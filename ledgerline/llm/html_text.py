"""Main text of HTML pages: parser events, text-to-tag ratio, smoothing, clustering.

The standard library's parser is fed piece by piece; its events build the lines
(blocks) of the page, each with its number of characters, the tags met inside it,
the characters in links and the container it stands in. Navigation, headers,
footers, sidebars, notices, adverts, forms, comments and hidden parts are known by
element, role, class or id and give no lines. A class or id is only a hint: whole
class tokens count (``has-sidebar`` is no sidebar), ids of headings and paragraphs do not, and a
block that is left out for its name, or as a form, comes back when it holds nearly all
text of the page (``NEARLY_ALL`` times what stands outside such blocks), as a wrapper does; one whose token is such
a name itself only with an article, main or h1 in it, and reader comments never. Over all the rest, the ratio of
characters to tags of each line is smoothed by a Gaussian; lines that are not mostly
links, with their own ratio and the smoothed one at or above the mean of the
smoothed ratios, form the clusters.

A container that holds a cluster is content. A main or article that holds one is
kept with all its lines, short ones too, so a heading, an intro or a one-word
paragraph is not lost; an article without a cluster gives the page no text by its
tag alone, and a card (an article named so, or with a linked heading) that holds
none is left out, also inside a main. Where an article or main has no h1, an h1
before it is kept, with what stands between; articles beside it that are no cards
are kept too. Elsewhere clusters are joined over their common container: its lines
and parts stay from wall to wall, where they are next to a cluster. Walls are lists
of links and copyright lines, and parts that hold one but no cluster; a container
that holds lines of a cluster itself keeps all its own lines, walls or not, and
below the body all its parts that are no walls.

Ties: equal ratios are judged alike, and lines stay in page order. Very long pages are parsed piece by piece; memory is
their lines'.

Defined results: null or empty html, and pages without text, give the empty text;
repeated rows are each extracted; an empty table gives an empty table; other input
columns are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.columns import free_name, texts

PIECE = 1 << 16
SIGMA = 1.0

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br img".split())
#: Elements whose text is never article text.
SKIPPED = frozenset(
    "head script style noscript template nav footer aside button select textarea svg math iframe object canvas "
    "audio video dialog menu".split())
#: Roles, and words of class or id names, that mark the same.
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
SKIPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr notice notices banner popup modal overlay "
    "newsletter subscribe subscription comment comments disqus replies respond share sharing social related recommended "
    "widget pagination pager login signup".split())
#: Of these, names of reader comments; and names that mean them only outside articles or on lists.
COMMENTS = frozenset("comment comments disqus replies respond".split())
THREADS = frozenset("discussion thread threads".split())
#: Compound class tokens that begin so tell what a block has, not what it is.
HAVING = frozenset("has with without no is not".split())
#: A block left out for its name is a wrapper when it holds so many times the text outside all such blocks.
NEARLY_ALL = 4
#: Elements to which name words are not applied: a class of the whole page says nothing of its parts.
WHOLE = frozenset(("html", "body", "main"))
CONTAINERS = frozenset(("article", "main", "section", "div", "td", "body", "center"))
#: Names of articles that stand for another page.
CARDS = frozenset("card cards teaser teasers preview excerpt summary tile thumb thumbnail".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_WORDS = re.compile(r"[a-z]+")
_RIGHTS = re.compile(r"(©|\(c\)|copyright\b)|.*\ball rights reserved\b", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Mark(NamedTuple):
    """A block that its name leaves out, unless it turns out to be a wrapper."""

    parent: int
    kind: str  # wrapper, exact or comments


class Line(NamedTuple):
    text: str
    tags: int
    container: int
    #: Characters and number of links.
    linked: int
    links: int
    #: The heading element it stands in.
    heading: str
    #: The innermost marked block it stands in, or -1.
    mark: int = -1

    @property
    def link_heavy(self) -> bool:
        return 2 * self.linked >= len(self.text) and self.heading != "h1"


class Container(NamedTuple):
    parent: int
    tag: str
    card: bool


class LineParser(HTMLParser):
    """Collects the lines of a page and the tree of its containers, parents first."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.containers = [Container(-1, "", False)]
        self.marks: list[Mark] = []
        self._holds: set[int] = set()  # marked blocks with an article, main or h1 in them
        self._open: list[tuple[str, bool, int, int]] = []  # element, skipped, container, marked block
        self._mark = -1
        self._count: Counter[str] = Counter()
        self._skip = 0
        self._text: list[str] = []
        self._tags = 0
        self._linked = 0
        self._links = 0
        self._at = 0
        self._heading = ""

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                self.lines.append(Line(text, self._tags, self._at, self._linked, self._links, self._heading, self._mark))
            self._text.clear()
        self._tags = self._linked = self._links = 0

    def _boilerplate(self, tag: str, attrs) -> str:
        """``skipped`` (no text at all), the kind of a marked block, or the empty string."""
        in_article = self._count["article"] > 0
        if tag in SKIPPED or (tag == "header" and not in_article):
            return "skipped"
        if tag in WHOLE:
            return ""
        kind = "wrapper" if tag == "form" else ""
        for name, value in attrs:
            value = value or ""
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _HIDDEN.search(value)):
                return "skipped"
            if name == "role" and value.lower() in SKIPPED_ROLES:
                return "skipped"
            if name == "class" or (name == "id" and tag not in HEADINGS and tag != "p"):
                kind = max(kind, self._named(tag, value.lower(), in_article), key=("", "wrapper", "exact", "comments").index)
        return "skipped" if kind and tag in INLINE else kind

    def _named(self, tag: str, value: str, in_article: bool) -> str:
        tokens = value.split()
        if tag == "article":
            exact = {"comment", "comments", "reply", "replies", "related", "ad", "advert", "promo"}.intersection(tokens)
            return ("comments" if exact - {"related", "ad", "advert", "promo"} else "exact") if exact else ""
        parts = [_WORDS.findall(t) for t in tokens]
        words = {w for part in parts if len(part) == 1 or part and part[0] not in HAVING for w in part}
        if words & COMMENTS or (words & THREADS and (not in_article or tag in ("ol", "ul"))):
            return "comments"
        names = SKIPPED_WORDS if in_article or tag == "h1" else SKIPPED_WORDS | {"header"}
        if words & names:
            return "exact" if any(len(part) == 1 and part[0] in names for part in parts) else "wrapper"
        return ""

    def kept_lines(self) -> list[Line]:
        """Lines outside marked blocks, and those of marked blocks that are wrappers."""
        weight = [0] * len(self.marks)
        outside = 0
        for line in self.lines:
            if not line.link_heavy:
                if line.mark < 0:
                    outside += len(line.text)
                else:
                    weight[line.mark] += len(line.text)
        whole = weight.copy()
        for m in range(len(self.marks) - 1, -1, -1):
            if self.marks[m].parent >= 0:
                whole[self.marks[m].parent] += whole[m]
        out = [False] * len(self.marks)
        for m, (parent, kind) in enumerate(self.marks):  # parents first
            out[m] = (parent >= 0 and out[parent]) or kind == "comments" or (kind == "exact" and m not in self._holds) or (
                whole[m] < NEARLY_ALL * outside or not whole[m])
            if not out[m]:
                outside += weight[m]
        return [line for line in self.lines if line.mark < 0 or not out[line.mark]]

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self._flush()
            self._close_implied(tag)
        elif tag == "br":
            self._text.append(" ")
        self._tags += 1
        if tag in VOID:
            return
        if tag == "a":
            if self._open and self._open[-1][0] == "a":  # links do not nest
                self._pop_to("a")
            self._links += not self._skip
        found = self._boilerplate(tag, attrs)
        skipped = found == "skipped"
        container, mark = self._open[-1][2:] if self._open else (0, -1)
        if found and not skipped:
            self.marks.append(Mark(mark, found))
            mark = len(self.marks) - 1
        if tag in ("article", "main", "h1") and not self._skip:
            above = mark
            while above >= 0 and above not in self._holds:
                self._holds.add(above)
                above = self.marks[above].parent
        if tag in CONTAINERS:
            names = " ".join(value or "" for name, value in attrs if name in ("class", "id")).lower()
            card = tag == "article" and not CARDS.isdisjoint(_WORDS.findall(names))
            self.containers.append(Container(container, tag, card))
            container = len(self.containers) - 1
        self._open.append((tag, skipped, container, mark))
        self._count[tag] += 1
        self._skip += skipped
        self._at, self._mark = container, mark
        if tag not in INLINE:
            self._heading = tag if tag in HEADINGS else ""

    def _close_implied(self, tag: str) -> None:
        """A block ends an open paragraph; list items, cells and rows end their like."""
        if self._open and self._open[-1][0] not in INLINE and self._open[-1][0] not in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
            return
        if self._count["p"] and self._inside("p", ("article", "div", "section", "td", "li", "blockquote", "main")):
            self._pop_to("p")
        for like, within in ((("li",), ("ul", "ol", "menu")), (("dt", "dd"), ("dl",)), (("td", "th"), ("tr", "table")), (("tr",), ("table",))):
            if tag in like:
                for other in like:
                    if self._count[other] and self._inside(other, within):
                        self._pop_to(other)

    def _inside(self, tag: str, stops: tuple[str, ...]) -> bool:
        for name, *_ in reversed(self._open):
            if name == tag:
                return True
            if name in stops:
                return False
        return False

    def _pop_to(self, tag: str) -> None:
        while self._open:
            name, skipped, *_ = self._open.pop()
            self._count[name] -= 1
            self._skip -= skipped
            if name == tag:
                break
        self._at, self._mark = self._open[-1][2:] if self._open else (0, -1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self._flush()
            self._heading = ""
        self._tags += 1
        if self._count[tag]:
            self._pop_to(tag)

    def handle_data(self, data):
        if not self._skip:
            self._text.append(data)
            if self._count["a"]:
                self._linked += len(" ".join(data.split()))

    def close(self):
        super().close()
        self._flush()


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing with the ends repeated."""
    radius = max(1, int(np.ceil(2 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return np.convolve(np.pad(values, radius, mode="edge"), kernel / kernel.sum(), mode="valid")


class Page:
    """Lines and containers of a page with what is known of each container's whole subtree."""

    def __init__(self, lines: list[Line], containers: list[Container], strong: list[bool]):
        self.lines, self.containers, self.strong = lines, containers, strong
        n = len(containers)
        self.n_lines, self.n_strong, self.own_strong = [0] * n, [0] * n, [0] * n
        self.outside = [0] * n  # strong lines in no article or main
        self.has_h1, self.linked_heading = [False] * n, [False] * n
        self.wall = [False] * n
        self.walls = self._walls()
        self.items: list[list[tuple[int, int, bool]]] = [[] for _ in containers]  # first line, number, is a container
        first = [len(lines)] * n
        for i, line in enumerate(lines):
            c = line.container
            first[c] = min(first[c], i)
            self.n_lines[c] += 1
            self.own_strong[c] += strong[i]
            self.has_h1[c] |= line.heading == "h1"
            self.linked_heading[c] |= line.heading != "" and 2 * line.linked >= len(line.text)
            self.wall[c] |= self.walls[i]
            self.items[c].append((i, i, False))
        for c in range(n - 1, -1, -1):
            self.n_strong[c] += self.own_strong[c]
            self.outside[c] = 0 if containers[c].tag in ("article", "main") else self.outside[c] + self.own_strong[c]
            p = containers[c].parent
            if p >= 0 and self.n_lines[c]:
                first[p] = min(first[p], first[c])
                self.n_lines[p] += self.n_lines[c]
                self.n_strong[p] += self.n_strong[c]
                self.outside[p] += self.outside[c]
                self.has_h1[p] |= self.has_h1[c]
                self.linked_heading[p] |= self.linked_heading[c]
                self.wall[p] |= self.wall[c]
                self.items[p].append((first[c], c, True))
        for items in self.items:
            items.sort()

    def _walls(self) -> list[bool]:
        """Lines that are lists of links (several links, or link lines on end), or copyright lines."""
        heavy = [line.link_heavy for line in self.lines]
        at = [line.container for line in self.lines]
        beside = [False] * len(heavy)
        for i in range(1, len(heavy)):
            if heavy[i - 1] and heavy[i] and at[i - 1] == at[i]:
                beside[i - 1] = beside[i] = True
        return [(h and (b or line.links > 1)) or _RIGHTS.match(line.text) is not None
                for h, b, line in zip(heavy, beside, self.lines, strict=True)]

    def is_card(self, c: int) -> bool:
        """An article that holds no cluster and stands for another page."""
        at = self.containers[c]
        return at.tag == "article" and not self.n_strong[c] and (at.card or self.linked_heading[c])

    def content(self) -> list[int]:
        """Numbers of the lines that are content, in page order."""
        kept: list[int] = []
        todo = [(0, False)]  # container, whole
        while todo:
            c, whole = todo.pop()
            whole = whole or self.containers[c].tag in ("article", "main")
            for _, i, is_container in self.items[c] if whole else self.chosen(c):
                if not is_container:
                    kept.append(i)
                elif not self.is_card(i):
                    todo.append((i, whole or not self.n_strong[i]))
        return sorted(kept)

    def chosen(self, c: int) -> list[tuple[int, int, bool]]:
        """Items of a container outside articles and main that are content."""
        items = self.items[c]
        strong = [bool(self.n_strong[i] if is_container else self.strong[i]) for _, i, is_container in items]
        wall = [not s and (self.wall[i] if is_container else self.walls[i])
                for s, (_, i, is_container) in zip(strong, items, strict=True)]
        article = [is_container and self.containers[i].tag == "article" for _, i, is_container in items]
        region = self.own_strong[c] > 0
        whole = region and self.containers[c].tag not in ("", "body")
        marked = not self.outside[c]  # all clusters stand in articles or mains: the rest is no text
        keep = [s or (region and not is_container) or (whole and not w)
                for s, w, (_, _, is_container) in zip(strong, wall, items, strict=True)]
        for order in (range(len(items)), range(len(items) - 1, -1, -1)):
            near = False
            for j in order:
                near = strong[j] or (near and not wall[j])
                keep[j] |= near and (article[j] or not marked)
        if True in strong and marked:
            lead = strong.index(True)
            if not self.has_h1[items[lead][1]]:
                h1 = [j for j in range(lead) if self.item_has_h1(items[j])]
                for j in range(h1[-1], lead) if h1 else ():
                    keep[j] |= not self.is_link_item(items[j])
        return [item for item, k in zip(items, keep, strict=True) if k]

    def item_has_h1(self, item: tuple[int, int, bool]) -> bool:
        _, i, is_container = item
        return self.has_h1[i] if is_container else self.lines[i].heading == "h1"

    def is_link_item(self, item: tuple[int, int, bool]) -> bool:
        first, i, is_container = item
        return all(x.link_heavy for x in self.lines[first:first + (self.n_lines[i] if is_container else 1)])


def main_text(html: str, sigma: float = SIGMA) -> str:
    """Lines of the content of a page, joined by one newline."""
    parser = LineParser()
    for i in range(0, len(html), PIECE):
        parser.feed(html[i:i + PIECE])
    if re.match(r"<[a-zA-Z/!?]", parser.rawdata):  # the page ends inside a tag or comment
        parser.rawdata = ""
    parser.close()
    lines = parser.kept_lines()
    if not lines:
        return ""
    ratio = np.array([len(line.text) / (line.tags + 1) for line in lines])
    smoothed = smooth(ratio, sigma)
    mean = smoothed.mean() - 1e-9
    high = (smoothed >= mean).tolist()
    strong = [h and r >= mean and not line.link_heavy for h, r, line in zip(high, ratio.tolist(), lines, strict=True)]
    page = Page(lines, parser.containers, strong if any(strong) else high)
    return "\n".join(lines[i].text for i in page.content())


def extract_main_text(df: DataFrame, html_col: str = "html", sigma: float = SIGMA, result: str = "main_text") -> DataFrame:
    """``df`` with the main text of each page."""
    @F.arrow_udf("string")
    def extract(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in column:
            yield pa.array([main_text(h, sigma) for h in texts(part)], pa.string())

    return df.withColumn(free_name(df, result), extract(f"`{html_col}`"))


def op7_html_text(pages: DataFrame) -> DataFrame:
    """Main text of every page."""
    out = extract_main_text(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
