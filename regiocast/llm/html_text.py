"""Main text of web pages by text-to-tag ratio.

The standard library's streaming HTML parser sends tag and text events; they
are turned into lines (blocks of running text between block-level tags), each
with its characters and tags.  The text-to-tag ratio of the lines is smoothed
by a Gaussian and split into two clusters by a threshold (two-means), and the
lines above it select the smallest region of the page that holds nearly all of
them.  An article or main mark around that region says how far it reaches, and
marks settle a page whose chosen lines have no region of their own; elsewhere
the region grows over adjoining text.  Lines below structural marks for menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments have no ratio and never belong to a region, except that a form or a
marked wrapper which holds the article, or next to all running text of the
page, is layout.

Cases: a NULL or empty page, or one without content, gives an empty text;
malformed and truncated markup is read as far as it goes; rows that repeat
keep one output row each; other columns pass through, one named like the
output is replaced; an empty table gives an empty one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from regiocast.llm.common import small_batches, texts_of

#: How HTML names things.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never content.
OUTSIDE = frozenset("script style noscript template head title button select textarea option label iframe object svg math canvas audio video dialog".split())
#: Elements around the article, unless one wraps it.
BESIDE = frozenset("nav menu footer aside form search".split())
#: Words of class, id and role attributes that mark text around the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox adslot sponsor sponsored sponsors promo promotion banner nav navbar navigation menu "
    "topbar toolbar breadcrumb breadcrumbs pager pagination header masthead footer contentinfo copyright sidebar aside complementary rail widget widgets cookie "
    "cookies consent gdpr notice notices notification alert warning popup modal overlay dialog newsletter subscribe subscription signup login register search form "
    "share sharing social related recommended recommendations trending popular comment comments commentlist disqus replies reply respond responses discussion "
    "hidden skip legal disclaimer paywall".split()
)
#: Marks of readers' own text, of which a page may hold more than of its article.
READERS = frozenset("comment comments commentlist disqus replies reply respond responses discussion".split())
#: Words that make the next one a property of the layout, as in has-sidebar.
HAS = frozenset("has have is no not with without".split())
#: Characters of running text that a marked wrapper holds at least, and the share of what is unmarked beside it at most.
WRAPPER, BESIDES = 200, 0.25
_MARK = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_UNFINISHED = re.compile(r"<[a-zA-Z/!?]")
#: Elements that a stray end tag does not close from within.
BOUNDS = frozenset(("article", "main", "body"))
SIGMA, REACH = 1.0, 3
#: Share of the chosen text that its region holds at least.
NEARLY = 0.9
_KERNEL = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(-REACH, REACH + 1)]


class Line:
    """A block of running text: what it says, how much of it is links, how many tags it took, and where it stands."""

    __slots__ = ("linked", "mark", "outside", "region", "tags", "text")

    def __init__(self, text: str, linked: int, tags: int, region: int, outside: bool, mark: int):
        self.text, self.linked, self.tags, self.region, self.outside, self.mark = text, linked, tags, region, outside, mark

    @property
    def ratio(self) -> float:
        return 0.0 if self.outside else len(self.text) / max(1, self.tags)


class Mark:
    """An element that names itself as something beside the article: the one around it, its kind, and what it holds."""

    __slots__ = ("article", "form", "inner", "outer", "own", "readers", "size")

    def __init__(self, outer: int, words: set[str], inner: bool):
        self.outer, self.inner, self.form, self.readers = outer, inner, words == {"form"}, not READERS.isdisjoint(words)
        self.own = self.size = self.article = 0


def _marks(attrs: list[tuple[str, str | None]]) -> set[str]:
    """Words of the attributes that mark text around the article."""
    found = set()
    for name, value in attrs:
        if value and name in ("class", "id", "role"):
            for one in value.split():
                words = _MARK.findall(_CAMEL.sub(" ", one).lower())
                found.update(w for w, before in zip(words, ["", *words], strict=False) if before not in HAS and w in MARKS)
    return found


def _hidden(attrs: list[tuple[str, str | None]]) -> bool:
    return any(name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and value and _HIDDEN.search(value.lower())) for name, value in attrs)


class Reader(HTMLParser):
    """Collects the lines of a page from the parser's events."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[tuple[str, bool, int, int]] = []  # (tag, outside, region, mark) of what is open
        self.marks: list[Mark] = []
        self.plain: set[int] = set()  # article and main regions without a mark of their own
        self.parents, self.names = [-1], ["page"]  # of regions
        self.parts: list[str] = []
        self.tags = self.linked = 0
        self.link = False  # within <a>
        self.places: dict[str, list[int]] = {}  # of the open elements of each name
        self.bounds: list[int] = []  # of the open article, main and body elements

    def _push(self, tag: str, outside: bool, region: int, mark: int) -> None:
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in BOUNDS:
            self.bounds.append(len(self.open))
        self.open.append((tag, outside, region, mark))

    def _pop(self) -> None:
        tag = self.open.pop()[0]
        self.places[tag].pop()
        if tag in BOUNDS:
            self.bounds.pop()

    @property
    def _outside(self) -> bool:
        return bool(self.open) and self.open[-1][1]

    @property
    def _region(self) -> int:
        return self.open[-1][2] if self.open else 0

    @property
    def _mark(self) -> int:
        return self.open[-1][3] if self.open else -1

    def _break(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(Line(text, self.linked, self.tags, self._region, self._outside, self._mark))
            self.tags = 0
        self.parts, self.linked, self.link = [], 0, False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        block = tag in BLOCKS
        if block:
            self._break()
            if tag != "br" and self.open and self.open[-1][0] == "p":
                self._pop()  # a block ends an open paragraph
            if tag in ("li", "dt", "dd", "tr", "td", "th", "option") and self.open and self.open[-1][0] == tag:
                self._pop()
        self.tags += 1
        self.link |= tag == "a"
        if tag in VOID:
            return
        within = bool(self.places.get("article") or self.places.get("main"))
        # page-wide elements may be named after their layout; an article within an article may be a comment
        checked = tag not in ("html", "body", "main") and (tag != "article" or within)
        outside = self._outside or tag in OUTSIDE or (checked and _hidden(attrs))
        words, mark, named = _marks(attrs), self._mark, tag in BESIDE or (tag == "header" and not within)
        marked = named or (checked and bool(words))
        if not (block or outside or marked or mark >= 0):
            return  # inline markup is not tracked: it may never be closed
        if marked:
            self.marks.append(Mark(mark, words | {tag} if named else words, within))
            mark = len(self.marks) - 1
        region = self._region
        if tag in ("article", "main", "section", "div", "td", "body"):
            self.parents.append(region)
            self.names.append(tag)
            region = len(self.names) - 1
            if tag in ("article", "main") and not words:
                self.plain.add(region)
        self._push(tag, outside, region, mark)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS or tag in OUTSIDE or tag in BESIDE:
            self._break()
        self.tags += 1
        self.link &= tag != "a"
        opened = self.places.get(tag)
        if not opened or (tag in ("p", "li", "div", "span") and self.bounds and self.bounds[-1] > opened[-1]):
            return  # a stray end tag closes nothing outside its article
        while len(self.open) > opened[-1] + 1:
            self._pop()
        self._pop()

    def handle_data(self, data: str) -> None:
        self.parts.append(data)
        if self.link:
            self.linked += len(" ".join(data.split()))

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)

    def finish(self) -> None:
        if _UNFINISHED.match(self.rawdata):
            self.rawdata = ""  # the page breaks off within a tag or comment
        self.close()
        self._break()
        self._settle()

    def _settle(self) -> None:
        """Marked elements are outside, except one that wraps the page: its article, or next to all of its running text."""
        free = articles = 0
        in_article = _below(self.plain, self.parents)
        for x in self.lines:
            size = 0 if x.outside else max(0, len(x.text) - x.linked)
            article = size if in_article[x.region] else 0
            articles += article
            if x.mark < 0:
                free += size
            else:
                mark = self.marks[x.mark]
                mark.own, mark.size, mark.article = mark.own + size, mark.size + size, mark.article + article
        for mark in reversed(self.marks):  # inner marks have larger numbers
            if mark.outer >= 0:
                self.marks[mark.outer].size += mark.size
                self.marks[mark.outer].article += mark.article
        total = free + sum(mark.size for mark in self.marks if mark.outer < 0)
        layout = {-1}
        for k, mark in enumerate(self.marks):
            if mark.outer not in layout or mark.size < WRAPPER:
                continue
            article = not mark.inner and 2 * mark.article > articles
            most = 2 * mark.size > total and (mark.form or free <= BESIDES * mark.size)
            if (article or most) and not (mark.readers and free):
                layout.add(k)
                free += mark.own
        for x in self.lines:
            x.outside |= x.mark not in layout


def smooth(values: list[float]) -> list[float]:
    """Gaussian smoothing, renormalised at the ends."""
    out = []
    for i in range(len(values)):
        low, high = max(0, i - REACH), min(len(values), i + REACH + 1)
        weights = _KERNEL[low - i + REACH : high - i + REACH]
        out.append(sum(w * v for w, v in zip(weights, values[low:high], strict=True)) / sum(weights))
    return out


def threshold(values: list[float]) -> float:
    """Split of the values into two clusters: the fixed point of the mean of the clusters' means."""
    low, high = min(values), max(values)
    split = (low + high) / 2
    for _ in range(50):
        below, above = [v for v in values if v < split], [v for v in values if v >= split]
        if not below or not above:
            break
        new = (sum(below) / len(below) + sum(above) / len(above)) / 2
        if new == split:
            break
        split = new
    return split


def _around(region: int, parents: list[int]) -> list[int]:
    """The region and those that hold it, innermost first."""
    chain = []
    while region >= 0:
        chain.append(region)
        region = parents[region]
    return chain


def _below(regions: set[int], parents: list[int]) -> list[bool]:
    """For each region whether it is one of ``regions`` or within one; a region's number is above those around it."""
    within = []
    for r, outer in enumerate(parents):
        within.append(r in regions or (outer >= 0 and within[outer]))
    return within


def _summed(own: dict[int, int], parents: list[int]) -> list[int]:
    """For each region the sum over it and all within."""
    sums = [own.get(r, 0) for r in range(len(parents))]
    for r in range(len(parents) - 1, 0, -1):
        sums[parents[r]] += sums[r]
    return sums


def _content(lines: list[Line], parents: list[int], names: list[str]) -> list[int]:
    """Places of the article's lines: the smoothed ratio selects their region, on every page alike."""
    ratios = smooth([x.ratio for x in lines])
    split = threshold(ratios)
    # a line that only its neighbours lift above the threshold does not vote
    chosen = [i for i, x in enumerate(lines) if x.ratio and min(x.ratio, ratios[i]) >= split] or [max(range(len(lines)), key=lambda i: lines[i].ratio)]
    own: dict[int, int] = {}
    for i in chosen:
        own[lines[i].region] = own.get(lines[i].region, 0) + len(lines[i].text)
    votes = _summed(own, parents)
    region = max(r for r, v in enumerate(votes) if v and v >= NEARLY * votes[0])  # inner regions have larger numbers
    path = _around(region, parents)
    unmarked = [i for i, x in enumerate(lines) if x.ratio]
    # marks do not choose: they say how far the chosen region reaches, and settle a page without one
    reach = {r for name in ("article", "main") for r in [r for r in path[::-1] if names[r] == name][:1]}
    reach = set(sorted(reach, key=lambda r: names[r])[:1])  # an article before a main
    if not reach and names[region] in ("page", "body"):
        for name in ("article", "main"):
            named = {r for r, x in enumerate(names) if x == name}
            within = _below(named, parents)
            marks = {r for r in named if votes[r] and not within[parents[r]]}
            if 2 * sum(votes[r] for r in marks) > votes[0]:
                reach = marks
                break
    if reach:
        held = _below(reach, parents)
        return [i for i in unmarked if held[lines[i].region]]
    inside = _below({region}, parents)
    return _grown(lines, parents, names, unmarked, [i for i in chosen if inside[lines[i].region]], path, votes, inside)


def _grown(
    lines: list[Line], parents: list[int], names: list[str], unmarked: list[int], kept: list[int], path: list[int], votes: list[int], inside: list[bool]
) -> list[int]:
    """From the first to the last chosen line, and on over what adjoins: text of the region, text beside it, regions with chosen lines."""
    region, own = path[0], names[path[0]] not in ("page", "body")
    chars: dict[int, int] = {}
    links: dict[int, int] = {}
    for i in unmarked:
        chars[lines[i].region] = chars.get(lines[i].region, 0) + len(lines[i].text)
        links[lines[i].region] = links.get(lines[i].region, 0) + lines[i].linked
    size, linked = _summed(chars, parents), _summed(links, parents)
    held = set(path)
    outer, branch = [], []  # the nearest region of the path, and the one below it on the way
    for r, up in enumerate(parents):
        outer.append(r if r in held else outer[up])
        branch.append(r if r in held or up in held else branch[up])

    def joins(i: int) -> bool:
        r = lines[i].region
        within = own and outer[r] == region
        if r in held:
            return within or 2 * lines[i].linked <= len(lines[i].text)
        at = branch[r]
        return votes[at] > 0 or (within and 2 * linked[at] <= size[at])

    before, after = [i for i in unmarked if i < kept[0]], [i for i in unmarked if i > kept[-1]]
    out = [i for i in unmarked if kept[0] <= i <= kept[-1]]
    for rest in (before[::-1], after):
        for i in rest:
            if joins(i):
                out.append(i)
            elif not (own and inside[lines[i].region]):
                break  # a menu or box of its own: what lies behind it is not the article's
    return sorted(out)


def main_text(html: str) -> str:
    """The article's blocks in page order, joined by a space; empty if there is none."""
    if not html:
        return ""
    reader = Reader()
    reader.feed(html)
    reader.finish()
    lines = reader.lines
    if not any(x.ratio for x in lines):
        return ""
    return " ".join(lines[i].text for i in _content(lines, reader.parents, reader.names))


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` plus ``out_col``, the main text of each page."""
    small_batches(pages.sparkSession)

    @arrow_udf("string")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(t) for t in texts_of(batch)], pa.string())

    return pages.withColumn(out_col, read(F.col(html_col)))
