"""Main text of web pages by two-pass block rules.

A page is read as a row of blocks. Elements that never hold an article (menus, page heads
and feet, sidebars, forms, scripts) and elements whose class, id or role says advert,
notice, comments or the like are zones to leave out. End tags that HTML lets a page omit are put in by
rule; a zone that is never closed ends where an article begins. A zone is read after all if it
wraps the page: a form or a layout element around an article or around most of the page's stop words, or
whatever holds the only main text there is. Comments are read only if they hold the main element or first heading.

In the first pass a block is judged alone, by its length, the share of its words that are stop words, and
the share of its text inside links. Short or undecided blocks stay open, and so does a sentence of an article that is one
link. In the second pass they take the label of the nearest decided block; between a good and a bad one
at equal distance, the good one wins inside an article or main element.

Defined results: null or empty html gives an empty text; nulls in other columns are kept;
equal pages give equal texts; unclosed or cut-off markup is read as far as it goes; a
page of any length is read whole; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docket.llm.words import bounded_batches

RAW = "script|style|noscript|template|textarea|select|svg|iframe|object|math|canvas|title|audio|video"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<[!?][^>]*+>|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(?P<close2>/?)(?P<name2>[a-z][a-z0-9:-]*+)(?P<attrs2>[^>]*+)(?:>|\Z)",
    re.I | re.S,
)
BLOCK = frozenset(
    "p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table thead tbody tfoot tr td th caption section article main"
    " blockquote pre figure figcaption hr body html head address center details summary fieldset".split()
)
SKIP = frozenset("nav header footer aside form menu dialog button".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr param".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored banner promo promotion cookie cookies consent notice notices popup modal"
    " sidebar comment comments disqus menu nav navbar navigation breadcrumb breadcrumbs footer masthead share social related"
    " newsletter subscribe subscription login signup pagination pager toolbar widget contentinfo complementary search".split()
)
COMMENTS = frozenset("comment comments disqus".split())
# Hints that also name the layout of a page.
LAYOUT = frozenset("sidebar widget toolbar nav navbar menu search modal popup login social banner".split())
# A name with one of these tells a state of the page ("no-comments", "has-sidebar", "comments-open"), not what the element is.
STATES = frozenset("has have no not with without is js hide hidden enable enabled disable disabled open opened closed off on supports".split())
PART = re.compile(r"[_-]+")
# Elements whose end tag may be missing: which opening tags end them, and which elements they are never looked for beyond.
_P_ENDS = (
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li dt dd"
    " main menu nav ol p pre section summary table ul td th tr tbody thead tfoot caption"
).split()
ENDED_BY = {
    "p": frozenset(_P_ENDS),
    "li": frozenset(["li"]),
    **{x: frozenset(["dt", "dd"]) for x in ("dt", "dd")},
    **{x: frozenset(["td", "th", "tr", "tbody", "thead", "tfoot"]) for x in ("td", "th")},
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]),
    **{x: frozenset(["tbody", "thead", "tfoot"]) for x in ("thead", "tbody", "tfoot")},
}
ENDS = frozenset(x for tags in ENDED_BY.values() for x in tags)
_CELL = frozenset("table caption button".split())
WITHIN = {
    **{x: _CELL | {"td", "th"} for x in ("p",)},
    "li": _CELL | {"ul", "ol", "menu", "td", "th"},
    **{x: _CELL | {"dl", "td", "th"} for x in ("dt", "dd")},
    **{x: frozenset(["table"]) for x in ("td", "th", "tr", "thead", "tbody", "tfoot")},
}
NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[^\W\d_]+")
# Frequent function words of the four languages.
STOP = frozenset(
    "the of and to a in is it that was for on are with as be at by this from or an have not he she they we you but"
    " der die das und zu den von mit dem ein eine ist im nicht für auf des sich als auch es er sie wir"
    " le la les de des et un une du en est que qui dans pour pas sur au avec ce il elle nous vous"
    " el los las del y una por con para se su lo más como al no sus este".split()
)
SHORT, LONG = 40, 140
FEW, MANY = 0.08, 0.2
LINKED = 0.4
SENTENCE_END = (".", "!", "?", "…")


def hinted(names: str) -> tuple[bool, bool, bool]:
    """Whether a class, id or role names what is left out, whether it names comments, and whether all such names may be layout."""
    unwanted = comments = False
    layout = True
    for name in names.lower().split():
        parts = PART.split(name)
        if len(parts) > 1 and not STATES.isdisjoint(parts):
            continue
        if not HINTS.isdisjoint(parts) or name in ("side-bar", "side_bar"):
            unwanted = True
            comments = comments or not COMMENTS.isdisjoint(parts)
            layout = layout and LAYOUT.issuperset(HINTS.intersection(parts))
    return unwanted, comments, layout


@dataclass
class Block:
    text: str
    linked: float  # share of the text in links
    article: bool  # in an article or main element
    sentence: bool  # a paragraph by its tag
    zone: int  # the zone that it lies in; 0 is the page


@dataclass
class Zone:
    """An element to leave out."""

    parent: int
    wraps: bool  # may be a form or a layout element around the whole page
    comments: bool
    whole: bool = False  # holds a main element or a first heading, or an article that is no comment


@dataclass
class _Open:
    """An element that is open."""

    name: str
    zone: int
    own: bool  # it is the zone's element
    tag: int  # its number


class _Reader:
    """Reads a page with a stack of open elements.

    ``unclosed``: numbers of tags that open zones without an end, as an earlier reading found them; an article
    or main element ends these.
    """

    def __init__(self, unclosed: frozenset[int]) -> None:
        self.unclosed = unclosed
        self.ends_missing: set[int] = set()
        self.blocks: list[Block] = []
        self.zones = [Zone(0, True, False)]
        self.open: list[_Open] = []
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.links = self.articles = 0
        self.sentence = False

    def zone(self) -> int:
        return self.open[-1].zone if self.open else 0

    def flush(self) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            inside = " ".join(html.unescape("".join(self.linked)).split())
            self.blocks.append(Block(text, min(1.0, len(inside) / len(text)), self.articles > 0, self.sentence, self.zone()))
        self.parts.clear()
        self.linked.clear()

    def cut(self, k: int, ended: bool) -> None:
        """End the open elements from ``k`` on; ``ended``: that one by its own end."""
        self.flush()
        self.links = 0
        for i in range(len(self.open) - 1, k - 1, -1):
            e = self.open.pop()
            if e.name in ("article", "main"):
                self.articles -= 1
            if e.own and (i > k or not ended) and e.name not in ENDED_BY:
                self.ends_missing.add(e.tag)

    def close(self, name: str) -> None:
        within = WITHIN.get(name, _CELL | {"td", "th"} if name not in ("table", "caption", "button") else frozenset())
        inline = name not in BLOCK and name not in SKIP
        for k in range(len(self.open) - 1, -1, -1):
            e = self.open[k]
            if e.name == name:
                return self.cut(k, True)
            if e.name in within or (inline and (e.name in BLOCK or e.name in SKIP)):
                break
        if not inline:
            self.flush()
            self.links = 0

    def begin(self, name: str, attrs: str, tag: int) -> None:
        if name in ENDS:
            for k in range(len(self.open) - 1, -1, -1):
                e = self.open[k]
                if name in ENDED_BY.get(e.name, ()):
                    # The farthest one that this tag ends: a row ends its cell and the row before it.
                    while k and name in ENDED_BY.get(self.open[k - 1].name, ()):
                        k -= 1
                    self.cut(k, True)
                    break
                if e.name in BLOCK or e.name in SKIP:
                    if e.name in WITHIN.get(name, _CELL) or name not in ("li", "dt", "dd", "td", "th", "tr", "tbody", "thead", "tfoot"):
                        break
        if name in ("article", "main") and self.unclosed:
            # An article in a comment section that does end is a comment.
            known = max((k for k, e in enumerate(self.open) if e.own and e.tag not in self.unclosed and self.zones[e.zone].comments), default=-1)
            for k in range(known + 1, len(self.open)):
                if self.open[k].own and self.open[k].tag in self.unclosed:
                    if known < 0 or name == "main":
                        self.cut(k, False)
                    break
        named = " ".join("".join(x) for x in NAMED.findall(attrs)) if attrs else ""
        unwanted, comments, layout = hinted(named) if named and name not in ("html", "body", "article", "main") else (False, False, True)
        wraps = (name == "form" and layout) or (unwanted and layout and name not in SKIP)
        unwanted = unwanted or (name in SKIP and not (name == "header" and self.articles))
        block = name in BLOCK or name in SKIP
        if block or unwanted:
            self.flush()
            self.links = 0
        if block:
            self.sentence = name == "p"
        if name in VOID:
            return
        zone = self.zone()
        if name in ("article", "main", "h1"):
            z = zone
            while z and not (name == "article" and self.zones[z].whole):
                if name != "article" or not self.zones[z].comments:
                    self.zones[z].whole = True
                elif self.zones[z].comments:
                    break  # a comment
                z = self.zones[z].parent
        if name in ("article", "main"):
            self.articles += 1
        if unwanted:
            self.zones.append(Zone(zone, wraps, comments))
            zone = len(self.zones) - 1
        if block or unwanted:
            self.open.append(_Open(name, zone, unwanted, tag))

    def text(self, part: str) -> None:
        self.parts.append(part)
        if self.links:
            self.linked.append(part)

    def read(self, page: str) -> None:
        at = 0
        for tag, m in enumerate(TOKEN.finditer(page)):
            if m.start() > at:
                self.text(page[at : m.start()])
            at = m.end()
            name = (m["name"] or m["name2"] or "").lower()
            if not name:
                continue
            closing = m["close"] or m["close2"]
            if name == "br":
                self.parts.append(" ")
            elif name == "a" and closing:
                self.links = max(0, self.links - 1)
                if self.open and self.open[-1].name == "a":
                    self.close("a")
            elif closing:
                self.close(name)
            else:
                attrs = m["attrs"] or m["attrs2"] or ""
                self.begin(name, attrs, tag)
                if name == "a":
                    self.links += 1
        if at < len(page):
            self.text(page[at:])
        self.cut(0, False) if self.open else self.flush()


def blocks(page: str) -> tuple[list[Block], list[Zone]]:
    """All blocks of a page, and its zones; zone 0 is the page itself."""
    reader = _Reader(frozenset())
    reader.read(page)
    if reader.ends_missing:
        reader = _Reader(frozenset(reader.ends_missing))
        reader.read(page)
    return reader.blocks, reader.zones


def stop_words(text: str) -> tuple[int, int]:
    words = WORD.findall(text.lower())
    return sum(w in STOP for w in words), len(words)


def read_zones(found: list[Block], labels: list[int], zones: list[Zone]) -> set[int]:
    """The zones whose own blocks are read: the page, and zones that wrap it."""
    weight, good = [0] * len(zones), [False] * len(zones)
    for b, label in zip(found, labels):
        weight[b.zone] += stop_words(b.text)[0] if b.linked <= LINKED else 0
        good[b.zone] |= label > 0 or b.article
    read = {0}
    articles = [False] * len(zones)
    for b in found:
        articles[b.zone] |= b.article
    # A zone in a zone counts for it if it may be read as well.
    inner, shown = list(weight), list(good)
    for z in range(len(zones) - 1, 0, -1):
        if zones[z].wraps and not zones[z].comments:
            inner[zones[z].parent] += inner[z]
            shown[zones[z].parent] |= shown[z]
    while True:
        have, article, any_good = sum(weight[z] for z in read), any(articles[z] for z in read), any(good[z] for z in read)
        best, most = 0, 0
        for z in range(1, len(zones)):
            zone = zones[z]
            if z in read or article or zone.parent not in read or (zone.comments and not zone.whole):
                continue
            wanted = (zone.whole or not any_good or inner[z] > have) if zone.wraps else zone.whole and not any_good
            if shown[z] and wanted and inner[z] > most:
                best, most = z, inner[z]
        if not best:
            return read
        read.add(best)


def judged(text: str, linked: float, sentence: bool = False) -> int:
    """1 for main text, -1 for boilerplate, 0 if the block alone does not tell. ``sentence``: a paragraph of an article."""
    if linked > LINKED and not (sentence and text.rstrip("\"'»”’)")[-1:] in SENTENCE_END):
        return -1
    if len(text) < SHORT:
        return -1 if linked > LINKED else 0
    stop, words = stop_words(text)
    share = stop / max(1, words)
    if linked > LINKED:
        return 0 if share >= MANY else -1
    if share >= MANY or (share >= FEW and len(text) >= LONG):
        return 1
    return -1 if linked > 0 and share < FEW else 0


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in page order, joined by an empty line."""
    found, zones = blocks(page or "")
    first = [judged(b.text, b.linked, b.article and b.sentence) for b in found]
    if len(zones) > 1:
        read = read_zones(found, first, zones)
        shown = [b.zone in read for b in found]
        first = [label for label, yes in zip(first, shown) if yes]
        found = [b for b, yes in zip(found, shown) if yes]
    n = len(found)
    before, after = [None] * n, [None] * n
    last = None
    for i in range(n):
        last = i if first[i] else last
        before[i] = last
    last = None
    for i in reversed(range(n)):
        last = i if first[i] else last
        after[i] = last
    kept = []
    for i, block in enumerate(found):
        label = first[i]
        if not label:
            b, a = before[i], after[i]
            if b is None and a is None:
                label = 1 if block.article else -1
            elif a is None or b is None:
                label = first[a if b is None else b]
            elif i - b != a - i:
                label = first[b] if i - b < a - i else first[a]
            else:
                label = max(first[a], first[b]) if block.article else min(first[a], first[b])
        if label > 0:
            kept.append(block.text)
    return "\n\n".join(kept)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """All columns of ``pages`` but the html, and ``text``, the page's main text."""
    kept = [c for c in pages.columns if c != column and c != "text"]
    schema = pages.select(*kept).schema.add("text", "string")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([main_text(x) for x in batch.column(len(kept)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), text], [*kept, "text"])

    bounded_batches(pages.sparkSession, 4)
    return pages.select(*kept, F.col(column)).mapInArrow(read, schema)
