"""Main text of web pages by scores on the element tree.

A page is read once, tolerant of missing and crossed tags. Elements that never
hold the article are left out by name, role or class: menus, page headers and
footers, sidebars, notices, adverts, forms, scripts, styles and comments of
readers. What remains is a list of blocks, each with the element that holds it.
Every block passes points for its length and its commas on to its ancestors,
fully to the first, half to the second, less beyond; a container's points are
discounted by the share of its text that is inside links. The best container, or
the whole article or main element around it, is kept with those of its siblings
that score a fair part of it or are plain blocks, and its blocks are written in
page order.

Names are judged whole: a class or an id is bad if it is a bad word, begins with one
and goes on as such names do (``share-buttons``), or ends with one (``page-share``);
``related-work`` and ``header-files`` are not. Inside an article the id of a section
says what it is about and is not judged, but for those of readers' comments.

Pages are independent: one Python call per page, whatever its host. The tree is kept
in flat lists and walked without recursion, and open elements are found by their tag,
so depth is no limit and the time grows with the length of the page.

Defined cases: missing or empty html gives an empty text; html without tags is one
block; an unfinished tag at the end is no text and sections of other markup are comments;
broken references stay as they are; repeated pages are read one by one;
other columns are kept, one of the result's name is replaced.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm.batches import small_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that do not break a line of text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
# Never text of the page.
MUTE = frozenset("head title script style noscript template iframe object canvas svg math audio video map datalist".split())
# Never the article.
ASIDE = frozenset("nav footer aside form button select textarea fieldset dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
# Words that, as the name of a class or an id or as the last word of one, say that it is not the article; and words for the article.
BAD = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion sidebar sidebars widget "
    "widgets menu menus nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer comment comments commentlist disqus "
    "discussion replies respond cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended recommendations toolbar pager pagination copyright hidden".split())
GOOD = frozenset("article articles body content main post entry story text page".split())
# Words that may follow a bad word and leave it bad, and words before it that make it speak of something else.
AFTER = frozenset(
    "area areas article articles bar bars block blocks bottom box boxes btn button buttons container content form group head holder icon "
    "icons inner item items left link links list lists main message news outer panel post posts primary row right secondary section site "
    "slot slots stories story text title toggle tools top topics unit units wrap wrapper zone".split())
BEFORE = frozenset("has is no not with without".split())
# What an id inside an article still names when it stands on a section: no heading is called that.
READERS = frozenset("comment comments commentlist disqus respond newsletter cookie cookies advert advertisement ads".split())
# A block of one of these passes its points to the parent; other blocks are containers themselves.
PARAGRAPH = frozenset("p pre td th blockquote li dd dt h1 h2 h3 h4 h5 h6 figcaption caption".split())
# Weight of a container before any text is read.
WEIGHT = {"article": 25, "main": 25, "div": 5, "blockquote": 3, "ul": -3, "ol": -3, "dl": -3, "address": -3, "table": -3}
# A start tag that ends open elements of some kind, up to the element that bounds them.
ENDS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody"}, {"table"})}
HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
_WORDS = re.compile(r"[a-z]+")
_TAG = re.compile(r"<[A-Za-z/!?]")
# Elements that end with the cell they are in.
_TABLE = frozenset("tr table tbody thead tfoot".split())
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _names(value: str | None) -> list[list[str]]:
    """The names of a class or id attribute, each as its words."""
    return [words for name in (value or "").split() if (words := _WORDS.findall(_CAMEL.sub("-", name).lower()))]


def _is_bad(words: list[str]) -> bool:
    """Whether a whole name stands for what is not the article; a bad word somewhere in it is not enough."""
    if words[0] in BAD:
        return all(w in BAD or w in AFTER for w in words)
    if words[-1] not in BAD or words[0] in BEFORE:
        return False
    # The header of an article is its headline.
    return not (words[-1] == "header" and words[0] in GOOD)


class Page(HTMLParser):
    """The blocks of one page and the containers that hold them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # Per element, in page order: tag, parent, whether it is left out, words of its names.
        self.tag, self.up, self.out, self.names = ["html"], [-1], [False], [set()]
        # Open elements; their places by tag; those that are blocks; how many are left out and no form.
        self.open, self.at, self.solid, self.shut = [0], {}, [0], 0
        # Blocks: element, text, characters inside links.
        self.blocks: list[tuple[int, str, int]] = []
        self.held: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        text = " ".join("".join(self.held).split())
        if text:
            self.blocks.append((self.open[self.solid[-1]], text, min(self.linked, len(text))))
        self.held, self.linked = [], 0

    def _last(self, tags) -> int:
        """Place of the innermost open element of some kind, 0 if there is none."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def _pop_to(self, place: int) -> None:
        while len(self.open) > place:
            node = self.open.pop()
            self.at[self.tag[node]].pop()
            if self.solid[-1] == len(self.open):
                self.solid.pop()
            self.shut -= self.out[node] and self.tag[node] != "form"

    def _end_open(self, tags, bounds) -> None:
        place = self._last(tags)
        if place and place > self._last(bounds):
            self._pop_to(place)

    def _left_out(self, tag: str, attrs: dict, classes: list, ids: list) -> bool:
        if tag in MUTE or "hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search(attrs.get("style") or ""):
            return True
        if tag in ("html", "body", "article", "main"):
            return False
        if tag in ASIDE or (attrs.get("role") or "").lower() in ROLES:
            return True
        inside = bool(self._last(("article", "main")))
        if tag == "header":
            return not inside
        if tag in HEADS:
            return False
        # A section of an article is called by what it is about.
        named = [i for i in ids if i[0] in READERS] if inside and tag == "section" else ids
        return any(map(_is_bad, classes + named))

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag in ("br", "wbr"):
                self.held.append(" " if tag == "br" else "")
            elif tag == "hr":
                self.flush()
            return
        if tag not in INLINE:
            self.flush()
            self._end_open(("p",), ("td", "th", "table", "article", "main", "body"))
            if tag in HEADS:
                self._end_open(HEADS, ("div", "article", "main", "section", "body"))
            if tag in ("article", "main"):
                # An article is never part of a menu or a footer that was left open.
                self._end_open(("nav", "footer", "header", "aside", "head"), ("article", "main"))
            if tag == "body":
                self._end_open(("head",), ())
        if tag in ENDS:
            self._end_open(*ENDS[tag])
        if tag == "a" and self.at.get("a"):
            self._end_open(("a",), ("td", "th", "table"))
        if tag == "html" or tag == "body" and self.at.get("body"):
            return
        given = dict(attrs)
        classes, ids = _names(given.get("class")), _names(given.get("id"))
        above = self.open[-1]
        # An article inside a form that holds the whole page is an article all the same.
        free = tag in ("article", "main") and not self.shut
        self.tag.append(tag)
        self.up.append(above)
        self.out.append((self.out[above] and not free) or self._left_out(tag, given, classes, ids))
        self.names.append({w for name in classes + ids for w in name})
        place = len(self.open)
        self.open.append(len(self.tag) - 1)
        self.at.setdefault(tag, []).append(place)
        if tag not in INLINE:
            self.solid.append(place)
        self.shut += self.out[-1] and tag != "form"

    def handle_endtag(self, tag):
        if tag in VOID:
            if tag == "br":
                self.held.append(" ")
            return
        place = self._last((tag,))
        # The end of an inline element does not end blocks, and nothing inside a cell ends the table's outside.
        if not place or tag in INLINE and self.solid[-1] > place or tag not in _TABLE and self._last(("td", "th")) > place:
            return
        if tag not in INLINE:
            self.flush()
        self._pop_to(place)

    def parse_marked_section(self, i, report=1):
        """A section of some other kind of document, well-formed or not, is a comment here."""
        return self.parse_bogus_comment(i)

    def read(self, html: str) -> None:
        """The whole page. No tag is finished after the last ``>``, so what follows it is text up to the next tag."""
        end = html.rfind(">") + 1
        self.feed(html[:end])
        self.close()
        rest = html[end:]
        tag = _TAG.search(rest)
        self.handle_data(unescape(rest[:tag.start()] if tag else rest))
        self.flush()

    def handle_data(self, data):
        if not self.out[self.open[-1]]:
            self.held.append(data)
            if self.at.get("a"):
                self.linked += len(data.strip())


def _points(text: str) -> float:
    commas = text.count(",") + text.count("，") + text.count("、")
    return (len(text) >= 25) + commas + min(len(text) / 100, 3)


def _scores(page: Page) -> tuple[list[float], list[int], list[int]]:
    """Points of the containers, and characters and linked characters below every element."""
    n = len(page.tag)
    score, chars, linked = [0.0] * n, [0] * n, [0] * n
    scored = [False] * n
    for node, text, inside in page.blocks:
        chars[node] += len(text)
        linked[node] += inside
        at = page.up[node] if page.tag[node] in PARAGRAPH and page.up[node] >= 0 else node
        points, level = _points(text), 0
        while at >= 0 and level < 6:
            scored[at] = True
            score[at] += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            at, level = page.up[at], level + 1
    for node in range(n - 1, 0, -1):
        chars[page.up[node]] += chars[node]
        linked[page.up[node]] += linked[node]
    for node in range(n):
        if scored[node] and page.tag[node] not in PARAGRAPH and page.tag[node] not in INLINE:
            weight = WEIGHT.get(page.tag[node], 0) + (10 if page.names[node] & GOOD else 0)
            score[node] = (score[node] + weight) * (1 - linked[node] / chars[node]) if chars[node] else 0.0
        else:
            score[node] = 0.0
    return score, chars, linked


def _whole(page: Page, node: int) -> int:
    """The outermost article around an element, else the outermost main element, else the element itself."""
    around = {}
    at = node
    while at >= 0:
        if page.tag[at] in ("article", "main") and not page.out[at]:
            around[page.tag[at]] = at
        at = page.up[at]
    return around.get("article", around.get("main", node))


def _kept(page: Page) -> set[int]:
    """The best container, or the article that holds it, and the siblings that belong to it."""
    score, chars, linked = _scores(page)
    best = max(range(len(score)), key=lambda n: (score[n], -n))
    if score[best] <= 0:
        # Nothing but links or bare short blocks: the page has no article.
        return {0} if page.blocks and not sum(linked[:1]) else set()
    whole = _whole(page, best)
    kept, least = {whole}, max(10.0, 0.2 * score[best])
    for node in range(len(score)):
        if page.up[node] == page.up[whole] and node != whole and chars[node] and page.up[node] >= 0:
            share = linked[node] / chars[node]
            # Headlines, quotes and code are short by nature; a short <p> may be anything.
            plain = page.tag[node] in PARAGRAPH and (
                chars[node] > 80 and share < 0.25 or share == 0 and (page.tag[node] != "p" or chars[node] > 25))
            if plain or score[node] >= least:
                kept.add(node)
    return kept


def main_text(html: str | None) -> str:
    """The article of one page, its blocks joined by one space."""
    if not html:
        return ""
    page = Page()
    page.read(html)
    if not page.blocks:
        return ""
    inside = [False] * len(page.tag)
    kept = _kept(page)
    for node in range(len(page.tag)):
        inside[node] = node in kept or page.up[node] >= 0 and inside[page.up[node]]
    return " ".join(text for node, text, _ in page.blocks if inside[node])


def extract(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of every page."""
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def of(column: pd.Series) -> pd.Series:
        return column.map(main_text, na_action=None)

    return pages.withColumn(name, of(F.col(html).cast("string")))
