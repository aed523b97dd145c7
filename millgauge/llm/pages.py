"""Main text of web pages by two-pass block rules.

Method: the page is cut into blocks at block-level tags. Pass one decides what it can: by the element
the block stands in (navigation, footers, adverts and the like are out; where a page marks
its article, the article is in and the rest is out), then by link density, length and density of stop words.
Markup that says less is a vote: forms and compound class words ("no-sidebar") yield to an article marked on the same element, to most
of the page's text standing in their element, and to a page on which nothing else is good; a marked article yields to more text
outside that the other rules find good. On a page whose words fit none of the stop lists only length and links count.
Short or middling blocks stay open. Pass two gives an open block the label of its nearest decided
neighbours; a heading right above a kept block is kept; blocks of a page on which nothing was
decided are kept, since nothing speaks against them.

Defined cases: null or empty html, and pages without text, give an empty text; unclosed and stray tags are
tolerated; character references are decoded, white space within a block becomes one space; repeated rows give
equal rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINKED_OUT = 0.33  # share of a block's characters inside links
LINKED_OUT_ARTICLE = 0.66
SHORT_CHARS, LONG_CHARS = 70, 200
STOP_LOW, STOP_HIGH = 0.2, 0.3
STOP_FITS = 0.1  # share of stop words on a page from which the lists say something about it
WEAK_SHARE = 0.5  # of the page's text, in one element: more than a form or a compound class word can put out
HEADING_REACH = 200  # characters between a heading and the kept block below

# Frequent function words of the languages that pages are expected in.
STOP_WORDS = frozenset("""
a an and are as at be by for from has have he in is it of on or that the this to was were which with you
der die das und ist im in den von zu mit sich des auf für nicht ein eine dem als auch es an
le la les de des du et en un une est que qui dans pour par sur au aux pas avec plus ne
el los las y que se del con una por para como su al lo más o
""".split())

# What elements and class or id words mean.
SILENT = frozenset("script style noscript template svg math iframe object select option textarea button head title".split())
OUTSIDE = frozenset("nav footer aside dialog menu".split())
INSIDE = frozenset("article main".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span
strike strong sub sup time tt u var wbr br input""".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
OUTSIDE_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|widget|footer|masthead|"
    r"cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|subscribe|newsletter|signup|login|comments?|replies|reply|"
    r"discussion|disqus|share|sharing|social|related|recommended|recommendations|copyright|legal|pagination|pager|toolbar|search|skip)(?:$|[\s_-])", re.I)
OUTSIDE_WORD = re.compile(OUTSIDE_WORDS.pattern.removeprefix(r"(?:^|[\s_-])").removesuffix(r"(?:$|[\s_-])") + "$", re.I)  # a class that is such a word
HEADER_WORDS = re.compile(r"(?:^|[\s_-])(?:header|topbar|top)(?:$|[\s_-])", re.I)
INSIDE_WORDS = re.compile(r"^(?:article|post|story|entry)(?:[_-](?:body|content|text))?$|^(?:main|body)[_-](?:content|text)$|^article-?body$", re.I)
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar".split())


class Block:
    __slots__ = ("parts", "linked", "outside", "weak", "inside", "heading", "text", "label")

    def __init__(self, outside: bool, weak: int, inside: bool, heading: bool) -> None:
        self.parts, self.linked, self.outside, self.weak, self.inside, self.heading = [], 0, outside, weak, inside, heading
        self.text, self.label = "", None


class _Cutter(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str]] = []  # tag and what it makes of its content: "", silent, outside, weak, inside
        self.weak: list[tuple[int, int]] = []  # depth and number of the open elements that are weakly outside
        self.parents = [0]  # of weak elements by number: the one around each, 0 for none
        self.count: Counter[str] = Counter()  # of open tags and meanings, so that no tag looks through all open ones
        self.blocks: list[Block] = []
        self.fresh = True

    def cut(self, k: int) -> None:
        self.count.subtract(x for pair in self.open[k:] for x in pair)
        del self.open[k:]
        while self.weak and self.weak[-1][0] >= k:
            self.weak.pop()

    def within(self) -> int:
        """Number of the innermost open element that is weakly outside."""
        return self.weak[-1][1] if self.weak else 0

    def meaning(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        held = {k: v or "" for k, v in attrs}
        if tag in SILENT or "hidden" in held or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", held.get("style", "")):
            return "silent"
        if tag in ("html", "body"):
            return ""
        words = f"{held.get('class', '')} {held.get('id', '')}"
        in_article = self.count["inside"] > 0
        if tag in OUTSIDE or held.get("role", "").lower() in OUTSIDE_ROLES - {"form"} or any(map(OUTSIDE_WORD.match, words.split())):
            return "outside"
        if (tag == "header" or HEADER_WORDS.search(words)) and not in_article:
            return "outside"
        if tag in INSIDE or held.get("itemprop", "").lower() == "articlebody" or any(map(INSIDE_WORDS.match, words.split())):
            return "inside"
        if tag == "form" or held.get("role", "").lower() == "form" or OUTSIDE_WORDS.search(words):
            return "weak"
        return ""

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.fresh = True
            self.shut(("p",), tag)
            if tag in CLOSES:
                self.shut(CLOSES[tag], tag)
        if tag == "br" and self.blocks and not self.fresh:
            self.blocks[-1].parts.append(" ")
        if tag not in VOID:
            self.open.append((tag, self.meaning(tag, attrs)))
            self.count.update(self.open[-1])
            if self.open[-1][1] == "weak":
                self.parents.append(self.within())
                self.weak.append((len(self.open) - 1, len(self.parents) - 1))

    def shut(self, tags: tuple[str, ...], by: str) -> None:
        """Close an open paragraph or item that the new element ends, up to the element that holds it."""
        if not any(self.count[tag] > 0 for tag in tags):
            return
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k][0]
            if name in tags:
                self.cut(k)
                return
            if name not in INLINE and name not in ("p", "td", "th"):
                return

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in SILENT:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.fresh = True
        if self.count[tag] > 0:
            self.cut(next(k for k in range(len(self.open) - 1, -1, -1) if self.open[k][0] == tag))

    def handle_data(self, data: str) -> None:
        if self.count["silent"] > 0:
            return
        if self.fresh or not self.blocks:
            if not data.strip():
                return
            heading = any(self.count[tag] > 0 for tag in HEADINGS)
            self.blocks.append(Block(self.count["outside"] > 0, self.within(), self.count["inside"] > 0, heading))
            self.fresh = False
        block = self.blocks[-1]
        block.parts.append(data)
        if self.count["a"] > 0:
            block.linked += len(" ".join(data.split()))


def _stops(text: str) -> tuple[int, int]:
    """Stop words and words of a text."""
    words = text.lower().split()
    return sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words), len(words)


def _decide(block: Block, marked: bool, fits: bool) -> str:
    """Pass one: good, bad, short (open) or near (open, leaning to good). ``fits``: the stop lists fit the page."""
    length = len(block.text)
    linked = block.linked / length
    if block.outside or linked > (LINKED_OUT_ARTICLE if block.inside else LINKED_OUT):
        return "bad"
    if marked:
        return "good" if block.inside else "bad"
    if length < SHORT_CHARS:
        return "bad" if block.linked else "short"
    if not fits:
        return "good" if length > LONG_CHARS else "near"
    stops, words = _stops(block.text)
    dense = stops / words
    if dense >= STOP_HIGH:
        return "good" if length > LONG_CHARS else "near"
    return "near" if dense >= STOP_LOW else "bad"


def _vote(blocks: list[Block], parents: list[int]) -> None:
    """Pass one over a page: strong markup, then what its text says of the weaker one."""
    open_to = [b for b in blocks if not b.outside]
    held = [0] * len(parents)  # characters in each weak element and, at 0, on the page
    for b in open_to:
        held[b.weak] += len(b.text)
    for n in range(len(parents) - 1, 0, -1):  # an element has a greater number than that around it
        held[parents[n]] += held[n]
    kept = {0} | {n for n, size in enumerate(held) if size > WEAK_SHARE * held[0]}  # with all around them
    strong = [b.outside for b in blocks]
    for every in (False, True):  # with the weak votes, and without if they leave nothing good
        for b, out in zip(blocks, strong):
            b.outside = out or not every and b.weak not in kept
        stops = [_stops(b.text) for b in blocks if not b.outside and b.linked <= LINKED_OUT * len(b.text)]
        fits = sum(s for s, _ in stops) >= STOP_FITS * sum(n for _, n in stops)
        inside = sum(len(b.text) for b in blocks if b.inside and not b.outside)
        free = [_decide(b, False, fits) for b in blocks]
        if inside and sum(len(b.text) for b, label in zip(blocks, free) if label == "good" and not b.inside) <= inside:
            for b in blocks:
                b.label = _decide(b, True, fits)
        else:
            for b, label in zip(blocks, free):
                b.label = "good" if b.inside and _decide(b, True, fits) == "good" else label
        if any(b.label == "good" for b in blocks) or not any(b.weak for b in blocks):
            return


def _inherit(blocks: list[Block]) -> None:
    """Pass two: open blocks take the label of the nearest decided neighbours of pass one."""
    first = [b.label for b in blocks]
    decided = [k for k, label in enumerate(first) if label in ("good", "bad")]
    if not decided:
        for b in blocks:
            b.label = "good"
        return
    for k, block in enumerate(blocks):
        if first[k] in ("good", "bad"):
            continue
        at = bisect(decided, k)
        before = decided[at - 1] if at else None
        after = decided[at] if at < len(decided) else None
        near = {first[d] for d in (before, after) if d is not None}
        if len(near) == 2:
            gap = (k - before) - (after - k)
            near = {first[before] if gap < 0 else first[after]} if gap else {"good" if first[k] == "near" else "bad"}
        block.label = near.pop()
    for k, block in enumerate(blocks):
        if block.heading and first[k] in ("short", "near") and block.label == "bad":
            reach = 0
            for below in blocks[k + 1 :]:
                if below.label == "good":
                    block.label = "good"
                    break
                reach += len(below.text)
                if reach > HEADING_REACH:
                    break


def blocks_of(html: str | None) -> list[Block]:
    """All blocks of a page in order, each with its text and label."""
    html = html or ""
    last = html.rfind("<!--")
    if last >= 0 and html.find("-->", last) < 0:  # a comment without end hides the rest, as in browsers
        html = html[:last]
    cutter = _Cutter()
    cutter.feed(html)
    cutter.close()
    blocks = []
    for block in cutter.blocks:
        block.text = " ".join("".join(block.parts).split())
        if block.text:
            blocks.append(block)
    _vote(blocks, cutter.parents)
    _inherit(blocks)
    return blocks


def main_text(html: str | None) -> str:
    return " ".join(b.text for b in blocks_of(html) if b.label == "good")


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns, text and n_chars (code points) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[list(keep)].copy()
            out["text"] = [main_text(h) for h in batch["html "]]
            out["n_chars"] = out["text"].map(len).astype("int64")
            yield out

    types = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    picked = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html_col}`").alias("html "))
    return picked.mapInPandas(run, f"{types}, text string, n_chars bigint")
