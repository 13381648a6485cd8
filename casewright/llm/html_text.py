"""Main text of web pages from parser events, text-to-tag ratios and smoothing.

The standard library's parser streams the events of a page.  A line is the
text between two block borders; its ratio is its length over the tags met with
it.  Ratios are smoothed by a Gaussian, and lines above a threshold make the
clusters of content.  A cluster brings in the other lines of the element it
lies in and of that element's like siblings, and the headings above it, so
that short paragraphs, sections and headings of an article are not lost; lines
inside menus, adverts and the like never count.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.words import map_slices

SIGMA = 1.0
RADIUS = 2
MAX_LINK_SHARE = 0.5
# So many linked lines one after the other are a menu.
MENU_LINES = 2

# Element names of HTML and naming habits of page templates.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rp rt s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SECTIONS = frozenset("body article main section div td center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An article cannot lie in these: one of them that never ends ends before it.
NEVER_AROUND = frozenset("nav menu header".split())
ROOTS = frozenset(("article", "main"))
DROPPED = frozenset(
    "nav aside footer form script style noscript template iframe svg canvas object select button "
    "textarea dialog menu head title".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu form".split())
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices notification alert alerts toast disclaimer adsbygoogle popup modal overlay newsletter subscribe subscription sidebar aside "
    "menu nav navbar navigation breadcrumb breadcrumbs topbar toolbar masthead footer comment comments "
    "disqus feedback replies respond share sharing social related recommended widget login signup search skip".split()
)
# Parts of a name that say nothing about what the element holds, and parts that only modify it.
GENERIC_PARTS = frozenset(
    "area bar block body bottom box button buttons container content element form group heading inner item items "
    "label left link links list main outer panel posts primary right secondary section slot text thread title top "
    "unit wrap wrapper".split()
)
MODIFIERS = frozenset("has hide is no non not show with without".split())
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def boilerplate_name(token: str) -> bool:
    """Whether the head of a class or id names boilerplate.

    The head is the last part before generic ones: menu in ``main-menu`` and
    ``menu-list``, policy in ``social-policy``; what follows ``has`` or ``no``
    only modifies.
    """
    parts = [p.lower() for p in _NAME.findall(token)]
    parts = parts[: next((k for k, p in enumerate(parts) if p in MODIFIERS), len(parts))]
    while parts and parts[-1] in GENERIC_PARTS:
        parts.pop()
    return bool(parts) and (parts[-1] in DROPPED_NAMES or _written_together(parts[-1]))


def _written_together(part: str) -> bool:
    """A name of boilerplate and a generic part in one word, such as ``commentlist``."""
    return any(
        (part[:k] in DROPPED_NAMES and part[k:] in GENERIC_PARTS)
        or (part[:k] in GENERIC_PARTS and part[k:] in DROPPED_NAMES)
        for k in range(2, len(part) - 1)
    )


class Line(NamedTuple):
    text: str
    tags: int
    linked: int
    home: int
    # How many open elements drop the line, and the number of the outermost one.
    drops: int
    dropper: int
    # The innermost open element with a name of boilerplate, as an index of ``LineParser.chain``.
    named: int
    rooted: bool
    # An item of a list in main, outside an article.
    listed: bool
    heading: bool


class Open(NamedTuple):
    """An open element."""

    tag: str
    number: int
    dropped: bool
    named: bool


class LineParser(HTMLParser):
    """Collects the lines of a page while its events stream by.

    What is open is kept in stacks and counters, so the work is linear in the
    page however deep its elements nest.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[Open] = [Open("", 0, False, False)]
        self.tags: Counter[str] = Counter()
        self.count = 0
        self.droppers: list[int] = []
        self.sections: list[int] = [0]
        self.roots: list[int] = []
        # Parent section and kind of every section: siblings of one kind belong together.
        self.above: dict[int, int] = {}
        self.kind: dict[int, tuple] = {0: (0, "", "")}
        # Droppers that cannot hold an article and have not ended, and roots that began inside of them.
        self.unended: set[int] = set()
        self.inside: dict[int, bool] = {}
        # Elements with a name of boilerplate; those of a compound name may be wrappers.
        self.named: dict[int, bool] = {}
        self.chain: list[tuple[int, int]] = [(0, 0)]
        self.innermost: list[int] = [0]
        self.bound: list[int] = []
        self.freed: set[int] = {0}
        self.articles = 0
        self.linked = False
        self._parts: list[str] = []
        self._tags = 0
        self._linked = 0

    def end_line(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            last = self.open[-1].tag
            self.lines.append(
                Line(
                    text,
                    max(1, self._tags),
                    self._linked,
                    self.roots[-1] if self.roots else self.sections[-1],
                    len(self.droppers),
                    self.droppers[0] if self.droppers else 0,
                    self.innermost[-1],
                    bool(self.roots),
                    bool(self.roots) and not self.tags["article"] and last == "li",
                    last in HEADINGS,
                )
            )
            self._tags = 0
        self._parts, self._linked = [], 0
        # No link goes over the border of a block.
        self.linked = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.end_line()
        self._tags += 1
        if tag == "br":
            self._parts.append(" ")
        elif tag == "a":
            # An anchor without a target links nothing; a second one ends the first.
            self.linked = any(name == "href" for name, _ in attrs)
        if tag in VOID or tag in INLINE or tag == "html":
            return
        # A paragraph ends where the next block begins, an item where the next item does.
        if self.open[-1].tag == "p" or tag == "li" == self.open[-1].tag:
            self.pop()
        attributes = dict(attrs)
        within = bool(self.roots)
        self.push(tag, attributes, self._drops(tag, attributes, within))
        if not self.droppers:
            self._judge_names(tag, attributes, within)

    def push(self, tag: str, attributes: dict[str, str | None], dropped: bool) -> None:
        self.count += 1
        self.tags[tag] += 1
        if dropped:
            self.droppers.append(self.count)
            if tag in NEVER_AROUND:
                self.unended.add(self.count)
        if tag in SECTIONS:
            self.above[self.count] = self.sections[-1]
            self.kind[self.count] = (self.sections[-1], tag, attributes.get("class") or "", attributes.get("id") or "")
            self.sections.append(self.count)
        if tag in ROOTS:
            self.roots.append(self.count)
            self.inside[self.count] = bool(self.droppers)
        self.open.append(Open(tag, self.count, dropped, False))

    def pop(self, ended: bool = False) -> None:
        tag, number, dropped, named = self.open.pop()
        self.tags[tag] -= 1
        if dropped:
            self.droppers.pop()
            if ended:
                self.unended.discard(number)
        if tag in SECTIONS:
            self.sections.pop()
        if tag in ROOTS:
            self.roots.pop()
        if named:
            self.innermost.pop()
            if self.bound and self.bound[-1] == number:
                self.bound.pop()

    def _name(self, wrapper: bool) -> None:
        """The element just opened has a name of boilerplate."""
        self.named[self.count] = wrapper
        self.chain.append((self.count, self.innermost[-1]))
        self.innermost.append(len(self.chain) - 1)
        self.bound.append(self.count)
        self.open[-1] = self.open[-1]._replace(named=True)

    def _judge_names(self, tag: str, attributes: dict[str, str | None], within: bool) -> None:
        names = f"{attributes.get('class') or ''} {attributes.get('id') or ''}".split()
        found = [n for n in names if boilerplate_name(n)]
        if tag in ROOTS:
            named = bool(self.bound)
            # The first article or main frees the elements around it; later ones with such a name are comments.
            if not self.articles:
                self.freed.update(self.bound)
                self.bound.clear()
            elif tag == "article" and found and (within or named):
                self._name(False)
            if tag == "article" and not (self.articles and named):
                self.articles += 1
        elif found and tag != "body":
            self._name(all(len(_NAME.findall(n)) > 1 for n in found))

    def _drops(self, tag: str, attrs: dict[str, str | None], inside: bool) -> bool:
        if tag in DROPPED or (tag == "header" and not inside):
            return True
        if "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return True
        if (attrs.get("role") or "").lower() in DROPPED_ROLES:
            return True
        return bool(re.search(r"display\s*:\s*none", attrs.get("style") or ""))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.end_line()
        self._tags += 1
        if tag == "a":
            self.linked = False
        if tag and self.tags[tag] > 0:
            while self.open[-1].tag != tag:
                self.pop()
            self.pop(ended=True)

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag not in ("script", "style"):
            self._parts.append(data)
            if self.linked:
                self._linked += len("".join(data.split()))

    def close(self) -> None:
        # A comment or declaration that never ends is no text.
        if self.rawdata.startswith("<!"):
            self.rawdata = ""
        super().close()
        self.end_line()
        lines = [x for x in self.lines if not x.drops or self._strayed(x)]
        if not any(x.rooted for x in lines):
            self._free_wrappers(lines)
        free = [True]
        for number, parent in self.chain[1:]:
            free.append(free[parent] and number in self.freed)
        self.lines = [x for x in lines if free[x.named]]

    def _strayed(self, line: Line) -> bool:
        """Whether an article's line is dropped by one element alone that cannot hold it and never ended."""
        return line.drops == 1 and line.dropper in self.unended and self.inside.get(line.home, False)

    def _free_wrappers(self, lines: list[Line]) -> None:
        """Without article or main, a compound name around most of the text is that of a wrapper."""
        size = [0] * len(self.chain)
        rich = [False] * len(self.chain)
        best = max((len(x.text) / x.tags for x in lines), default=0)
        for x in lines:
            size[x.named] += len(x.text)
            rich[x.named] |= len(x.text) / x.tags == best
        # Elements come before those inside of them.
        for k in range(len(self.chain) - 1, 0, -1):
            parent = self.chain[k][1]
            size[parent] += size[k]
            rich[parent] |= rich[k]
        for k, (number, _) in enumerate(self.chain):
            if k and rich[k] and self.named[number] and 2 * size[k] > size[0]:
                self.freed.add(number)

    def chosen(self, homes: set[int]) -> tuple[set[tuple], set[int]]:
        """Kinds of the homes of content, and all sections around them."""
        around: set[int] = set()
        for home in homes:
            at = self.above.get(home, 0)
            while at and at not in around:
                around.add(at)
                at = self.above[at]
        return {self.kind[h] for h in homes}, around | {0}


def smoothed(values: np.ndarray, sigma: float = SIGMA, radius: int = RADIUS) -> np.ndarray:
    """Gaussian mean of each value and its neighbours; the borders repeat."""
    kernel = np.exp(-(np.arange(-radius, radius + 1) ** 2) / (2 * sigma**2))
    return np.convolve(np.pad(values, radius, mode="edge"), kernel / kernel.sum(), mode="valid")


def without_menus(lines: list[Line]) -> list[Line]:
    """The lines without runs of linked ones outside article and main.

    In main, an item of a list that is a link and nothing else is left out too.
    """
    out: list[Line] = []
    run: list[Line] = []
    for x in lines:
        letters = len(x.text.replace(" ", ""))
        if not x.rooted and x.linked > MAX_LINK_SHARE * letters:
            run.append(x)
            continue
        out += run if len(run) < MENU_LINES else []
        run = []
        if not (x.listed and x.linked >= letters):
            out.append(x)
    return out + (run if len(run) < MENU_LINES else [])


def content_lines(parser: LineParser) -> list[str]:
    kept = without_menus(parser.lines)
    if not kept:
        return []
    ratio = np.array([len(x.text) / x.tags for x in kept])
    smooth = smoothed(ratio)
    threshold = min(float(smooth.std()), float(ratio.max()))
    # Smoothing lifts the neighbours of long lines; the line itself must reach the threshold too.
    homes = {x.home for x, s, r in zip(kept, smooth, ratio) if s >= threshold and r >= threshold}
    kinds, around = parser.chosen(homes)
    return [
        x.text for x in kept if parser.kind[x.home] in kinds or (x.heading and x.home in around)
    ]


def main_text(html: str | None) -> str:
    """Content lines of a page, joined by line feeds; null and empty pages have none."""
    if not html:
        return ""
    parser = LineParser()
    parser.feed(html)
    parser.close()
    return "\n".join(content_lines(parser))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Each page is parsed alone and in whole; nothing is shuffled.  Equal rows
    give equal rows, an empty table gives no rows, and other columns are not
    looked at.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        return pa.record_batch(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    return map_slices(rows, run, "page_id long, url string, text string, n_chars long", "html")
