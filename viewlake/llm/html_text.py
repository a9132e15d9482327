"""Operator 9: main text of web pages.

The standard library's parser streams a page's events; blocks of text are its lines.
Each line has a text-to-tag ratio: characters outside links over tags. The ratios are
smoothed by a Gaussian, and a threshold splits the lines into content and the rest.

Markup helps twice. Menus, headers, footers, sidebars, notices, adverts, forms, comments
and the like are boilerplate: their lines have the ratio 0 and are not kept. A class or id
says so by a whole token, all of whose parts name boilerplate or its place on the page
("right-sidebar", not "has-sidebar" or "social-history"). No element that holds nearly all
of a page's text is boilerplate, whatever its name, unless an article stands outside it:
such a form or layout is the page. An open menu or header ends where an article begins. A heading that says no more than
"Comments" begins boilerplate up to the end of the element it stands in.

The lines of an article or main element are one region, also where boilerplate stands
between them; elsewhere a menu, footer or the like ends a region, an advert does not. On
every page a region is kept whole, short lines included, if a smoothed ratio in it reaches
the threshold; no mark replaces that.

Pages are independent rows; nothing is shuffled.

Edge cases: a NULL or empty page, or one without content, has the text "". Markup that
is cut off or badly nested is read as far as it goes. Repeated rows are rows of their
own. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlake.llm.scratch import text_slices

INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements whose text is never a reader's.
UNREAD = {"head", "title", "script", "style", "noscript", "template", "button", "select", "textarea", "input", "iframe", "object", "svg", "canvas"}
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
MARKED_CONTENT = {"article", "main"}
#: Elements that an article or main element ends if they are still open.
BEFORE_CONTENT = {"nav", "header", "menu"}
#: Words of classes and ids, and roles, of blocks that are not the article.
STRUCTURE_WORDS = {"breadcrumb", "breadcrumbs", "comment", "comments", "discussion", "disqus", "footer", "header", "masthead", "menu", "nav", "navbar", "navigation", "reactions", "replies", "responses", "sidebar", "toolbar"}
INSET_WORDS = {"ad", "ads", "adbox", "advert", "adverts", "advertisement", "advertisements", "adsense", "banner", "consent", "cookie", "cookies", "gdpr", "modal", "newsletter", "notice", "notices", "notification", "paywall", "popup", "promo", "promoted", "related", "share", "sharing", "signup", "social", "sponsor", "sponsored", "subscribe", "widget"}
#: Words that say where a block stands or what holds it, and nothing of its content.
PLACE_WORDS = {"area", "bar", "block", "bottom", "box", "button", "buttons", "col", "column", "container", "content", "desktop", "fixed", "form", "global", "inner", "item", "items", "left", "links", "list", "main", "message", "mobile", "module", "outer", "page", "panel", "posts", "primary", "reader", "right", "secondary", "section", "site", "sticky", "stories", "text", "thread", "top", "unit", "user", "wrap", "wrapper"}
BOILERPLATE_ROLES = {"alert", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
COMMENT_HEADING = re.compile(r"(?:\d+ )?(?:reader |user )?(?:comments|replies|responses|reactions|kommentare|commentaires|comentarios)(?: ?\(?\d+\)?)?:?", re.IGNORECASE)
#: A start tag of the left kind ends an open one of the right kinds.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SMOOTHING = 2.0
#: An element with this share of a page's text is not boilerplate.
MOST_BOILERPLATE = 0.8
PIECE_CHARS = 65_536

_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


class Element:
    """An open element."""

    __slots__ = ("tag", "splits", "boilerplate", "unread", "region")

    def __init__(self, tag: str, splits: bool, boilerplate: int | None, unread: bool, region: int):
        self.tag, self.splits = tag, splits  # whether it ends the region around it
        self.boilerplate = boilerplate  # number of the innermost boilerplate, None outside
        self.unread = unread
        self.region = region  # of the innermost article or main element, 0 outside


class Line:
    """A block of text, its tags, and the characters of it that are links."""

    __slots__ = ("text", "tags", "linked", "boilerplate", "region", "in_article")

    def __init__(self, text: str, tags: int, linked: int, boilerplate: int | None, region: int, in_article: bool):
        self.text, self.tags, self.linked = text, tags, linked
        self.boilerplate, self.region, self.in_article = boilerplate, region, in_article


class Lines(HTMLParser):
    """The lines of a page, and which boilerplate stands in which."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.within: list[int | None] = []  # for each boilerplate the one around it
        self._open = [Element("", False, None, False, 0)]
        self._text: list[str] = []
        self._tags, self._linked, self._links, self._region = 0, 0, 0, 0

    def _end_line(self) -> None:
        text = " ".join("".join(self._text).split())
        if text or self._tags:
            inner = self._open[-1]
            self.lines.append(Line("" if inner.unread else text, self._tags, min(self._linked, len(text)), inner.boilerplate, inner.region or self._region, inner.region > 0))
        self._text, self._tags, self._linked = [], 0, 0

    def _new_boilerplate(self) -> int:
        self.within.append(self._open[-1].boilerplate)
        return len(self.within) - 1

    def _close(self, at: int) -> None:
        """Close the elements from place ``at`` on."""
        outer = self._open[at - 1]
        closed = self._open[at:]
        if any(e.tag not in INLINE or (e.boilerplate, e.unread) != (outer.boilerplate, outer.unread) for e in closed):
            self._end_line()
        self._links -= sum(e.tag == "a" for e in closed)
        if closed[0].tag in HEADINGS and self.lines and COMMENT_HEADING.fullmatch(self.lines[-1].text):
            outer.boilerplate = self.lines[-1].boilerplate = self._new_boilerplate()
            self._region += 1
        if any(e.splits for e in closed):
            self._region += 1
        del self._open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in MARKED_CONTENT:
            for at in range(1, len(self._open)):
                if self._open[at].tag in BEFORE_CONTENT:
                    self._close(at)
                    break
        if tag not in INLINE:
            ends = ENDS.get(tag, {"p"} if tag not in VOID else set())
            for at in range(len(self._open) - 1, 0, -1):
                name = self._open[at].tag
                if name in ends:
                    self._close(at)
                    break
                if name not in INLINE and name != "p":
                    break
            self._end_line()
        self._tags += 1
        if tag in VOID:
            return
        outer = self._open[-1]
        kind = _boilerplate_kind(tag, attrs)
        unread = outer.unread or tag in UNREAD
        if kind or unread != outer.unread or tag in MARKED_CONTENT:
            self._end_line()
        splits = kind == "structure" or tag in MARKED_CONTENT
        self._region += splits
        region = self._region if tag in MARKED_CONTENT else outer.region
        self._open.append(Element(tag, splits, self._new_boilerplate() if kind else outer.boilerplate, unread, region))
        self._links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        for at in range(len(self._open) - 1, 0, -1):
            if self._open[at].tag == tag:
                self._close(at)
                return

    def handle_data(self, data: str) -> None:
        self._text.append(data)
        if self._links > 0:
            self._linked += len(data)

    def close(self) -> None:
        super().close()
        self._end_line()

    def boilerplate(self) -> list[bool]:
        """Which boilerplate is none of the page's text, or stands in such."""
        held, marked = [0] * len(self.within), [0] * len(self.within)
        total = total_marked = 0
        for line in self.lines:
            size = len(line.text)
            size_marked = size if line.in_article else 0
            total, total_marked = total + size, total_marked + size_marked
            if line.boilerplate is not None:
                held[line.boilerplate] += size
                marked[line.boilerplate] += size_marked
        for at in range(len(held) - 1, -1, -1):  # inner ones come after outer ones
            if self.within[at] is not None:
                held[self.within[at]] += held[at]
                marked[self.within[at]] += marked[at]
        out: list[bool] = []
        for at, around in enumerate(self.within):
            is_page = held[at] >= MOST_BOILERPLATE * total and marked[at] == total_marked
            out.append(not is_page or (around is not None and out[around]))
        return out


def _boilerplate_kind(tag: str, attrs: list[tuple[str, str | None]]) -> str:
    """"structure" for parts of the page around the article, "inset" for what may stand
    inside it, "" for neither."""
    if tag in BOILERPLATE:
        return "structure"
    if tag in MARKED_CONTENT or tag in ("html", "body"):
        return ""
    kind = ""
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            kind = kind or "inset"
        elif value and name == "role" and value.lower() in BOILERPLATE_ROLES:
            return "structure"
        elif value and name in ("class", "id"):
            for token in value.split():
                parts = [part.lower() for part in _PARTS.findall(token)]
                named = [p for p in parts if p in STRUCTURE_WORDS or p in INSET_WORDS]
                if named and all(p in PLACE_WORDS or p in named or p.isdigit() for p in parts):
                    kind = "structure" if kind == "structure" or not STRUCTURE_WORDS.isdisjoint(named) else "inset"
    return kind


def smooth(ratios: np.ndarray, width: float = SMOOTHING) -> np.ndarray:
    """The ratios under a Gaussian of ``width`` lines."""
    reach = int(3 * width)
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / width) ** 2)
    padded = np.concatenate((np.zeros(reach), ratios, np.zeros(reach)))
    return np.convolve(padded, weights / weights.sum(), "valid")


def main_text(html: str) -> str:
    """The article of a page, blocks joined by one space."""
    parser = Lines()
    for at in range(0, len(html), PIECE_CHARS):
        parser.feed(html[at:at + PIECE_CHARS])
    parser.close()
    lines = parser.lines
    if not lines:
        return ""
    out = parser.boilerplate()
    able = [line.boilerplate is None or not out[line.boilerplate] for line in lines]
    smoothed = smooth(np.array([(len(line.text) - line.linked) / max(1, line.tags) if a else 0.0 for line, a in zip(lines, able)]))
    threshold = smoothed.std() if len(lines) > 1 else 0.0
    kept = {line.region for line, a, ratio in zip(lines, able, smoothed) if a and line.text and ratio >= threshold}
    return " ".join(line.text for line, a in zip(lines, able) if a and line.text and line.region in kept)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "html"):
            texts = pa.array([main_text(html) for html in batch.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), texts], ["page_id", "url", "text"])

    slim = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return slim.mapInArrow(run, "page_id long, url string, text string")
