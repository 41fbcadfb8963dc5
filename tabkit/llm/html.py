"""Main text of web pages by line-block distribution.

Markup becomes lines (one per block). A line weighs as much as its running text: what sits in menus,
adverts, notices, forms or comments, and what consists of links, weighs nothing. The weights are
summed over sliding windows of lines; text begins where the sum surges above the threshold and
ends where it dives to nothing. The lines between are the main text. This holds on every page: where
a page marks its article, the running text of the article weighs more, and that is all.

Class words are weak evidence: a wrapper may be called after the sidebar it has. An element with such a
name is judged by its own lines once the page is read. One that holds most of the page's weight stays;
a name that says nothing else (``ad``, ``related-posts``) removes the rest, a name that merely contains
such a word (``related-work``) removes only what consists of links.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.runtime import q
from .common import with_arrow

WINDOW = 3
SURGE = 60  # characters in a window
LINK_SHARE = 0.5
FAINT = 4  # this part weighs running text outside an article in an element with a furniture word in its name
MARKED = 4  # so many times weighs running text inside an article or main element

# Element names of HTML and the words by which pages name their furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template noscript iframe object svg math head title textarea select option datalist canvas audio video map".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
CHROME = frozenset("nav footer aside button dialog menu label search".split())
SOFT_CHROME = frozenset("form fieldset".split())  # whole pages stand inside a form
MAIN = frozenset("article main".split())
BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul").split())
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("article section div main body table ul ol dl blockquote nav aside footer header form".split())
FURNITURE = frozenset(("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
                       "dialog disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination paywall popup "
                       "promo promoted promotion reactions recommended related replies reply share sharing sidebar signup skip social sponsor sponsored "
                       "subscribe toolbar widget").split())
READERS = frozenset("comment comments disqus replies reply".split())
NOTICES = frozenset("ad ads adv advert adverts advertisement advertising consent cookie cookies gdpr promoted sponsor sponsored".split())
PLAIN_NAMES = frozenset(("site page global main top bottom left right side primary secondary inner outer box block section area zone unit slot bar list item items "
                         "row col column wrap wrapper container holder panel content body text title heading form button buttons btn link links icon icons label group "
                         "post posts article articles story stories news user author reader sticky fixed mobile desktop").split())
OF_ARTICLE = frozenset("header banner masthead".split())  # inside an article these hold its own title
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())

# A quoted value ends at a quote that a space or the end of the tag follows; where none does, the tag ends at the next ">".
QUOTED = "|".join(rf"{c}(?:[^{c}<]*+|[^{c}]*+(?<!=)){c}(?=\s|/?>|\Z)" for c in "\"'")
TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)(?:((?:[^>\"']|{QUOTED})*+)|([^>]*+))(?:>|\Z)", re.DOTALL)
NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")


@dataclass(eq=False)
class Region:
    """An element whose name speaks of furniture, with what its lines add up to."""
    parent: "Region | None"
    sure: bool  # the name says nothing else
    words: frozenset[str]
    in_main: bool
    weight: int = 0
    marked: int = 0  # weight of the main elements inside
    plain: int = 0
    linked: int = 0
    readers: bool = False
    out: bool = False
    faint: bool = False


@dataclass
class Line:
    text: str
    weight: int
    main: bool
    region: Region | None
    plain: int
    linked: int


def _kind(name: str, attrs: str, in_main: bool, region: Region | None) -> str | Region:
    """What an element is: "chrome" without doubt, a region to be judged, or nothing of the kind ("")."""
    if name in CHROME:
        return "chrome"
    sure, words = False, set()
    if name in SOFT_CHROME or (name == "header" and not in_main):
        sure, words = True, {name}
    elif name in ("html", "body", *MAIN) or not attrs:
        return ""
    for m in NAMED.finditer(attrs):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id"):
            for token in value.split():
                parts = set(WORD.findall(token))
                named = parts & FURNITURE - (OF_ARTICLE if in_main else frozenset())
                words |= named
                sure = sure or bool(named) and parts <= FURNITURE | PLAIN_NAMES
        elif key == "role" and value in ROLES:
            return "chrome"
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
            return "chrome"
    return Region(region, sure, frozenset(words), in_main) if words else ""


def _judge(lines: list[Line], regions: list[Region]) -> None:
    """Take the weight from the lines of furniture. ``regions`` come parents first."""
    for r in regions:
        r.readers = r.sure and bool(r.words & READERS) or r.parent is not None and r.parent.readers
    for x in lines:
        if x.region is not None:
            x.region.weight += x.weight
            x.region.marked += x.weight if x.main and not x.region.in_main else 0
            x.region.plain += x.plain
            x.region.linked += x.linked
    for r in reversed(regions):
        if r.parent is not None:
            r.parent.weight += r.weight
            r.parent.marked += r.marked if r.in_main == r.parent.in_main else 0 if r.parent.in_main else r.weight
            r.parent.plain += r.plain
            r.parent.linked += r.linked
    total = sum(x.weight for x in lines if x.region is None or not x.region.readers)
    for r in regions:
        most = 2 * (r.marked if r.words & NOTICES else r.weight) > total and r.weight >= SURGE
        if r.parent is not None and r.parent.out or r.readers:
            r.out = True
        elif not most:
            r.out = r.sure or r.linked > LINK_SHARE * r.plain
            r.faint = not r.in_main or r.parent is not None and r.parent.faint
        else:
            r.faint = r.parent is not None and r.parent.faint
    for x in lines:
        if x.region is not None and x.region.out:
            x.weight = 0
        elif x.region is not None and x.region.faint:
            x.weight //= FAINT


class _Reader:
    """Walks the markup once and collects lines."""

    def __init__(self) -> None:
        self.open: list[tuple[str, str | Region]] = []  # name, kind: "", chrome, hidden, main, link or a region
        self.region: Region | None = None
        self.regions: list[Region] = []
        self.depth = {"chrome": 0, "hidden": 0, "main": 0, "link": 0}
        self.parts: list[str] = []
        self.plain = self.linked = 0
        self.lines: list[Line] = []

    def push(self, name: str, kind: str | Region) -> None:
        self.open.append((name, kind))
        if isinstance(kind, Region):
            self.region = kind
            self.regions.append(kind)
        elif kind:
            self.depth[kind] += 1

    def pop(self) -> None:
        _, kind = self.open.pop()
        if isinstance(kind, Region):
            self.region = kind.parent
        elif kind:
            self.depth[kind] -= 1

    def text(self, raw: str) -> None:
        if self.depth["hidden"] or not raw:
            return
        self.parts.append(raw)
        n = len(raw) - raw.count(" ") if "&" not in raw else len(unescape(raw))
        self.linked += n if self.depth["link"] else 0
        self.plain += n

    def flush(self) -> None:
        if not self.parts:
            return
        line = " ".join(unescape("".join(self.parts)).split())
        if line:
            chrome, main = self.depth["chrome"] > 0, self.depth["main"] > 0
            link = self.linked > LINK_SHARE * self.plain
            times = 0 if chrome or (link and not main) else MARKED if main and not link else 1
            self.lines.append(Line(line, times * len(line), main, self.region, self.plain, self.linked))
        self.parts, self.plain, self.linked = [], 0, 0

    def start(self, name: str, attrs: str) -> None:
        if name in BLOCK:
            self.flush()
            if name in CLOSES_P:
                self.close_upto({"p"})
            if name in SIBLINGS:
                self.close_upto(SIBLINGS[name])
        elif name == "br":
            self.text(" ")
        if name in VOID or attrs.endswith("/") and name not in BLOCK | RAW:
            return
        in_main = self.depth["main"] > 0
        kind = "hidden" if name in HIDDEN else "main" if name in MAIN else _kind(name, attrs, in_main, self.region)
        if kind == "chrome" and name not in BLOCK:
            kind = "hidden"  # a button inside a paragraph does not end it
        self.push(name, kind or ("link" if name == "a" else ""))

    def close_upto(self, names: set[str]) -> None:
        """Close an open element of these names, unless a container stands between."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in names:
                while len(self.open) > i:
                    self.pop()
                return
            if self.open[i][0] in SCOPE:
                return

    def end(self, name: str) -> None:
        if name in BLOCK:
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == name:
                while len(self.open) > i:
                    self.pop()
                return
            if self.open[i][0] in SCOPE and name not in SCOPE:
                return


def lines_of(html: str | None) -> list[Line]:
    html = html or ""
    reader, at = _Reader(), 0
    while (m := TAG.search(html, at)) is not None:
        reader.text(html[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            reader.end(name)
            continue
        reader.start(name, (m[3] or m[4] or "").rstrip())
        if name in RAW:  # nothing inside is markup
            closing = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.IGNORECASE).search(html, at)
            at = closing.end() if closing else len(html)
            reader.end(name)
    reader.text(html[at:])
    reader.flush()
    _judge(reader.lines, reader.regions)
    return reader.lines


def main_range(weights: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """(first, last) of the lines between each surge point and its dive point. The surge is the test that each stretch
    passes by itself, however heavy another one is."""
    n = len(weights)
    sums = [sum(weights[i:i + window]) for i in range(n)]
    threshold = min(surge, max(sums, default=0))  # a page of short lines still has its text
    found, i = [], 0
    while i < n:
        if sums[i] >= threshold > 0 and weights[i] > 0:
            j = i
            while j + 1 < n and sums[j + 1] > 0:
                j += 1
            while weights[j] == 0:
                j -= 1
            found.append((i, j))
            i = j + 1
        else:
            i += 1
    return found


def extract(html: str | None) -> str:
    lines = lines_of(html)
    weights = [x.weight for x in lines]
    return "\n".join(lines[i].text for a, b in main_range(weights) for i in range(a, b + 1) if weights[i])


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """All columns of ``pages`` with ``text`` (main text, blocks joined by line breaks; empty if none)
    and ``n_chars`` (its code points). Columns of these names are replaced.

    A null or empty page gives an empty text. Rows are independent: one pass, no shuffle.
    """
    added = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(htmls: list[str | None]) -> dict[str, list]:
        texts = [extract(h) for h in htmls]
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    return with_arrow(pages, pages[q(html)], added, run, rows=200)
