"""Main text of web pages by line-block distribution.

Markup is stripped and the page becomes lines, one for each block element. A line's weight is the length of its text
without links; lines of menus, forms, adverts, notices, reader comments and the like weigh nothing. The sums of weights over sliding
windows of three lines show the text as a plateau: it begins at the line where the sum surges and ends where it dives
into dropped lines or links; light lines between do not end it. This is so on every page, marked or not: a mark as the article raises the weights of
an element's lines and keeps its plateaus apart from what stands around it, but surge and dive points set both ends of the text. Forms, and elements that are named like a menu, sidebar, advert
or comment, are dropped unless they hold most of the page's text and its title or article: such an element wraps the page.

Scale: one pass over the pages, no shuffle, one page at a time; the scanner is linear in the page's length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batch

WINDOW = 3
#: Weight in a window at which text surges, and dropped or linked lines of low sums that a plateau may hold.
SURGE, GAP = 90, 4
#: Weight that an article's mark adds to a line that has some: three such lines surge however short they are.
RAISE = SURGE // WINDOW

#: Elements of HTML by what they mean here.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table"
    " tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("aside button datalist dialog footer form head iframe menu nav noscript object select svg template".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
#: Elements that are tracked as containers; others may be left open without harm.
CONTAINERS = DROPPED | frozenset("article blockquote body details div dl figure header html main ol section table ul".split())
#: Words of class, id and role names that mark a container as no part of the article.
HINTS = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertisements advertising banner sponsor sponsored promo promotion promoted"
    " sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar cookie cookies consent gdpr"
    " notice notices notification disclaimer alert popup modal overlay newsletter subscribe subscription signup login register"
    " comment comments commentlist discussion replies reply respond disqus share sharing social related recommended recommendations"
    " widget widgets pager pagination contentinfo complementary search".split()
)
OUTER_HINTS = frozenset(["header", "head", "top"])

_ATTRS = r"(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+"
#: Names and attributes are possessive and no branch runs past the next tag, so that hostile pages can't be scanned again and again.
_SCAN = re.compile(
    r"<!--(?:.*?-->|.*)"
    rf"|<(?P<raw>script|style|textarea|title|xmp|noembed|noframes)\b{_ATTRS}>(?:.*?</(?P=raw)\b[^<>]*+>?|.*)"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>{_ATTRS})>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*+)[^<>]*+>?"
    r"|<[!?/][^>]*>?",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
#: Names that tell of a state of the element and not of what it is.
_STATE = re.compile(r"(?:^|\s)(?:has|have|with|without|no|is|not|show|hide)[-_]\S*", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)


@dataclass
class Container:
    """An open element. hard: what is in it is no text; soft: nor is it, unless release() says so; above: the next soft one around it."""

    name: str
    hard: bool = False
    soft: bool = False
    article: bool = False
    above: Container | None = None
    begin: int = 0
    size: int = 0
    core: bool = False
    dropped: bool = False


def lines(html: str) -> list[tuple[str, int, int, bool]]:
    """(text, weight, number of the outermost element around it that is marked as the article or 0, in a dropped element) of each block with text, in page order."""
    out: list[tuple[str, int, int, bool, Container | None]] = []
    stack: list[Container] = []
    known: list[Container] = []  # all soft containers, outer ones first
    open_: Counter[str] = Counter()
    held: Counter[str] = Counter()  # open containers that are hard, or marked as the article; number of the last marked one
    parts: list[str] = []
    links = in_link = total = 0
    soft: Container | None = None

    def flush() -> None:
        nonlocal links, total
        text = " ".join(unescape("".join(parts)).split())
        if text:
            out.append((text, max(0, len(text) - links), held["number"] if held["article"] > 0 else 0, held["hard"] > 0, soft))
            total += len(text)
        parts.clear()
        links = 0

    def add(text: str) -> None:
        nonlocal links
        parts.append(text)
        if in_link:
            links += len(text)

    def close() -> None:
        nonlocal soft
        c = stack.pop()
        open_[c.name] -= 1
        held["hard"] -= c.hard
        held["article"] -= c.article
        c.size = total - c.begin
        if c.soft:
            soft = c.above

    at = 0
    for m in _SCAN.finditer(html):
        if m.start() > at:
            add(html[at : m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing = bool(m["end"] or m["end2"])
        if name == "a":
            in_link = 0 if closing else 1
        if name == "br":
            add(" ")
        if name in CONTAINERS:
            flush()
            if closing:
                if open_[name]:
                    while stack[-1].name != name:
                        close()
                    close()
            else:
                if name == "body":  # whatever was left open before it ends here
                    while stack and stack[-1].name != "html":
                        close()
                c = _container(name, m["attrs"] or "", held["article"] > 0)
                c.above, c.begin = soft, total
                stack.append(c)
                open_[name] += 1
                held["hard"] += c.hard
                held["number"] += c.article and not held["article"]
                held["article"] += c.article
                if c.soft:
                    known.append(c)
                    soft = c
            in_link = 0
        elif name in BLOCKS:
            flush()
        if not closing and (name == "h1" or stack and stack[-1].article):
            up = soft
            while up and not up.core:
                up.core, up = True, up.above
    add(html[at:])
    flush()
    while stack:
        close()
    release(known, total, lambda c: c.core or c.name == "form")
    if not any(w and not h and not (c and c.dropped) for _, w, _, h, c in out):
        release(known, total, lambda c: True)
    return [(t, 0 if (d := h or bool(c and c.dropped)) else w, a, d) for t, w, a, h, c in out]


def release(known: list[Container], total: int, may: Callable[[Container], bool]) -> None:
    """Marks soft containers as dropped but for those that may hold the text and do hold most of the page's: they wrap the page."""
    for c in known:
        c.dropped = not (may(c) and 2 * c.size > total) or bool(c.above and c.above.dropped)


def _container(name: str, attrs: str, inside: bool) -> Container:
    given = [_STATE.sub(" ", " ".join(found)) for found in _NAMES.findall(attrs)] if attrs else []
    names = {w for g in given for w in _WORD.findall(g.lower())}
    article = name in ("article", "main") or "articlebody" in attrs.lower() or bool(names & {"main", "article"} and name in ("div", "section") and not names & HINTS)
    if name in ("html", "body", "article", "main"):
        return Container(name, bool(_HIDDEN.search(attrs)) or name == "article" and "comment" in names, False, article)
    hard = name in DROPPED and name != "form" or bool(attrs and _HIDDEN.search(attrs)) or (not inside and name == "header")
    soft = name == "form" or bool(names & HINTS) or (not inside and bool(names & OUTER_HINTS))
    return Container(name, hard, soft, article)


def plateaus(weights: list[int], breaks: list[bool], window: int = WINDOW, surge: int = SURGE, gap: int = GAP) -> list[tuple[int, int]]:
    """First and last line (exclusive) of each plateau of the window sums.

    Light lines (lists, dialogue, cells) never end a plateau: only `breaks`, lines that are dropped or mostly links, count to the gap.
    """
    n = len(weights)
    sums = [sum(weights[i : i + window]) for i in range(n)]
    out, i = [], 0
    while i < n:
        if sums[i] < surge or not weights[i]:
            i += 1
            continue
        start = end = i  # the surge point
        low, late, j = 0, 0, i
        while j < n and low <= gap:  # until the sums have dived over more breaks than a gap
            if sums[j] >= surge:
                low = late = 0
            else:
                low += breaks[j]
                late += low > 0  # lines of low sums since the first break
            if weights[j] and late <= window:
                end = j
            j += 1
        out.append((start, end + 1))
        i = j
    return out


def text_spans(rows: list[tuple[str, int, int, bool]]) -> list[tuple[int, int]]:
    """First and last line (exclusive) of each part of lines() that is text, by window sums.

    Lines in a marked element weigh `RAISE` more. If the sums surge in marked elements, the plateaus there are the text, but for elements whose plateaus weigh less than
    half of the heaviest one's: teasers of other articles and comments are marked as articles too. If they surge in none, the page's heaviest
    plateau is the text. A page without a plateau is short: its marked lines, else all that has weight.
    """
    weights = [r[1] + RAISE if r[1] and r[2] else r[1] for r in rows]
    breaks = [2 * r[1] < len(r[0]) for r in rows]
    inside = [0, *[r[2] for r in rows], 0]
    ends = [k for k in range(len(rows) + 1) if inside[k] != inside[k + 1]]
    articles = [(a, b) for a, b in zip(ends, ends[1:]) if rows[a][2]]
    weight = lambda spans: sum(sum(weights[a:b]) for a, b in spans)
    marked = [[(a + s, a + e) for s, e in plateaus(weights[a:b], breaks[a:b])] for a, b in articles]
    if (most := max(map(weight, marked), default=0)) > 0:
        return [span for spans in marked if 2 * weight(spans) >= most for span in spans]
    if found := plateaus(weights, breaks):
        return [max(found, key=lambda f: sum(weights[f[0] : f[1]]))]
    filled = [k for k, w in enumerate(weights) if w]
    return [(a, b) for a, b in articles if not all(r[3] for r in rows[a:b])] or ([(filled[0], filled[-1] + 1)] if filled else [])


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by line feeds; empty for null, empty and textless pages."""
    rows = lines(html or "")
    return "\n".join(r[0] for a, b in text_spans(rows) for r in rows[a:b] if not r[3])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages(page_id, url, html; other columns are ignored).

    Null and empty html give an empty text. Repeated rows and null ids stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column("html")]
            yield batch(page_id=b.column("page_id"), url=b.column("url"), text=pa.array(texts, pa.string()), n_chars=pa.array(map(len, texts), pa.int64()))

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
