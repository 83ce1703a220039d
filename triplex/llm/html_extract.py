"""Main text of web pages by a maximum-scoring subsequence (operator 8).

A page is a sequence of words and tags.  Words score positive, tags negative;
a linear scan finds the contiguous region with the highest sum, extended to
the content element that it lies in, and its text is the content.  Elements that are never content (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, comments) are left out of
the sequence first, by their name or by a whole token of ``class``, ``id`` or
``role`` that marks them.  An element that holds an ``article`` or ``main`` is
never left out, nor is one that holds most of the words of a page without
either; what is left out inside of it still is.  Elements end where HTML ends
them, so one without its optional end tag takes nothing else along.

Weights come from labelled pages: those whose markup names the content by an
``article`` or ``main`` element.  For each known tag the counts inside and
outside of the labelled region are summed over all pages; a tag that is rarer
outside costs less.  The table has one row per known tag at most.

Defined results: null and empty html give an empty text, as does a page
without words; repeated rows are rows of their own; an empty table gives no
rows; other columns are ignored whatever their names; nothing is cut off,
however long; unclosed elements end with the page.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplex.llm.common import long_ids

# Elements that are never content, and tokens of class, id or role
# that mark such elements, alone or joined with each other and with affixes.
LEFT_OUT = frozenset((
    "head", "nav", "header", "footer", "aside", "form", "button", "select", "textarea", "menu", "dialog",
    "iframe", "object", "svg", "canvas", "template", "noscript",
))
RAW = ("script", "style", "title", "textarea", "noscript", "iframe", "template")
MARKS = frozenset((
    "ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "banner", "sidebar", "side",
    "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "cookie",
    "cookies", "consent", "notice", "alert", "popup", "modal", "newsletter", "subscribe", "signup", "login", "share",
    "social", "related", "comment", "comments", "reply", "replies", "respond", "complementary", "contentinfo", "search",
))
AFFIXES = frozenset((
    "site", "page", "global", "main", "primary", "secondary", "top", "bottom", "left", "right", "mobile", "desktop",
    "sticky", "fixed", "js", "block", "box", "bar", "area", "list", "item", "items", "link", "links", "wrap", "wrapper",
    "container", "inner", "section", "widget", "widgets", "group", "panel", "unit", "slot", "zone", "form", "button",
    "buttons", "icons", "toggle", "message", "policy",
))
CONTENT = ("article", "main")
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
INLINE = frozenset((
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr",
))
BLOCKS = frozenset((
    "address", "article", "blockquote", "body", "br", "dd", "details", "div", "dl", "dt", "figcaption", "figure", "h1",
    "h2", "h3", "h4", "h5", "h6", "hr", "html", "img", "li", "main", "ol", "p", "pre", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
))
# Elements that may lack an end tag: the start tags that end them, and the open elements that keep them open.
_ROWS = frozenset(("tr", "tbody", "thead", "tfoot"))
_CELL = (_ROWS | {"td", "th"}, ("table",))
IMPLIED = {
    "p": (BLOCKS - {"br", "img", "html", "body", "summary"} | {
        "aside", "fieldset", "footer", "form", "header", "hgroup", "menu", "nav",
    }, ("table", "td", "th", "caption", "button", "object")),
    "li": (frozenset(("li",)), ("ul", "ol", "menu", "table")),
    "dd": (frozenset(("dd", "dt")), ("dl", "table")),
    "dt": (frozenset(("dd", "dt")), ("dl", "table")),
    "td": _CELL,
    "th": _CELL,
    "tr": (_ROWS, ("table",)),
    "tbody": (_ROWS - {"tr"}, ("table",)),
    "thead": (_ROWS - {"tr"}, ("table",)),
    "tfoot": (_ROWS - {"tr"}, ("table",)),
    "option": (frozenset(("option", "optgroup")), ("select",)),
    "head": (BLOCKS - {"html"}, ()),
}
ENDS = {
    tag: [(name, keep) for name, (tags, keep) in IMPLIED.items() if tag in tags]
    for tag in frozenset().union(*(tags for tags, _ in IMPLIED.values()))
}
CELLS = ("td", "th", "caption", "table")
OTHER = "other"
WORD = "word"

_TOKEN = re.compile(
    r"(?P<comment><!--.*?(?:-->|\Z))|(?P<other><[!?][^>]*+(?:>|\Z))"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.I | re.S,
)
_HINT = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+")


def _is_marked(name: str, attrs: str) -> bool:
    if name in ("html", "body", *CONTENT) or not attrs:
        return False
    return any(_marks(w) for m in _HINT.finditer(attrs) for w in (m[1] or m[2] or m[3] or "").lower().split())


@lru_cache(maxsize=1 << 16)
def _marks(token: str) -> bool:
    parts = _PART.findall(token)
    return any(p in MARKS for p in parts) and all(p in MARKS or p in AFFIXES for p in parts)


def _extents(parts: list) -> dict[int, int]:
    """Where each element that may be left out ends: index of its start tag to the index behind it."""
    ends: dict[int, int] = {}
    opened: list[tuple[str, int, bool]] = []
    at: dict[str, list[int]] = {}  # places of the open elements of a name; all but inline ones under ""

    def close(place: int, end: int) -> None:
        while len(opened) > place:
            name, i, wanted = opened.pop()
            at[name].pop()
            if name not in INLINE:
                at[""].pop()
            if wanted:
                ends[i] = end

    def last(name: str) -> int:
        places = at.get(name)
        return places[-1] if places else -1

    for i, (name, slash, _, opens, wanted) in enumerate(parts):
        if not name:
            continue
        if slash:
            place = last(name)
            if place < 0:
                continue
            if name in INLINE:
                if last("") > place:
                    continue
            elif name not in CELLS and name not in _ROWS and max(map(last, CELLS)) > place:
                continue
            close(place + 1, i)
            close(place, i + 1)
            continue
        if name in ENDS:
            places = [last(n) for n, keep in ENDS[name] if last(n) >= 0 and all(last(k) < last(n) for k in keep if k != n)]
            if places:
                close(min(places), i)
        if opens:
            at.setdefault(name, []).append(len(opened))
            if name not in INLINE:
                at.setdefault("", []).append(len(opened))
            opened.append((name, i, wanted))
    close(0, len(parts))
    return ends


def _left_out(parts: list) -> dict[int, int]:
    """The elements to leave out, as :func:`_extents` gives them."""
    ends = _extents(parts)
    content = [i for i, p in enumerate(parts) if p[0] in CONTENT and not p[1]]
    if content:
        return {i: end for i, end in ends.items() if bisect_left(content, i) == bisect_left(content, end)}
    words = [0]
    head = 0  # what stands in the head is no word of the page
    for i, (name, _, text, _, _) in enumerate(parts):
        if name == "head" and i in ends:
            head = ends[i]
        words.append(words[-1] + (0 if name or i < head else len(text.split())))
    return {i: end for i, end in ends.items() if parts[i][0] == "head" or 2 * (words[end] - words[i]) <= words[-1]}


def events(page: str):
    """``(tag, text, inside)`` of a page: a tag name (``/`` before an end tag) or a text, and whether it is labelled."""
    parts = []  # name, slash of an end tag, text, whether it opens an element, whether that may be left out
    for m in _TOKEN.finditer(page or ""):
        if m["text"] is not None:
            parts.append(("", "", m["text"], False, False))
        elif m["name"]:
            name, attrs = m["name"].lower(), m["attrs"]
            opens = not m["end"] and name not in VOID and not attrs.rstrip().endswith("/")
            parts.append((name, m["end"], "", opens, opens and (name in LEFT_OUT or _is_marked(name, attrs))))
    out = _left_out(parts)
    i, inside = 0, 0  # open content elements
    while i < len(parts):
        name, slash, text, _, _ = parts[i]
        if i in out:
            if name not in INLINE:
                yield "", " ", inside > 0  # what stands around it stays apart
            i = out[i]
            continue
        i += 1
        if not name:
            yield "", entities.unescape(text), inside > 0
        elif name in CONTENT:
            inside = max(0, inside + (-1 if slash else 1))
            yield slash + name, "", False
        else:
            yield slash + name, "", inside > 0


def known(tag: str) -> str:
    name = tag.lstrip("/")
    return name if name in BLOCKS or name in INLINE else OTHER


def tag_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``name, inside, outside`` summed over the labelled pages; words count under one name."""

    def counted(batches):
        table: dict[str, list[int]] = {}
        for pdf in batches:
            for page in pdf["html"]:
                seen = list(events(page))
                if not any(e[0] in CONTENT for e in seen):
                    continue
                for tag, text, inside in seen:
                    n = 1 if tag else len(text.split())
                    table.setdefault(known(tag) if tag else WORD, [0, 0])[0 if inside else 1] += n
        yield pd.DataFrame(
            [(k, *v) for k, v in table.items()], columns=["name", "inside", "outside"]
        ).astype({"inside": "int64", "outside": "int64"})

    return (
        pages.select(F.col(html_col).cast("string").alias("html"))
        .mapInPandas(counted, "name string, inside long, outside long")
        .groupBy("name").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    )


def weights(counts: list) -> dict[str, float]:
    """Word score 1; a tag costs 0.1 if it is only seen in content, up to 3 the more of it is outside."""
    score = {WORD: 1.0}
    for name, inside, outside in counts:
        if name != WORD:
            score[name] = -(0.1 + 2.9 * outside / max(1, inside + outside))
    score.setdefault(OTHER, -1.0)
    return score


def best_region(scores: list[float]) -> tuple[int, int]:
    """``(first, end)`` of the contiguous run with the highest sum; empty if none is above zero."""
    best, found, total, first = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, first = 0.0, i
        total += s
        if total > best:
            best, found = total, (first, i + 1)
    return found


def element_spans(seen: list, names: tuple[str, ...]) -> list[tuple[int, int]]:
    """``(first, end)`` of the elements of those names, inner ones first; unclosed ones end with the page."""
    spans, opened = [], []
    for i, (tag, _, _) in enumerate(seen):
        if tag in names:
            opened.append((tag, i))
        elif tag[:1] == "/" and any(tag[1:] == name for name, _ in opened):
            while True:
                name, start = opened.pop()
                spans.append((start, i + 1))
                if name == tag[1:]:
                    break
    return spans + [(start, len(seen)) for _, start in reversed(opened)]


def whole_content(seen: list, first: int, end: int) -> tuple[int, int]:
    """The region, extended to whole content elements: lists and tables at its edges belong to it.

    These are each ``article`` or ``main`` that the region reaches into; if there
    is none, the innermost ``div`` or ``section`` around it.
    """
    if first == end:
        return first, end
    reached = [(a, b) for a, b in element_spans(seen, CONTENT) if a < end and first < b]
    if reached:
        return min(first, *(a for a, _ in reached)), max(end, *(b for _, b in reached))
    around = [(a, b) for a, b in element_spans(seen, ("div", "section")) if a <= first and end <= b]
    return min(around, key=lambda s: s[1] - s[0], default=(first, end))


def words_of(seen: list, first: int, end: int) -> int:
    return sum(len(text.split()) for _, text, _ in seen[first:end])


def main_text(page: str, score: dict[str, float]) -> str:
    seen = list(events(page))
    other = score.get(OTHER, -1.0)
    points = [score.get(known(t), other) if t else score[WORD] * len(x.split()) for t, x, _ in seen]
    first, end = whole_content(seen, *best_region(points))
    if any(p > 0 and e[2] for p, e in zip(points, seen)):
        # The page says where its content is, unless far more is elsewhere (its articles are comments, say).
        inside = whole_content(seen, *best_region([p if e[2] else -abs(p) for p, e in zip(points, seen)]))
        if words_of(seen, first, end) <= 2 * words_of(seen, *inside):
            first, end = inside
    parts = [x if not t else ("" if t.lstrip("/") in INLINE else " ") for t, x, _ in seen[first:end]]
    return " ".join("".join(parts).split())


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text`` of every row."""
    score = weights([tuple(r) for r in tag_counts(pages, html_col).collect()])  # known tags: a bounded table

    def extracted(batches):
        for pdf in batches:
            yield pd.DataFrame({
                "page_id": pdf["page_id"],
                "url": pdf["url"],
                "text": [main_text(p, score) for p in pdf["html"]],
            })

    return long_ids(pages.select(
        F.col(id_col).cast("long").cast("string").alias("page_id"),  # text: exact in pandas
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    ).mapInPandas(extracted, "page_id string, url string, text string"), "page_id")
