"""HTML extraction by line-block distribution.

Markup is stripped into block lines.  Every line has a text length; lines in
menus, headers, footers, sidebars, notices, adverts, forms, comments weigh
nothing (by tag, or by a class, id or role that is such a word or a compound
of which it is the head: ``cookie-notice`` is, ``search-algorithms`` is not;
a block of long prose overrules the less certain words), nor do lines outside
the article on pages where article elements hold at least half of the text
that is not furniture, and lines of links on all other pages.  Lengths are
summed over sliding windows of lines; a surge point is where the window sum
rises to the threshold, a dive point where it is back at zero, and the lines
with weight between the two are the text, as are shorter ones in the same
element as these (not in the page's body itself).  In the header of an article
its headings are text and so is its lead, a block of ``LEAD`` characters that
ends like a sentence; bylines and dates are not.  Formulas in MathML are text.

Defined results: NULL or empty html gives an empty text; cut-off markup ends
at the cut; repeated rows are extracted each; no row is dropped.
"""

from __future__ import annotations

import html
import re
from collections import Counter

from pyspark.sql import DataFrame

from .common import map_slices, with_fields

#: fixed values: elements of the HTML standard by role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MATH = frozenset(
    "math maction merror mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd "
    "mtext mtr munder munderover semantics".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()) | MATH
RAW = ("script style noscript template iframe noembed noframes xmp textarea title svg annotation annotation-xml select object "
       "canvas audio video")
DROPPED = frozenset("nav footer aside form button dialog fieldset menu head header".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: fixed values: words in class, id or role that mark page furniture
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promos promotion banner "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login "
    "sidebar sidebars widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager header "
    "masthead footer comment comments disqus respond reply replies share sharing social related recommended toolbar "
    "alert search complementary contentinfo form".split())
COMMENTS = frozenset("comment comments disqus respond reply replies".split())
#: fixed values: furniture words that are as well the subject of a text; a block of ``PROSE`` characters overrules them
SOFT = frozenset(
    "alert banner form header login modal notice notices overlay popup promotion reply replies respond search share "
    "sharing signup social subscription toolbar widget widgets".split())
PROSE = 300
#: fixed values: last parts of a compound that do not say what it holds; first parts that name a topic or a state
LAYOUT = frozenset(
    "area bar block body bottom box button buttons col column container content group holder icon icons inner item items "
    "left link links list outer panel right row section slot thread title top unit wrap wrapper".split())
TOPIC = frozenset("category cat tag tags topic term type status has with without no is".split())
#: fixed values: elements whose id is the slug of a heading
SLUGGED = HEADINGS | {"p", "section", "li", "dt", "dd", "blockquote", "figure", "pre", "table", "tr", "td"}

#: attributes up to the end of a tag: quotes hold a value only right after an equals sign
_ATTRS = r"""(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW.split()) + r")(?=[\s/>])" + _ATTRS + r">.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>" + _ATTRS + r")(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.I | re.S)
_ATTR = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_ASKED = frozenset("class id role style hidden aria-hidden".split())
_WORDS = re.compile(r"[A-Za-z][a-z]*")
#: what an open element of the key is closed by, besides its end tag
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
              "th": {"td", "th", "tr"}, "option": {"option"}}


#: elements of running text; a line's home is the element around them
_TEXT = HEADINGS | set("p li ul ol dl dt dd blockquote pre figure figcaption table thead tbody tfoot tr td th center".split())
#: a block of an article's header is its lead, not a byline or date, if it is so long and ends like a sentence
LEAD = 40
_SENTENCE_END = re.compile(r"[.!?\u2026\u3002\uff01\uff1f][\"'\u2019\u201d\u00bb)\]]*\Z")


class _Element:
    """An open element: whether it is furniture (``flag``; ``soft``: unless it holds prose; ``by_name``: for its class,
    id or role), and what encloses it: ``mark``, the innermost flagged or article element, and ``home``."""
    __slots__ = ("tag", "flag", "by_name", "article", "soft", "wraps", "up", "mark", "home")

    def __init__(self, tag, flag, by_name, article, soft=False):
        self.wraps = False                              # flagged by name around an article
        self.tag, self.flag, self.by_name, self.article, self.soft = tag, flag, by_name, article, soft

    def enter(self, outer: _Element | None) -> None:
        self.up = outer.mark if outer else None
        self.mark = self if self.flag or self.article else self.up
        plain = self.tag in INLINE or self.tag in _TEXT
        self.home = (outer.home if outer else None) if plain else None if self.tag in ("html", "body") else self


class _Stack(list):
    """Open elements with counts of what is open, so that no tag looks through all of them."""

    def __init__(self):
        super().__init__()
        self.names, self.anchors, self.articles, self.hard = Counter(), 0, 0, 0
        self.soft, self.named, self.marked = [], [], []

    def push(self, e: _Element) -> None:
        e.enter(self[-1] if self else None)
        if e.article:
            for outer in self.named:                    # each is found to be a wrapper once
                outer.wraps = True
            self.named.clear()
        self._count(e, 1)
        if e.mark is e:
            self.marked.append(e)
        if e.flag and e.soft:
            self.soft.append(e)
        if e.flag and e.by_name:
            self.named.append(e)
        self.append(e)

    def close(self, i: int) -> None:
        while len(self) > i:
            e = self.pop()
            self._count(e, -1)
            for some in (self.soft, self.named):
                if some and some[-1] is e:
                    some.pop()

    def _count(self, e: _Element, n: int) -> None:
        self.names[e.tag] += n
        self.anchors += n * (e.tag == "a")
        self.articles += n * e.article
        self.hard += n * (bool(e.flag) and not e.soft)

    def prose(self) -> None:
        """A block of prose: what is furniture by softer words alone is none."""
        if not self.hard:
            for e in self.soft:
                e.flag = False
            self.soft.clear()


def _heads(value: str, whole: bool = False) -> set[str]:
    """The word that each token of a class, id or role is about; with ``whole`` only of tokens of one word."""
    heads = set()
    for token in value.split():
        parts = [w.lower() for w in _WORDS.findall(token)]
        if len(parts) > 1 and (whole or parts[0] in TOPIC):
            continue
        while len(parts) > 1 and parts[-1] in LAYOUT:
            parts.pop()
        heads.update(parts[-1:])
    return heads


def _open(tag: str, attrs: str, inside: bool) -> _Element:
    words, hidden = set(), False
    if attrs:
        for name, *values in _ATTR.findall(attrs):
            value, name = "".join(values), name.lower()
            if name not in _ASKED:
                continue
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                hidden = True
            elif name == "style":
                hidden |= "display:none" in value.lower().replace(" ", "")
            elif name == "id":
                if tag in HEADINGS or tag == "p" or inside and tag in SLUGGED:
                    continue
                words |= _heads(value, whole=inside or tag in SLUGGED or tag == "article")
            elif name != "aria-hidden":
                words |= _heads(value)
    if tag in ("html", "body", "main", "article"):
        comment = tag == "article" and bool(words & COMMENTS)
        return _Element(tag, comment or hidden, False, tag in ("main", "article") and not comment)
    named = bool(words & FURNITURE)
    soft = named and not hidden and tag not in DROPPED and not (words & FURNITURE) - SOFT
    if tag == "header" or tag not in DROPPED and words & FURNITURE == {"header"}:
        return _Element(tag, "header" if inside and not hidden else True, tag != "header", False, soft)
    return _Element(tag, tag in DROPPED or named or hidden, tag not in DROPPED and not hidden, False, soft)


def block_lines(page: str) -> list[tuple]:
    """``(text, furniture, in_article, mostly links, home)`` of every non-empty block, in page order."""
    lines, parts, stack, heading, linked = [], [], _Stack(), False, 0

    def flush():
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join(html.unescape(raw).split())
            links, linked = linked > len(raw.strip()) / 2, 0
            parts.clear()
            if text:
                if len(text) >= PROSE and not links:
                    stack.prose()
                inner = stack[-1] if stack else None
                lines.append((text, inner and inner.mark, heading, links, inner and inner.home))

    pos = 0
    for m in _TOKEN.finditer(page):
        if m.start() > pos:
            parts.append(page[pos:m.start()])
            if stack.anchors:
                linked += len(parts[-1].strip())
        pos = m.end()
        tag = m["tag"]
        if tag is None:
            if m["raw"]:
                parts.append(" ")
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
        elif tag in VOID:
            if tag == "hr":
                flush()
        elif m["end"]:
            inline = tag in INLINE
            if not inline:
                flush()
                if tag in HEADINGS:
                    heading = False
            if not stack.names[tag]:
                continue
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    if inline and any(e.flag for e in stack[i:]):
                        flush()
                    stack.close(i)
                    break
                if inline and stack[i].tag not in INLINE:
                    break
        else:
            e = _open(tag, m["attrs"], stack.articles > 0)
            if tag in INLINE:
                if e.flag:
                    flush()
                stack.push(e)
                continue
            flush()
            heading = tag in HEADINGS
            for i in range(len(stack) - 1, -1, -1):     # a block ends an open paragraph; items end items
                open_tag = stack[i].tag
                if open_tag == "p" or open_tag in HEADINGS and tag in HEADINGS or tag in _CLOSED_BY.get(open_tag, ()):
                    stack.close(i)
                    break
                if open_tag not in INLINE:
                    break
            stack.push(e)
    if pos < len(page):
        parts.append(re.sub(r"<[a-zA-Z/!?][^>]*\Z", "", page[pos:]))
    flush()
    _unflag_wrappers(stack.marked, lines)
    state = {None: (False, False, False)}               # furniture, in an article's header, in an article
    for e in stack.marked:                              # outer ones come first
        flag, head, article = state[e.up]
        state[e] = flag or e.flag is True, head or e.flag == "header", article or e.article
    out = []
    for text, mark, is_heading, links, home in lines:
        flag, head, article = state[mark]
        lead = is_heading or len(text) >= LEAD and not links and bool(_SENTENCE_END.search(text))
        out.append((text, flag or head and not lead, article, links, home))
    return out


def _unflag_wrappers(marked: list[_Element], lines: list) -> None:
    """The wrappers of an article are no furniture if it is the longest of all wrapped ones and longer than all unflagged
    text."""
    if not any(e.wraps for e in marked):
        return
    barred, flagged = {None: False}, {None: False}
    for e in marked:
        barred[e] = barred[e.up] or bool(e.flag) and not e.wraps
        flagged[e] = flagged[e.up] or bool(e.flag)
    size, free = Counter(), 0
    for text, mark, _, links, _ in lines:
        if not links:
            size[mark] += 0 if barred[mark] else len(text)
            free += 0 if flagged[mark] else len(text)
    for e in reversed(marked):                          # inner ones come last
        if e.up is not None:
            size[e.up] += size[e]
    wrapped = [e for e in marked if e.article and flagged[e] and not barred[e]]
    longest = max(wrapped, key=size.__getitem__, default=None)
    if longest is not None and size[longest] > free:
        while longest is not None:
            if longest.wraps:
                longest.flag = False
            longest = longest.up


def main_text(page: str | None, window: int = 3, threshold: int = 86) -> str:
    """Main text of one page by surge and dive points of the line-block sums."""
    lines = block_lines(page) if page else []
    if not lines:
        return ""
    inside = sum(len(t) for t, f, a, links, _ in lines if a and not f and not links)
    outside = sum(len(t) for t, f, a, links, _ in lines if not a and not f and not links)
    semantic = inside >= outside and any(a and not f for _, f, a, *_ in lines)
    weight = [0 if f or (not a if semantic else links) else len(t) for t, f, a, links, _ in lines]
    n = len(lines)
    sums = [sum(weight[i:i + window]) for i in range(n)]
    top = max(sums)
    if not top:
        return ""
    surge = 1 if semantic else min(threshold, top)
    regions, i = [], 0
    while i < n:
        if sums[i] >= surge and sums[i] > 0:
            start = i
            # back to where the surge began: over the same gaps that a dive bridges
            while near := [j for j in range(max(0, start - window), start) if weight[j]]:
                start = near[0]
            while i < n and sums[i] > 0:
                i += 1
            regions.append((start, i))                  # dive: nothing within the window
        else:
            i += 1
    kept = {i for a, b in regions for i in range(a, b) if weight[i]}
    homes = {lines[i][4] for i in kept} - {None}
    return "\n".join(x[0] for i, x in enumerate(lines) if i in kept or weight[i] and x[4] in homes)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      window: int = 3, threshold: int = 86) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page; other columns are not read.

    ``window`` lines are summed; on pages that no article element frames a surge
    needs ``threshold`` characters (or the page's largest sum, if smaller).
    """
    cols = pages.select(id_col, url_col, html_col)
    schema = with_fields(cols.schema.fields[:2], "text string, n_chars long")

    def make():
        def f(ids, urls, pages_):
            texts = [main_text(p, window, threshold) for p in pages_]
            return ids, urls, texts, [len(t) for t in texts]
        return f

    return map_slices(cols, make, schema, rows=64)
