"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Pass one labels each block on its own: blocks inside
menus, headers, footers, sidebars, notices, adverts, forms and reader comments (by tag, role or class)
are bad, but long prose only by tag, role or a class of adverts, cookies or comments, and class words do not
overrule an article tag or an article class, nor those of a wrapper the page's first article in it; blocks made of links are bad; inside an article container long blocks are good; elsewhere
length and stop-word density decide; short blocks stay ambiguous. Pass two gives every ambiguous block
the label of its nearest decided neighbours (of its own container where it is in an article): both
alike, else the nearer one; headings follow the block below them. Good blocks are joined in page order.

Character references are decoded, white space inside a block becomes one space, nothing is cut.

Defined results: null or empty html, or a page without good blocks: empty text. Unclosed containers, scripts,
styles and comments run to the end of the page; a self-closed svg or math ends at once, and of other dropped
elements (svg, video, noscript and the like) without an end tag only the start tag goes. Null ids and repeated rows are kept row by row, other columns
are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

# --- fixed values: tags
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav "
    "ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
CONTAINERS = frozenset(
    "article aside blockquote button details dialog div dl fieldset figure footer form header li main menu nav ol "
    "section select span table tbody td tfoot th thead tr ul head title p h1 h2 h3 h4 h5 h6".split())
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6".split())
RAW = "script|style"
FLAT = frozenset(("iframe", "textarea"))  # hold no tags: end at the first end tag
HELD = "noscript|template|svg|iframe|object|canvas|textarea|math|audio|video"  # dropped up to their own end tag, if any
DRAWN = frozenset(("svg", "math"))  # end at once when self-closed
BAD_TAGS = frozenset("nav footer aside form menu dialog button select head title".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
ARTICLE_TAGS = frozenset(("article", "main"))
# words of a class or id that mark boilerplate anywhere, only outside an article, or an article
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar nav navbar "
    "navigation menu breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices popup modal newsletter "
    "subscribe subscription share sharing social related recommended comment comments disqus replies pagination pager "
    "toolbar login signup search skip copyright disclaimer".split())
BAD_OUTSIDE = frozenset("header masthead topbar widget alert".split())
# of them, those under which prose is not the page's own either
FIRM_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr comment comments "
    "disqus replies".split())
# parts beside a word that make it tell of the page's state
STATE_BEFORE = frozenset("has no with without".split())
STATE_AFTER = frozenset("open closed enabled disabled free off on hidden".split())
SOFT, FIRM = 1, 2  # boilerplate by a class word only; by its tag, role or a firm word
ARTICLE_WORDS = frozenset("article content post entry story main".split())

# --- fixed values: frequent words of the four languages
STOP_WORDS = frozenset(
    "the of and to in is that it was for on are with as be at by this from have or an not but which you we they "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya "
    "le les des et un une du est pour dans qui sur pas au par plus avec ce il sont ne se ou en la".split())
LONG = 200  # code points from which dense text is good on its own
SHORT = 70  # code points below which a block is ambiguous
STOP_HIGH, STOP_LOW = 0.32, 0.15
LINKS = 0.5  # share of a block's text inside links from which it is bad

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    rf"|<(?P<raw>{RAW})(?![A-Za-z0-9:-])[^>]*+>(?:.*?</(?P=raw)\s*+>|.*\Z)"
    rf"|<(?P<shut>/?)(?P<held>{HELD})(?![A-Za-z0-9:-])(?P<own>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*+)(?P<attr>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[A-Za-z!?][^>]*+(?:>|\Z)", re.S | re.I)
NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HREF = re.compile(r"(?:^|[\s\"'])href\s*=", re.I)  # an anchor without it is no link
PARTS = re.compile(r"[a-z0-9]+")
WORD = re.compile(r"[^\W\d_]+")


def _bad_words(words: list[str], in_article: bool) -> set[str]:
    """The boilerplate words among the parts of one class or id; words that tell of a state (``no-sidebar``) do not count."""
    return {w for i, w in enumerate(words) if (w in BAD_WORDS or (not in_article and w in BAD_OUTSIDE))
            and not STATE_BEFORE.intersection(words[:i]) and not STATE_AFTER.intersection(words[i + 1:])}


def _marks(tag: str, attr: str, in_article: bool) -> tuple[int, bool]:
    """(boilerplate level, article) of a container by its tag and attributes."""
    level = FIRM if tag in BAD_TAGS or (tag == "header" and not in_article) else 0
    article = tag in ARTICLE_TAGS
    marked = 0
    for name, *values in NAMES.findall(attr) if attr else ():
        value = "".join(values).lower()
        if name.lower() == "role":
            words = PARTS.findall(value)
            level = FIRM if BAD_ROLES.intersection(words) else level
            article = article or "main" in words
            continue
        for one in value.split():
            words = PARTS.findall(one)
            if bad := _bad_words(words, in_article):
                marked = max(marked, FIRM if bad & FIRM_WORDS else SOFT)
            else:
                article = article or bool(ARTICLE_WORDS.intersection(words))
    if not article or (in_article and marked == FIRM):  # inside an article, comments are often articles of their own
        level = max(level, marked)
    return level, article and not level


def _stop_share(text: str) -> float:
    words = WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


class _Block:
    __slots__ = ("text", "chars", "links", "bad", "scope", "heading")

    def __init__(self, parts, links, bad, scope, heading):
        self.text = " ".join(htmllib.unescape("".join(parts)).split())
        self.chars, self.links, self.heading = len(self.text), links, heading
        self.bad = bad == FIRM or (bad == SOFT and not self.is_prose())
        self.scope = 0 if self.bad else scope  # boilerplate says nothing of its article

    def is_prose(self) -> bool:
        """Long, with many stop words and few links."""
        return self.chars >= LONG and self.links <= LINKS * self.chars and _stop_share(self.text) >= STOP_HIGH


def _held_ends(html: str) -> dict[int, int]:
    """Where the dropped elements end that have an end tag, by the position of their start tag."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for m in TOKEN.finditer(html):
        if not m["held"]:
            continue
        tag = m["held"].lower()
        at = opened.setdefault(tag, [])
        if not m["shut"]:
            if not (tag in DRAWN and m["own"].endswith("/>")):
                at.append(m.start())
        elif at:
            if tag in FLAT:
                del at[1:]
            ends[at.pop()] = m.end()
    return ends


def page_blocks(html: str) -> list[_Block]:
    """The non-empty blocks of a page with what pass one needs to know of each."""
    blocks: list[_Block] = []
    stack: list[tuple[str, int, int]] = [("", 0, 0)]  # (tag, boilerplate level, article scope or 0)
    parts: list[str] = []
    links = scopes = depth = 0
    heading = False

    def close() -> None:
        nonlocal parts, links
        if parts:
            _, bad, scope = stack[-1]
            block = _Block(parts, links, bad, scope, heading)
            if block.chars:
                blocks.append(block)
        parts, links = [], 0

    def text(x: str) -> None:
        nonlocal links
        if x:
            parts.append(x)
            if depth:
                links += len("".join(htmllib.unescape(x).split()))

    at, ends = 0, None
    tokens = TOKEN.finditer(html)
    while m := next(tokens, None):
        text(html[at:m.start()])
        at = m.end()
        if m["held"] and not m["shut"]:
            ends = _held_ends(html) if ends is None else ends
            if m.start() in ends:
                at = ends[m.start()]
                tokens = TOKEN.finditer(html, at)
            continue
        if not (tag := m["tag"]):
            continue
        tag = tag.lower()
        if tag == "a":
            depth = int(not m["end"] and HREF.search(m["attr"]) is not None)
            continue
        if tag in BLOCK_TAGS:
            close()
            depth = 0
            heading = not m["end"] and len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
        if tag not in CONTAINERS or m["attr"].endswith("/"):
            continue
        if m["end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    if tag == "span" and stack[i][1] != stack[i - 1][1]:
                        close()
                    del stack[i:]
                    break
            continue
        if tag in BLOCK_TAGS and stack[-1][0] in CLOSED_BY_BLOCK:
            stack.pop()
        _, bad, scope = stack[-1]
        own_bad, article = _marks(tag, m["attr"], scope > 0)
        if bad == SOFT and (tag == "main" or (article and not scopes)):
            bad = 0  # a wrapper whose class tells of the layout around the page's first article
        if article and not scope and not bad:
            scopes += 1
            scope = scopes
        if tag == "span" and own_bad > bad:
            close()
        stack.append((tag, max(bad, own_bad), scope))
    text(html[at:])
    close()
    return blocks


def _first_label(b: _Block) -> bool | None:
    """Good, bad or undecided."""
    if b.bad:
        return False
    density = b.links / b.chars
    if b.scope:
        return None if b.chars < SHORT or density > LINKS else True
    if density > LINKS:
        return False
    if b.chars < SHORT:
        return False if b.links else None
    stop = _stop_share(b.text)
    if stop >= STOP_HIGH:
        return True if b.chars >= LONG else None
    return None if stop >= STOP_LOW else False


def _settle(labels: list, scopes: list[int], headings: list[bool]) -> list[bool]:
    """Pass two: undecided blocks inherit from the nearest decided ones (in an article: of that article, good if none)."""
    n = len(labels)
    before, after = [(None, n)] * n, [(None, n)] * n
    last: dict[int, int] = {}
    for i in range(n):
        k = last.get(scopes[i])
        before[i] = (labels[k], i - k) if k is not None else (None, n)
        if labels[i] is not None:
            last[scopes[i]] = i
    last = {}
    for i in range(n - 1, -1, -1):
        k = last.get(scopes[i])
        after[i] = (labels[k], k - i) if k is not None else (None, n)
        if labels[i] is not None:
            last[scopes[i]] = i
    out = []
    for i, own in enumerate(labels):
        if own is None:
            (a, da), (b, db) = before[i], after[i]
            default = scopes[i] > 0  # the page's edges count as bad, an article's as good
            a, b = default if a is None else a, default if b is None else b
            own = a if a == b else b if headings[i] else a if da < db else b if db < da else False
        out.append(own)
    return out


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    blocks = page_blocks(html)
    good = _settle([_first_label(b) for b in blocks], [b.scope for b in blocks], [b.heading for b in blocks])
    return " ".join(b.text for b, g in zip(blocks, good, strict=True) if g)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points)."""
    p = pages.select("page_id", "url", "html")
    kinds = {f.name: f.dataType.simpleString() for f in p.schema}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            text = [main_text(x if isinstance(x, str) else None) for x in b["html"]]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": pd.Series(text, dtype=object),
                                "n_chars": pd.Series([len(x) for x in text], dtype="int64")})

    return p.mapInPandas(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
