"""Main text of web pages by block rules in two passes.

A page is cut into blocks at block-level tags. Pass one decides a block by its stop-word density, its length and its link
density, wherever it stands. Where it stands is one more sign: in an article element less is asked of a block, in a teaser
more, and in elements or under names that mark something else (menus, footers, adverts, comments) it is not text. A name
that wrappers have as well (a layout with a sidebar) does not count for an element that holds an article, or that holds
nearly all of the page's text. Short blocks and those without stop words stay open, and pass two gives them the label of the
nearest decided blocks of their region.

Stop words are those of a list and the page's own most frequent words, so that pages in other languages have some as well.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from factloom.llm.runtime import ensure_importable, free
from factloom.llm.stats import STOPWORDS

#: Elements whose content is never text of the page. The first run to the end of a page that does not close them, as in browsers;
#: the others count as plain tags then.
RAW = "script style title textarea".split()
HIDDEN = set("noscript template iframe object svg math select button canvas audio video".split())
#: Elements that end a block where they start and where they end.
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements, roles, and parts of class and id names that mark what is not the article.
AWAY_ELEMENTS = set("nav footer aside menu dialog".split())
AWAY_ROLES = set("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
AWAY_NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent notice notices alert "
    "breadcrumb breadcrumbs comment comments commentlist disqus respond reply replies related recommended popup modal newsletter subscribe "
    "subscription signup login pagination pager skip disclaimer copyright".split()
)
#: Names that elements around the whole text may have as well.
WRAPPER_NAMES = set("banner nav navbar navigation menu menus sidebar aside footer masthead topbar header share sharing social widget widgets toolbar".split())
#: First parts of names that say what an element is about, not what it is; and of those that name an article's own header.
_ABOUT = set("has with without no is not layout js".split())
_OWN = set("entry post article content story".split())
LONG_WORDS, SOME_WORDS, RICH, POOR, LINKED = 25, 8, 0.2, 0.05, 0.5
#: An article with less than this share of the words of the text outside of articles is a teaser.
TEASER = 0.2
#: A wrapper has so many words that pass, and this share of all that do.
WRAPPED, WRAPPED_SHARE = 100, 0.75
#: How many of a page's words count as its own stop words, if they occur so often.
OWN_STOP, OWN_TIMES = 12, 4

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?![^\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+\Z",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
#: Words; a character of a script without spaces is a word.
_WORD = re.compile(r"[぀-ヿ㐀-鿿가-힯฀-๿]|[^\W぀-ヿ㐀-鿿가-힯฀-๿]+")
_STOP = frozenset(STOPWORDS)


@dataclass
class Block:
    text: str
    region: int  # 0: outside of any article
    away: bool
    wrapper: int = 0  # the outermost element that only its name marks as something else, if any
    links: int = 0
    item: bool = False  # of a list
    label: bool | None = field(default=None)


def _mark(tag: str, attrs: str, inside: bool) -> str:
    """``away``, ``wrapper`` or nothing, from an element's tag, role and names."""
    if tag in AWAY_ELEMENTS or tag == "header" and not inside:
        return "away"
    out = "wrapper" if tag == "form" else ""
    for m in _NAMES.finditer(attrs):
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            if value.strip() in AWAY_ROLES:
                return "away"
        elif tag not in ("html", "body", "article", "main"):
            for name in value.split():
                parts = re.split(r"[_-]+", name)
                if parts[0] in _ABOUT or parts[0] in _OWN and parts[-1] == "header":
                    continue
                if not AWAY_NAMES.isdisjoint(parts):
                    return "away"
                if not WRAPPER_NAMES.isdisjoint(parts):
                    out = "wrapper"
    return out


def blocks_of(page: str) -> tuple[list[Block], set[int]]:
    """Blocks of a page, and the wrappers that hold an article."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int, int]] = []  # open block elements: tag, away, region, wrapper
    parts: list[str] = []
    away, region, wrapper, regions, wrappers = False, 0, 0, 0, 0
    link_from, linked, size, head = -1, 0, 0, False
    around: set[int] = set()
    closing: dict[str, tuple[int, int]] = {}  # of hidden elements: where the next closing tag starts and ends

    def flush() -> None:
        nonlocal linked, size, link_from
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text and not head:
            out.append(Block(text, region, away, wrapper, linked + (size - link_from if link_from >= 0 else 0), bool(stack) and stack[-1][0] == "li"))
        parts.clear()
        linked, size, link_from = 0, 0, 0 if link_from >= 0 else -1

    def end_of(tag: str, at: int) -> int:
        """Where the first closing tag from ``at`` on ends; -1 without one. All calls of a page look at it once for each tag."""
        if closing.get(tag, (-1, 0))[0] < at:
            m = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
            closing[tag] = m.span() if m else (len(page) + 1, -1)
        return closing[tag][1]

    at = 0
    while (m := _TOKEN.search(page, at)) is not None:
        if m.start() > at:
            piece = page[at : m.start()]
            parts.append(piece)
            size += len(piece)
        at = m.end()
        tag, close = (m["tag"] or m["tag2"] or "").lower(), bool(m["close"] or m["close2"])
        if not tag:
            continue
        if tag in HIDDEN:
            if not close and (end := end_of(tag, at)) > 0:
                at = end
            continue
        if tag == "a":
            if close:
                if link_from >= 0:
                    linked += size - link_from
                link_from = -1
            elif link_from < 0:
                link_from = size
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag == "head":
            flush()
            head = not close
            continue
        if tag not in BLOCK:
            continue
        flush()
        if tag == "body":
            head = False
        if close:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        elif tag not in VOID:
            while stack and (stack[-1][0] == "p" or stack[-1][0] == tag == "li"):
                stack.pop()
            away, region, wrapper = stack[-1][1:] if stack else (False, 0, 0)
            mark = _mark(tag, m["attrs"] or m["attrs2"] or "", region > 0)
            if tag in ("article", "main") and not region:
                regions += 1
                region = regions
                if wrapper and not away:
                    around.add(wrapper)
            if mark == "wrapper" and not wrapper:
                wrappers += 1
                wrapper = wrappers
            stack.append((tag, away or mark == "away", region, wrapper))
        away, region, wrapper = stack[-1][1:] if stack else (False, 0, 0)
    parts.append(page[at:])
    size += len(page) - at
    flush()
    return out, around


def decide(blocks: list[Block], around: set[int]) -> None:
    words = [_WORD.findall(b.text.lower()) for b in blocks]
    linked = [b.links > LINKED * len(b.text) for b in blocks]
    often = Counter(w for ws, far, b in zip(words, linked, blocks) if not far and not b.away for w in ws)
    stop = _STOP | {w for w, n in often.most_common(OWN_STOP) if n >= OWN_TIMES}
    dense: list[int] = []  # whether a block passes by length and stop words: 3 if it is long, 2 if shorter and rich, 1 if it only may, else 0
    for ws in words:
        n = max(len(ws), 1)
        density = sum(w in stop for w in ws) / n
        dense.append(3 if n >= LONG_WORDS and density >= POOR else 2 if n >= SOME_WORDS and density >= RICH else int(n >= SOME_WORDS and density >= POOR))
    # Wrappers: those that hold an article or nearly all text are none of the page's other parts.
    text = {k: len(ws) for k, (ws, b) in enumerate(zip(words, blocks)) if dense[k] > 1 and not b.away and not linked[k]}
    inside: dict[int, int] = {}
    for k, n in text.items():
        inside[blocks[k].wrapper] = inside.get(blocks[k].wrapper, 0) + n
    whole = sum(text.values())
    plain = {w for w in around if 2 * inside.get(w, 0) >= whole}
    plain |= {w for w, n in inside.items() if not any(b.region for b in blocks) and n >= WRAPPED and n >= WRAPPED_SHARE * whole}
    for b in blocks:
        b.away |= b.wrapper > 0 and b.wrapper not in plain
    own: dict[int, int] = {}  # words of the regions, and those of their blocks that pass
    passed: dict[int, int] = {}
    for k, b in enumerate(blocks):
        if not b.away and not linked[k]:
            own[b.region] = own.get(b.region, 0) + max(len(words[k]), 1)
            passed[b.region] = passed.get(b.region, 0) + max(len(words[k]), 1) * (dense[k] > 1)
    outside = passed.get(0, 0)
    articles = {r for r, n in own.items() if r and (not outside or passed[r] and n >= TEASER * outside)}
    for k, b in enumerate(blocks):
        if b.away:
            b.label = False
        elif linked[k]:
            b.label = False if b.item or b.region not in articles else None
        elif dense[k] > (0 if b.region in articles else 2 if b.region else 1):
            b.label = True
    # For each block the nearest decided one of its region on either side: (distance, label).
    near: list[list[tuple[int, bool]]] = [[] for _ in blocks]
    for order in (range(len(blocks)), range(len(blocks) - 1, -1, -1)):
        last: dict[int, int] = {}
        for k in order:
            if blocks[k].away:
                continue  # it is part of something else that stands here
            if blocks[k].label is not None:
                last[blocks[k].region] = k
            elif (j := last.get(blocks[k].region)) is not None:
                near[k].append((abs(k - j), not blocks[j].label))
    for b, sides in zip(blocks, near):
        if b.label is None:
            if b.region in articles:  # it goes only if it stands between blocks that go
                b.label = len(sides) < 2 or not all(no for _, no in sides)
            else:  # of two neighbours at the same distance one that is text suffices
                b.label = not min(sides)[1] if sides else b.region > 0 and not outside


def main_text(page: str | None) -> str:
    """The blocks of the main text joined by an empty line; a null or empty page, and one without text, gives an empty text."""
    if not page:
        return ""
    blocks, around = blocks_of(page)
    decide(blocks, around)
    return "\n\n".join(b.text for b in blocks if b.label)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages without html_col, with text string and n_chars long (code points). Every row gives one row; columns of those
    two names are replaced, all others stay whatever their names."""
    ensure_importable(pages.sparkSession)

    @F.arrow_udf("string")
    def text_of(column: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py()) for x in column], pa.string())

    (own,) = free(pages, "_text")
    names = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    out = pages.withColumn(own, text_of(F.col(f"`{html_col}`")))
    return out.select(*[F.col(f"`{c}`") for c in names], F.col(own).alias("text"), F.length(own).cast("long").alias("n_chars"))
