"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. **Pass one** looks at each block alone: its container (navigation, header,
footer, sidebar, notice, advert, form, comments: bad), its link density (bad if most of it is links), its length and its
density of stop words (long text with enough stop words is good, without them bad; on a page without any good block the
middling ones are good). What counts as enough is measured against
the page's own text, so prose in a language outside the list is judged by length and links. Short blocks, and middling ones,
stay undecided. **Pass two** gives each undecided block the label of the nearest decided block, where one in the same element
is nearer than any other and the page's edges count as bad; a tie goes to good inside an article and for middling blocks. A
heading stays if anything of its section does.

`<article>` and `<main>` are a prior, not a verdict: inside them text without stop words and a single linked line are
undecided instead of bad, two linked blocks in a row (a list of other stories, a table of contents) are bad as elsewhere, and
a block without decided neighbours stays. A class or id that holds boilerplate words beside others (`social-issues-report`)
only turns middling blocks into short ones. If a page keeps nothing, such names are looked past, then links in its articles.
Where one article alone holds at least as much kept text as stands outside all of them, the text outside is left out;
shorter articles are cards beside the main text, and all kept text stays. An article that keeps nothing but links is a
teaser, left out unless the page has no other text.

Text keeps page order, one line a block; character references are decoded, white space inside a block becomes one blank.
Scripts, styles, forms, markup and comments of the page's source give no text. Nothing else is dropped or capped.

Scale: each page by itself in one Arrow pass, no shuffle; the scanner is linear in the page's length.

Edge cases: null or empty html gives the empty text. Unclosed tags close with their container; a page cut off in the
middle is read to its end. Repeated rows give repeated results. Extra columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Shorter blocks (code points) are undecided unless they are links.
SHORT = 70
#: Longer blocks with many stop words are good at once.
LONG = 200
STOP_LOW, STOP_HIGH = 0.15, 0.30
#: The same two as shares of the density of the page's own text, where that is less.
LOW_SHARE, HIGH_SHARE = 0.5, 0.8
MOST_LINKS = 0.5

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    (
        "the of and to a in is it that for on with as was at by be this from are or an which you not have were but they "
        "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie "
        "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou "
        "el los y del se las por con no su para es al lo como más o pero sus le ya este si porque esta entre son"
    ).split()
)

_SKIPPED = frozenset("script style noscript template iframe object svg math canvas audio video head title textarea select option button".split())
_RAW = frozenset("script style textarea title iframe noscript".split())
_BOILER_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
_MAIN_TAGS = frozenset("article main".split())
_BLOCK_TAGS = frozenset(
    (
        "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
        "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul"
    ).split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that are lines of the element around them.
_LINES = _HEADINGS | frozenset("p li dt dd br hr pre blockquote caption tr td th".split())
#: A start tag on the left closes an open element on the right.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_CLOSES_P = _BLOCK_TAGS - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "html", "body", "head"}

#: Words of a class or id that mark boilerplate, those that do so outside an article only, those that hint at it there, and
#: those that may stand beside them: a name with any other word in it is no more than a hint.
_BOILER_WORDS = frozenset(
    (
        "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar nav navbar navigation menu "
        "breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription "
        "signup login share sharing social related recommended recommendations comment comments commentlist respond reply replies disqus "
        "discussion widget toolbar pagination pager copyright disclaimer alert skip"
    ).split()
)
_OUTER_WORDS = frozenset("header masthead topbar foot".split())
_HINT_WORDS = frozenset("bottom side aside tags meta legal".split())
_FRAME_WORDS = frozenset(
    (
        "box list lists area wrap wrapper container content inner outer block section item items link links button buttons bar slot unit "
        "main site page top bottom left right post posts article articles entry story stories news form thread count body text group row "
        "col column global primary secondary zone panel header head icons media reader user more all js id"
    ).split()
)
_COMMENT_WORDS = frozenset("comment comments reply ad advert".split())
_BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())

_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>?)", re.S
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Words; in scripts without blanks between words each character is one.
_WORDS = re.compile(r"[\u3040-\u30ff\u4e00-\u9fff]|[^\W\d_\u3040-\u30ff\u4e00-\u9fff]+")
_WIDE = re.compile(r"[\u3040-\u30ff\u4e00-\u9fff\uac00-\ud7af]")


@dataclass(slots=True)
class Block:
    text: str
    link_chars: int
    boiler: bool
    hint: bool  # its container's name hints at boilerplate
    main: int  # number of the article it stands in, 0 outside
    parent: int  # number of the element that holds its paragraph or list item
    heading: int  # level, 0 for other text


@dataclass(slots=True)
class Element:
    """An open element; all but the tag and the number hold for what stands in it."""

    tag: str
    boiler: bool = False
    hint: bool = False
    skipped: bool = False
    main: int = 0
    parent: int = 0
    link: bool = False
    heading: int = 0
    block: int = 0  # place on the stack of the innermost block-level element


CLEAN, HINT, BOILER = 0, 1, 2


def _name_mark(value: str, tag: str, in_main: bool) -> int:
    """What a class or id says of an element."""
    mark = CLEAN
    for name in value.split():
        parts = {p.lower() for p in _NAME_PARTS.findall(name)}
        if tag in _MAIN_TAGS:
            if parts & _COMMENT_WORDS and parts <= _BOILER_WORDS | _FRAME_WORDS:
                return BOILER
            continue
        strong = _BOILER_WORDS if in_main else _BOILER_WORDS | _OUTER_WORDS
        if parts & strong:
            if parts <= strong | _FRAME_WORDS:
                return BOILER
            mark = HINT
        elif not in_main and parts & _HINT_WORDS:
            mark = HINT
    return mark


def _mark(tag: str, attributes: str, in_main: bool) -> int:
    """Whether an element is boilerplate, by its tag and attributes."""
    if tag in _BOILER_TAGS and not (tag == "header" and in_main):
        return BOILER
    mark = CLEAN
    if not attributes or len(attributes) < 4:
        return mark
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            if tag not in ("html", "body"):
                mark = max(mark, _name_mark(value, tag, in_main))
        elif name == "role" and value.lower() in _BOILER_ROLES:
            return BOILER
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return BOILER
        elif name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return BOILER
    return mark


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order."""
    out: list[Block] = []
    pieces: list[str] = []
    link_chars = heading = articles = parents = at = 0
    stack = [Element("")]
    places: dict[str, list[int]] = {}  # of each tag, where its open elements stand on the stack

    def add(raw: str) -> None:
        nonlocal link_chars, heading
        top = stack[-1]
        if not raw or top.skipped:
            return
        pieces.append(raw)
        if not raw.isspace():
            heading = heading or top.heading
            if top.link:
                link_chars += len(raw.strip())

    def close_block() -> None:
        nonlocal pieces, link_chars, heading
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                top = stack[-1]
                out.append(Block(text, link_chars, top.boiler, top.hint, top.main, top.parent, heading))
            pieces, link_chars, heading = [], 0, 0

    def cut(k: int) -> None:
        while len(stack) > k:
            places[stack.pop().tag].pop()

    while at < len(page):
        found = page.find("<", at)
        if found < 0:
            add(page[at:])
            break
        match = _MARKUP.match(page, found)
        if not match:
            add(page[at : found + 1])
            at = found + 1
            continue
        add(page[at:found])
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if tag in _BLOCK_TAGS:
            close_block()
        if match[1]:
            # an inline end tag does not close blocks; one that nothing is open for says nothing
            if places.get(tag) and (tag in _BLOCK_TAGS or places[tag][-1] > stack[-1].block):
                cut(places[tag][-1])
            continue
        attributes = match[3].rstrip(">")
        closing = _CLOSES.get(tag, set()) | ({"p"} if tag in _CLOSES_P else set())
        while closing and stack[stack[-1].block].tag in closing:
            cut(stack[-1].block)
        if tag in _VOID:
            continue
        top = stack[-1]
        main = top.main
        if tag in _MAIN_TAGS and not main:
            articles += 1
            main = articles
        mark = _mark(tag, attributes, bool(top.main))
        if tag in _RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
        if attributes.endswith("/") and tag in ("svg", "math", "path"):
            continue
        parent = top.parent
        if tag in _BLOCK_TAGS and tag not in _LINES:
            parents += 1
            parent = parents
        places.setdefault(tag, []).append(len(stack))
        stack.append(
            Element(
                tag,
                top.boiler or mark == BOILER,
                top.hint or mark == HINT,
                top.skipped or tag in _SKIPPED,
                main,
                parent,
                top.link or tag == "a",
                top.heading or (int(tag[1]) if tag in _HEADINGS else 0),
                len(stack) if tag in _BLOCK_TAGS else top.block,
            )
        )
    close_block()
    return out


GOOD, BAD, NEAR, SHORT_BLOCK = "good", "bad", "near", "short"


def is_linked(block: Block) -> bool:
    """Whether most of a block is links; a heading may be one."""
    return block.link_chars > MOST_LINKS * len(block.text) and not block.heading


def stop_words(block: Block) -> tuple[int, int]:
    """Stop words and words of a block."""
    words = _WORDS.findall(block.text.lower())
    return sum(w in STOP_WORDS for w in words), len(words)


def thresholds(counts: list[tuple[int, int]]) -> tuple[float, float]:
    """The densities of stop words that make a block of this page middling, and good; of its blocks' stop words and words."""
    own = sum(s for s, _ in counts) / max(1, sum(n for _, n in counts))
    return min(STOP_LOW, LOW_SHARE * own), min(STOP_HIGH, HIGH_SHARE * own)


def first_pass(block: Block, words: tuple[int, int], low: float, high: float, in_list: bool) -> str:
    """The label of a block seen alone; ``words``: its stop words and words; ``in_list``: one beside it is links, too."""
    if block.boiler:
        return BAD
    if is_linked(block):
        return BAD if in_list or not block.main else SHORT_BLOCK
    size = len(block.text) + len(_WIDE.findall(block.text))
    if size < SHORT:
        return SHORT_BLOCK
    density = words[0] / max(1, words[1])
    if density >= high and size > LONG:
        return GOOD
    if density >= low:
        return SHORT_BLOCK if block.hint else NEAR
    if block.main:
        return NEAR
    return BAD if size > LONG else SHORT_BLOCK  # a dozen words say little of density


def _decided(page: list[Block], labels: list[str], order: range) -> list[int | None]:
    """For each block the nearest decided one before it in ``order``, in the same article (or outside all): one in the same
    element if there is any, else the next."""
    by_parent: dict[tuple[int, int], int] = {}
    by_main: dict[int, int] = {}
    seen: list[int | None] = [None] * len(page)
    for i in order:
        b = page[i]
        if b.boiler:
            continue  # a container's boilerplate says nothing about the text around it
        seen[i] = by_parent.get((b.main, b.parent), by_main.get(b.main))
        if labels[i] in (GOOD, BAD):
            by_parent[b.main, b.parent] = by_main[b.main] = i
    return seen


def second_pass(page: list[Block], labels: list[str]) -> list[bool]:
    """Undecided blocks inherit from their nearest decided neighbour; headings from their section."""
    n = len(page)
    before, after = _decided(page, labels, range(n)), _decided(page, labels, range(n - 1, -1, -1))
    keep = []
    for i, label in enumerate(labels):
        if label in (GOOD, BAD):
            keep.append(label == GOOD)
            continue
        b = page[i]
        sides = []  # (in another element, blocks away, label)
        for j, edge in ((before[i], i + 1), (after[i], n - i)):
            if j is not None:
                sides.append((page[j].parent != b.parent, abs(i - j), labels[j]))
            elif not b.main:
                sides.append((True, edge, BAD))  # the page's edge is bad, an article's edge says nothing
        nearest = min((s[:2] for s in sides), default=None)
        found = {s[2] for s in sides if s[:2] == nearest}
        keep.append(found == {GOOD} if len(found) == 1 else bool(b.main) or label == NEAR)
    # of each article (0: outside), the next kept text and the next headings of each level
    text_at: dict[int, int] = {}
    any_at: dict[int, int] = {}
    heading_at: dict[int, list[int]] = {}
    for i in range(n - 1, -1, -1):
        b = page[i]
        if b.boiler:
            continue
        ends = heading_at.setdefault(b.main, [n] * 7)
        if b.heading and labels[i] not in (GOOD, BAD):
            end = min(ends[1 : b.heading + 1])
            if any_at.get(b.main, n) < end:
                keep[i] = text_at.get(b.main, n) < end
        if b.heading:
            ends[b.heading] = i
        else:
            any_at[b.main] = i
            if keep[i]:
                text_at[b.main] = i
    return keep


def _kept(page: list[Block]) -> list[bool]:
    linked = [is_linked(b) and not b.boiler for b in page]
    words = [(0, 0) if b.boiler or is_link else stop_words(b) for b, is_link in zip(page, linked, strict=True)]
    low, high = thresholds(words)
    labels = [
        first_pass(b, words[i], low, high, linked[i] and (i > 0 and linked[i - 1] or i + 1 < len(page) and linked[i + 1]))
        for i, b in enumerate(page)
    ]
    if GOOD not in labels:
        labels = [GOOD if label == NEAR else label for label in labels]
    return second_pass(page, labels)


def extract(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    found = blocks(page)
    keep = _kept(found)
    if not any(keep) and any(b.hint for b in found):
        found = [replace(b, hint=False) for b in found]
        keep = _kept(found)
    if not any(keep):
        keep = [b.main > 0 and not b.boiler for b in found]
    size: dict[int, int] = {}  # kept text of each article, 0 for the text outside
    prose = {0}
    for b, k in zip(found, keep, strict=True):
        if k:
            size[b.main] = size.get(b.main, 0) + len(b.text)
            if b.link_chars <= MOST_LINKS * len(b.text):
                prose.add(b.main)
    if 0 in size or len(prose) > 1:
        keep = [k and b.main in prose for b, k in zip(found, keep, strict=True)]
    if max((n for main, n in size.items() if main and main in prose), default=-1) >= size.get(0, 0):
        # a page whose article holds most of its text has no main text outside it
        keep = [k and b.main > 0 for b, k in zip(found, keep, strict=True)]
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    @F.pandas_udf("string")
    def text_of(page: pd.Series) -> pd.Series:
        return pd.Series([extract(p if isinstance(p, str) else None) for p in page], dtype=object)

    narrow = pages.select("page_id", "url", text_of(F.col("html").cast("string")).alias("text"))
    return narrow.withColumn("n_chars", F.length("text").cast("long"))
