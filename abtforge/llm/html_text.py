"""Main text of web pages by two passes of block rules.

A page is read once, tag by tag, into blocks: runs of text between the starts and ends of block
elements, each with its characters, characters inside links, stop words and place in the element
tree.  Scripts, styles, comments and the head give no blocks; a tag that is never closed ends with its
parent, and an unfinished one is text as far as browsers show it.

First pass, block by block.  Bad: a block inside an element that holds no article text (menus,
headers, footers, asides, forms, dialogs, hidden elements, and elements whose class, id or role says
so: adverts, notices, comments, ...), one of mostly link text, a short one with links or a copyright
sign, a long one nearly without stop words.  Good: a long block with enough stop words.  The rest,
short or in between, stays undecided.  Inside an ``article`` or ``main`` element that holds most of
the page's candidate text, every long block is good and everything outside is bad.

Second pass: an undecided block takes the label of its nearest decided neighbours, before and
after.  Where they differ the nearer one counts, by element boundaries crossed and then by blocks
between; if that is even, a heading goes with what follows it and any other block by its stop words.
Inside an article only the blocks of that article count, and without a good one among them all its
undecided blocks are good.  A page without any good block keeps its undecided ones rich in stop
words, or, if a class or id alone ruled everything out, is judged again without classes and ids.

Good blocks are kept whole, with character references decoded and white space (Unicode) as single
spaces, and joined by spaces in page order.

Data flow: one pass over the pages, no shuffle; a task holds one Arrow batch and one page's blocks.
Reading a page and both passes are linear in its length.

Defined results: NULL or empty html, and pages without article text, give an empty text; text
outside any tag is a block like any other; very long pages are read whole; NULL ids and urls are
carried; repeated rows give repeated results; further columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORT, LONG = 70, 140
MOST_LINKS = 0.3
POOR, RICH = 0.05, 0.2

# fixed values: the most frequent function words of English, German, French and Spanish
STOP_WORDS = frozenset("""
a an and are as at be but by for from had has have he her his in is it not of on or she that the their they this to was we were which with you
als am an auch auf aus bei das dass dem den der des die ein eine einer für ich im in ist mit nicht oder sich sie sind und von war wie wir zu zum zur
au aux avec ce cette dans de des du elle en est et il je la le les leur mais ne nous on ou par pas pour qui que se son sur un une vous
al como con del el ella en es esta este la las lo los más no para pero por que se sin son su sus un una y
""".split())

# fixed values: elements of HTML
DROPPED = frozenset("script style noscript template iframe object svg math title textarea select canvas audio video".split())
BAD_ELEMENTS = frozenset("nav footer aside form button dialog menu label option fieldset head".split())
BLOCK_ELEMENTS = frozenset("""
address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul
""".split())
VOID_ELEMENTS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# an open element that ends where one of these begins beside it
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
            "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option"}, "p": BLOCK_ELEMENTS, "head": {"body"}}
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())

SPECIAL = BAD_ELEMENTS | {"article", "main", "header"}

# fixed values: words in classes and ids of elements that hold no article text
BAD_NAMES = frozenset("""
ad ads advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promotion cookie cookies consent gdpr notice notices
alert popup modal overlay newsletter subscribe subscription signup login sidebar rail widget widgets menu nav navbar navigation breadcrumb
breadcrumbs pagination pager toolbar footer share sharing social related recommended recommendations search copyright disclaimer
""".split())
COMMENT_NAMES = frozenset("comment comments commentlist reply replies respond disqus".split())
HEADER_NAMES = frozenset("header masthead topbar".split())
LAYOUT_NAMES = frozenset("no has with without not hide show".split())

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)(?:>|\Z))""", re.S)
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for name in DROPPED}
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_WORD = re.compile(r"[^\W\d_]+")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

GOOD, BAD = True, False


@dataclass(slots=True)
class Block:
    """A run of text: its place (depth, lowest depth since the block before) and its label."""

    text: str
    link_chars: int
    depth: int
    low: int
    heading: bool
    outside: bool          # in an element without article text
    by_name: bool          # that is so by class or id alone
    scope: int             # number of the article element around it, 0 for none
    label: bool | None = None
    density: float | None = None


@dataclass(slots=True)
class Element:
    name: str
    outside: bool
    by_name: bool
    scope: int
    comments: bool


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(source)} if source else {}


def _names(attributes: dict[str, str]) -> set[str]:
    """The words of class and id; names such as ``has-sidebar`` describe the layout and say nothing."""
    out: set[str] = set()
    for token in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = {p.lower() for p in _NAME.findall(token)}
        out |= parts if parts.isdisjoint(LAYOUT_NAMES) else set()
    return out


def _opened(name: str, source: str, parent: Element, fresh: int) -> Element:
    """The element that a start tag opens inside ``parent``."""
    if len(source) < 3 and name not in SPECIAL:  # no attribute: like its parent
        return Element(name, parent.outside, parent.by_name, parent.scope, parent.comments)
    attributes = _attributes(source)
    names = _names(attributes) if "class" in attributes or "id" in attributes else set()
    role = attributes.get("role", "").lower()
    comments = parent.comments or not names.isdisjoint(COMMENT_NAMES) and name not in ("html", "body", "main")
    if (name in ("article", "main") or role in ("article", "main")) and not comments:
        return Element(name, False, False, parent.scope or fresh, False)
    hidden = re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", source) is not None and "aria-hidden" not in attributes or attributes.get("aria-hidden", "").lower() == "true" \
        or _HIDDEN.search(attributes.get("style", "").lower()) is not None
    by_tag = name in BAD_ELEMENTS or role in BAD_ROLES or hidden or name == "header" and not parent.scope
    named = name not in ("html", "body") and (comments or not names.isdisjoint(BAD_NAMES) or not parent.scope and not names.isdisjoint(HEADER_NAMES))
    outside = parent.outside and not parent.by_name or by_tag
    return Element(name, outside or parent.outside or named, not outside and (parent.by_name or named), parent.scope, comments)


def page_blocks(page: str) -> list[Block]:
    """The blocks of a page in order, unlabelled."""
    stack = [Element("", False, False, 0, False)]
    out: list[Block] = []
    pieces: list[tuple[str, bool]] = []
    low, link_depth, scopes, at = 0, 0, 0, 0
    heading = False

    def flush() -> None:
        nonlocal low
        if pieces:
            text = " ".join("".join(t for t, _ in pieces).split())
            if text:
                top = stack[-1]
                links = sum(len("".join(t.split())) for t, linked in pieces if linked)
                out.append(Block(text, links, len(stack), min(low, len(stack)), heading, top.outside, top.by_name, top.scope))
                low = len(stack)
            pieces.clear()

    def say(text: str) -> None:
        if text:
            pieces.append((entities.unescape(text) if "&" in text else text, link_depth > 0))

    position = page.find("<")
    while position >= 0:
        m = _TAG.match(page, position)
        if not m:  # a lone "<" is text
            position = page.find("<", position + 1)
            continue
        say(page[at:position])
        at = m.end()
        closing, name = m[1], (m[2] or "").lower()
        if name and not closing and name in DROPPED:
            empty = m[3].endswith("/")
            if not (empty and name in ("svg", "math")):
                end = _END[name].search(page, at)
                at = end.end() if end else at if empty else len(page)
        elif name == "br":
            pieces.append((" ", False))
        elif name == "a":
            link_depth = 0 if closing or "href" not in m[3].lower() else len(stack)
        elif closing:
            if name in BLOCK_ELEMENTS:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    flush()
                    del stack[k:]
                    low, heading = min(low, len(stack)), stack[-1].name in HEADINGS
                    link_depth = link_depth if link_depth <= len(stack) else 0
                    break
                if name not in BLOCK_ELEMENTS and stack[k].name in BLOCK_ELEMENTS:
                    break  # an inline element ends inside its block
        elif name:
            block = name in BLOCK_ELEMENTS
            if block:
                flush()
                while name in ENDED_BY.get(stack[-1].name, ()):
                    stack.pop()
                low, heading = min(low, len(stack)), stack[-1].name in HEADINGS
                link_depth = link_depth if link_depth <= len(stack) else 0
            if name not in VOID_ELEMENTS:
                element = _opened(name, m[3], stack[-1], scopes + 1)
                if block or (element.outside, element.scope) != (stack[-1].outside, stack[-1].scope):
                    flush()
                    scopes = max(scopes, element.scope)
                    stack.append(element)
                    heading = name in HEADINGS
        position = page.find("<", at)
    say(page[at:])
    flush()
    return out


def density(b: Block) -> float:
    """Share of stop words, computed once."""
    if b.density is None:
        words = _WORD.findall(b.text.lower())
        b.density = sum(map(STOP_WORDS.__contains__, words)) / max(1, len(words))
    return b.density


def ruled_out(b: Block, by_name: bool) -> bool:
    return b.outside and (by_name or not b.by_name)


def own_label(b: Block, scoped: bool) -> bool | None:
    """What a block's own text and place decide; None if they leave it open."""
    n, inside = len(b.text), scoped and b.scope > 0
    if scoped and not inside:
        return BAD
    if b.link_chars and b.link_chars > MOST_LINKS * len(b.text.replace(" ", "")) or not inside and n < LONG and ("©" in b.text or b.link_chars and n < SHORT):
        return BAD
    if b.heading or n < SHORT:
        return None
    if inside or n >= LONG and density(b) >= RICH:
        return GOOD
    return BAD if n >= LONG and density(b) < POOR else None


def _neighbours(blocks: list[Block]) -> Iterator[tuple[bool, int, int] | None]:
    """Per block the nearest decided one before it: its label, boundaries crossed, blocks between."""
    found = None
    for i, b in enumerate(blocks):
        if found is not None:
            found[3] = min(found[3], b.low)
        yield None if found is None else (found[0], found[2] - found[3] + b.depth - found[3], i - found[1])
        if b.label is not None:
            found = [b.label, i, b.depth, b.depth]


def _reversed(blocks: list[Block]) -> list[Block]:
    """The blocks backwards; the lowest depth before a block becomes the one after it."""
    lows = [b.low for b in blocks[1:]] + [0]
    return [Block("", 0, b.depth, low, b.heading, False, False, 0, b.label) for b, low in zip(blocks, lows)][::-1]


def second_pass(blocks: list[Block], good_by_default: bool) -> None:
    """Undecided blocks of one scope inherit from their nearest decided neighbours."""
    if good_by_default and not any(b.label is GOOD for b in blocks):
        for b in blocks:
            b.label = GOOD if b.label is None else b.label
        return
    before, after = list(_neighbours(blocks)), list(_neighbours(_reversed(blocks)))[::-1]
    labels = []
    for b, one, other in zip(blocks, before, after):
        if b.label is not None or not (one or other):
            labels.append(b.label)
        elif not (one and other) or one[0] == other[0]:
            labels.append((one or other)[0])
        elif one[1:] != other[1:]:
            labels.append(min(one, other, key=lambda x: x[1:])[0])
        else:
            labels.append(other[0] if b.heading else density(b) >= RICH)
    for b, label in zip(blocks, labels):
        b.label = label


def label_blocks(blocks: list[Block]) -> None:
    """Both passes; every block gets a label."""
    for by_name in (True, False):
        usable = [b for b in blocks if not ruled_out(b, by_name)]
        within = sum(len(b.text) for b in usable if b.scope)
        scoped = within > 0 and 2 * within >= sum(len(b.text) for b in usable if not b.scope and own_label(b, False) is GOOD)
        for b in blocks:
            b.label = BAD if ruled_out(b, by_name) else own_label(b, scoped)
        open_blocks = [b for b in usable if b.label is None]
        if scoped:
            for scope in {b.scope for b in open_blocks}:
                second_pass([b for b in usable if b.scope == scope], good_by_default=True)
        elif open_blocks:
            second_pass(blocks, good_by_default=not any(b.label is BAD for b in blocks))
        for b in usable:
            b.label = density(b) >= RICH if b.label is None else b.label
        if not scoped and not any(b.label is GOOD for b in usable):
            for b in open_blocks:
                b.label = density(b) >= RICH
        if any(b.label is GOOD for b in usable):
            return


def main_text(page: str) -> str:
    """The article text of one page."""
    blocks = page_blocks(page)
    label_blocks(blocks)
    return " ".join(b.text for b in blocks if b.label is GOOD)


def extracted(html: Column) -> Column:
    """The article text of a column of pages; empty for NULL."""

    @F.arrow_udf("string")
    def texts(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p) if p else "" for p in pages.to_pylist()], pa.string())

    return texts(html)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``."""
    out = pages.select("page_id", "url", extracted(F.col("html")).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
