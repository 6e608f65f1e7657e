"""Main text of HTML pages by tree scoring.

A page is read into a tree of its elements. Elements that are never part of an article (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, comments of readers) are left out by their tag, role or class; by class
only where they do not hold the article itself, which is decided after the page is read. Class words that also occur in
the names of an article's own parts (``related-work``, ``share-price``) leave out only what is mostly links, unless the
whole name is made of such words; paragraphs and headings go by their class only for a name that is all advert, cookie
and the like. Of a header inside an article the headings stay. Each
paragraph then passes points for its length and its commas to its ancestors, fewer with each level; a container's
points are discounted by its link density. A best container inside an ``article`` element, or else inside ``main``,
stands for that element; otherwise it is kept with what lies beside it and is not mostly links. Its blocks are the
result, in page order. Articles beside the best one that have a fifth of its score and are not mostly links belong to it.

Pages are independent of each other: one pass without a shuffle, in Arrow batches. The time is linear in the length of
a page, however deep its elements are nested or left open: what is open is looked up by name, and sums and decisions
pass through the tree once. A page is held in memory whole, with its elements and blocks.

Defined cases: a null or empty page has an empty text; equal rows are read alike; an empty table gives no rows; broken
markup (unclosed or crossed tags, cut-off pages, stray ``<``) is read the way browsers recover from it, roughly.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm import ship

ship(__name__)

TAG = re.compile(r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*+(?:>|\Z)"
                 r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
                 r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
PART = re.compile(r"[\s_\-]+|(?<=[a-z])(?=[A-Z])")

RAW = frozenset("script style textarea iframe noembed noframes xmp title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option
    p pre search section summary table tbody td tfoot th thead title tr ul""".split())
LEFT_OUT_TAGS = frozenset("""head script style noscript template nav header footer aside form button select textarea
    iframe object embed svg canvas audio video dialog menu title noembed noframes xmp datalist search""".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
LEFT_OUT_WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promoted banner
    nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent notice
    notices alert popup modal overlay newsletter subscribe signup comment comments disqus reply replies respond share
    sharing social related recommended pagination pager widget toolbar legal copyright disclaimer imprint""".split())
# Of these words, the ones that an article's own parts are named with too.
DOUBLE_WORDS = frozenset("""alert banner footer header legal menu notice notices related recommended replies reply
    respond share sharing social""".split())
# Words that say nothing about the content.
PLAIN_WORDS = frozenset("""area bar block bottom box buttons container inner item items left links list main outer page
    posts right row site top wrapper""".split())
BONUS = {"article": 25.0, "main": 15.0, "section": 2.0, "div": 2.0, "blockquote": 2.0}
GOOD_WORDS = frozenset("article content main body entry post story text".split())
# A start tag closes these open elements, up to the nearest of its bounds.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Where an unclosed paragraph may not be closed from inside.
SCOPE = frozenset("table td th caption button object html body article section div".split())

# Blocks that hold text rather than other blocks.
TEXT_BLOCKS = HEADINGS | {"p"}
# Block elements from outside of which an end tag of an inline element closes nothing inside.
WALLS = BLOCK - TEXT_BLOCKS

LEVELS = 5
# An article beside the best one is kept from this share of its score on.
SECOND_ARTICLE = 0.2
# From this share of its text inside links on, a part beside the best container is no part of the article.
LINK_DENSE = 0.5


NO_DOUBT, IF_LINKS, BY_NAME = 0, 1, 2


class Element:
    __slots__ = ("tag", "parent", "left_out", "points", "chars", "link_chars", "bonus", "doubtful", "number",
                 "in_article", "own_header")

    def __init__(self, tag: str, parent: Element | None, left_out: bool, bonus: float):
        self.tag, self.parent, self.left_out, self.bonus = tag, parent, left_out, bonus
        self.points, self.chars, self.link_chars, self.doubtful, self.number = 0.0, 0, 0, NO_DOUBT, 0
        self.in_article = self.own_header = False

    def density(self) -> float:
        return self.link_chars / self.chars if self.chars else 0.0

    def score(self) -> float:
        return (self.points + self.bonus) * (1.0 - self.density())


@lru_cache(maxsize=4096)
def _class_words(tag: str, attributes: str) -> tuple[set[str], bool, int]:
    """The words of class and id, whether the element is hidden or has a role that is left out, and its doubt."""
    found: set[str] = set()
    hidden = False
    doubt = NO_DOUBT
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if name in ("class", "id"):
            for label in value.split():
                words = {w.lower() for w in PART.split(label)} - {""}
                found |= words
                doubt = max(doubt, _doubt(tag, words))
        elif name == "role":
            hidden |= value.strip().lower() in LEFT_OUT_ROLES
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        elif name == "aria-hidden":
            hidden |= value.strip().lower() == "true"
        else:
            hidden = True
    return found, hidden, doubt


def _doubt(tag: str, words: set[str]) -> int:
    """Whether a class of these words leaves out the element by its name, only if it is mostly links, or not."""
    hits = words & LEFT_OUT_WORDS
    if not hits or tag in ("article", "main"):
        return NO_DOUBT
    whole = words <= LEFT_OUT_WORDS | PLAIN_WORDS
    sure = not hits <= DOUBLE_WORDS
    if tag in WALLS:
        return BY_NAME if whole or sure else IF_LINKS
    if whole and sure:
        return BY_NAME
    return IF_LINKS if tag in TEXT_BLOCKS else NO_DOUBT


class _Open:
    """The open elements of a page. What is asked of them is answered without a walk through the stack."""

    def __init__(self, root: Element):
        self.stack = [root]
        self.by_tag: dict[str, list[int]] = {}
        self.blocks: list[int] = [0]
        self.walls: list[int] = [-1]
        self.scopes: list[int] = [-1]
        self.links = 0

    def push(self, element: Element) -> None:
        at = len(self.stack)
        self.stack.append(element)
        self.by_tag.setdefault(element.tag, []).append(at)
        if element.tag in BLOCK:
            self.blocks.append(at)
        if element.tag in WALLS:
            self.walls.append(at)
        if element.tag in SCOPE:
            self.scopes.append(at)
        self.links += element.tag == "a"

    def pop_to(self, at: int) -> None:
        while len(self.stack) > at:
            tag = self.stack.pop().tag
            self.by_tag[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()
            if tag in WALLS:
                self.walls.pop()
            if tag in SCOPE:
                self.scopes.pop()
            self.links -= tag == "a"

    def nearest(self, tag: str) -> int:
        """The place of the innermost open element of this name, or -1."""
        held = self.by_tag.get(tag)
        return held[-1] if held else -1

    def innermost(self, tags: set[str]) -> int:
        return max(map(self.nearest, tags))


def _tree(page: str, spared: set[int] | None = None) -> tuple[list[Element], list[tuple[Element, str, int]]]:
    """All elements, and the blocks of text in page order: (element, text, characters inside links).

    Elements with a class word to leave out are marked as doubtful; they are left out unless ``spared`` has their number
    or is not given.
    """
    root = Element("#root", None, False, 0.0)
    elements, blocks = [root], []
    opened = _Open(root)
    stack = opened.stack
    held: list[str] = []
    links = 0
    at, end = 0, len(page)
    owner = root

    def flush() -> None:
        nonlocal links
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text and not owner.left_out:
                blocks.append((owner, text, min(links, len(text))))
            held.clear()
        links = 0

    def close(place: int) -> None:
        if opened.blocks[-1] >= place:
            flush()
        opened.pop_to(place)

    while at < end:
        m = TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at and not stack[-1].left_out:
            text = page[at:stop]
            if not held:
                owner = stack[opened.blocks[-1]]
            held.append(text)
            if opened.links:
                links += len(text.strip())
        if m is None:
            break
        at = m.end()
        name = m.group(2) or m.group(5)
        if name is None:
            continue
        tag = name.lower()
        closing = m.group(1) if m.group(2) else m.group(4)
        if closing:
            place = opened.nearest(tag)
            # An inline element is not closed from inside a block that it holds.
            if place > 0 and (tag in BLOCK or place > opened.walls[-1]):
                close(place)
            continue
        attributes = m.group(3) if m.group(2) else m.group(6)
        if tag in ("br", "wbr", "hr"):
            if tag == "hr":
                flush()
            elif tag == "br" and held:
                held.append(" ")
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:
            place, bound = opened.nearest("p"), opened.scopes[-1]
            if tag in CLOSES:
                closes, bounds = CLOSES[tag]
                place, bound = max(place, opened.innermost(closes)), max(bound, opened.innermost(bounds))
            if place > 0 and place >= bound:
                close(place)
            flush()
        parent = stack[-1]
        # Headings in the header of an article are its title; nothing else of that header is kept.
        title = tag in HEADINGS and parent.own_header
        barred = tag in LEFT_OUT_TAGS or (parent.left_out and not title)
        doubt = NO_DOUBT
        bonus = BONUS.get(tag, 0.0)
        left_out, hidden = barred, False
        if attributes.strip() and (not barred or tag == "header" or parent.own_header) and tag not in ("html", "body"):
            found, hidden, doubt = _class_words(tag, attributes)
            if barred or hidden:
                doubt = NO_DOUBT
            left_out = barred or hidden or doubt != NO_DOUBT and spared is not None and len(elements) not in spared
            bonus += 10.0 if found & GOOD_WORDS else 0.0
        element = Element(tag, parent, left_out, bonus)
        element.doubtful = doubt
        element.in_article = parent.in_article or tag in ("article", "main")
        element.own_header = not hidden and (
            tag == "header" and not parent.left_out and parent.in_article
            or parent.own_header and tag not in LEFT_OUT_TAGS)
        if tag in RAW:
            shut = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = shut.end() if shut else end
            continue
        if attributes.rstrip().endswith("/") and tag not in BLOCK:
            continue
        element.number = len(elements)
        elements.append(element)
        opened.push(element)
    flush()
    return elements, blocks


def _points(text: str) -> float:
    return 1.0 + text.count(",") + min(len(text) / 100.0, 3.0)


def _spared(elements: list[Element], blocks: list[tuple[Element, str, int]]) -> set[int]:
    """The numbers of doubtful elements that hold the article after all: two of these must be so.

    It has an article or main element; it has the larger part of the paragraph points; no other article or main element
    is elsewhere on the page outside doubtful elements. Articles inside an article (such as comments) do not count.
    """
    total = 0.0
    marks = [0] * len(elements)
    sums = [0.0] * len(elements)
    for element, text, links in blocks:
        total += (worth := _points(text))
        sums[element.number] += worth
        element.chars += len(text)
        element.link_chars += links
    # Parents come before children, so what is known of them is passed down, and sums are passed up in reverse.
    _sum_up(elements)
    in_article, in_doubt, clear, above = ([False] * len(elements), [False] * len(elements), 0, [0] * len(elements))
    doubted = [e.doubtful == BY_NAME or e.doubtful == IF_LINKS and e.density() >= LINK_DENSE for e in elements]
    for i, e in enumerate(elements[1:], 1):
        up = e.parent.number
        landmark = not e.left_out and (e.tag == "main" or e.tag == "article" and not in_article[up])
        marks[i] = int(landmark)
        in_article[i] = in_article[up] or e.tag == "article"
        in_doubt[i] = in_doubt[up] or doubted[i]
        undisputed = landmark and not in_doubt[i]
        clear += undisputed
        above[i] = above[up] + undisputed
    for i in range(len(elements) - 1, 0, -1):
        up = elements[i].parent.number
        marks[up] += marks[i]
        sums[up] += sums[i]
    return {i for i, e in enumerate(elements) if e.doubtful != NO_DOUBT
            and (not doubted[i] or (marks[i] > 0) + (2 * sums[i] > total) + (clear == above[i]) >= 2)}


def _sum_up(elements: list[Element]) -> None:
    """Pass the characters of each element up to all that hold it."""
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.chars += e.chars
            e.parent.link_chars += e.link_chars


def main_text(page: str | None) -> str:
    if not page:
        return ""
    elements, blocks = _tree(page)
    if any(e.doubtful for e in elements):
        elements, blocks = _tree(page, _spared(elements, blocks))
    scored: dict[Element, None] = {}
    for element, text, links in blocks:
        element.chars += len(text)
        element.link_chars += links
        points = _points(text)
        # A paragraph passes its points to what contains it; text straight in a container counts for that.
        holder = element.parent if element.tag in HEADINGS | {"p", "li", "pre", "td", "dd", "dt"} else element
        for level in range(LEVELS):
            if holder is None:
                break
            share = (1.0, 0.5)[level] if level < 2 else 1.0 / (3.0 * level)
            holder.points += points * share
            scored[holder] = None
            holder = holder.parent
    if not scored:
        return ""
    _sum_up(elements)
    best = max(scored, key=Element.score)
    main: Element | None = None
    ancestor: Element | None = best
    while ancestor is not None:
        if ancestor.tag == "article":
            best = ancestor
        elif ancestor.tag == "main":
            main = ancestor
        ancestor = ancestor.parent
    if best.tag != "article" and main is not None:
        best = main
    # Without such an element, what lies beside the best container belongs to it, long or short, unless it is links.
    around = None if best.tag in ("article", "main") else best.parent
    kept = [False] * len(elements)
    for e in elements:
        beside = e.parent is not None and e.parent is around and e.density() < LINK_DENSE
        second = (best.tag == e.tag == "article" and e.parent is best.parent and e.density() < LINK_DENSE
                  and e.score() >= SECOND_ARTICLE * best.score())
        kept[e.number] = e is best or beside or second or (e.parent is not None and kept[e.parent.number])
    return " ".join(text for element, text, links in blocks
                    if kept[element.number] or element is around and links < LINK_DENSE * len(text))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column("html")]
        yield pa.record_batch(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points of the text) of every page."""
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, f"page_id {kind}, url string, text string, n_chars long")
