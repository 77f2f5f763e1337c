"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags.  Words score by what encloses them, positive unless it speaks
against them, tags cost something; how much is learned from labelled pages.  A linear scan finds the
contiguous region with the largest sum.  Its text is the article, without the blocks in it whose purpose is
another one.  Tags and names are evidence of a purpose that adds up from the outside in, with weights that begin as
weak guesses and are learned, too; no name alone cuts a block that other evidence speaks for.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F

LABELLED_PAGES = 2000
LEAST_SEEN = 20

# What elements are.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style textarea iframe noscript xmp noembed noframes".split()
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CONTENT = frozenset(("article", "main"))
# what is never text of a page
HARD = frozenset("nav button dialog head title svg object audio video canvas template datalist select".split())
# words in class, id and role that tell what a block is for
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr notice notices"
    " popup modal overlay menu menus nav navbar navigation navi breadcrumb breadcrumbs sidebar sidebars aside footer share sharing"
    " newsletter subscribe signup login pagination pager skip complementary contentinfo".split()
)
# the same, of blocks that may as well hold the text
MIXED_WORDS = frozenset("alert banner search social toolbar widget widgets".split())
APART_WORDS = frozenset("comment comments commentlist discussion disqus replies respond reader related recommended recommendations trending".split())
HEADER_WORDS = frozenset("header masthead topbar".split())
# with one of these a name tells how a page is laid out, not what a block is for
STATE_WORDS = frozenset("has have no not non with without open opened closed enabled disabled allowed collapsed expanded".split())
CONTENT_WORDS = frozenset("article articlebody content main post entry story".split())
MARKS = ASIDE_WORDS | MIXED_WORDS | APART_WORDS | HEADER_WORDS
# evidence of tags and names before any page is seen, for (positive) and against
PURPOSE = {
    **dict.fromkeys((f".{w}" for w in ASIDE_WORDS), -6.0), **dict.fromkeys((f".{w}" for w in MIXED_WORDS), -3.0),
    **dict.fromkeys((f".{w}" for w in APART_WORDS), -12.0), **dict.fromkeys((f".{w}" for w in (*HEADER_WORDS, "post", "entry", "story", "content")), 2.0),
    **dict.fromkeys((f".{w}" for w in HEADER_WORDS), -4.0), "header": -4.0, "aside": -8.0, "footer": -7.0, "form": -8.0,
    "article": 4.0, "main": 4.0, ".article": 4.0, ".articlebody": 4.0, ".main": 2.0,
}
# How much of the evidence against what encloses it holds for an element that is labelled as content.
_THROUGH = 0.25
_MOST, _LEAST = 6.0, -20.0
# an element of the one kind ends those of the other that are still open in the same block
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/)?(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:[^'\">]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/a-zA-Z][^>]*>?"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
_NAMED = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Open(NamedTuple):
    """An open element: its keys for scoring, whether what it holds is no text, the evidence for it as content, that
    against even content in it, and whether it is labelled as content.
    """

    tag: str
    keys: frozenset[str]
    hard: bool
    purpose: float
    apart: float
    content: bool

    @property
    def aside(self) -> bool:
        return self.hard or 1.0 + self.purpose + self.apart < 0


NOTHING = Open("", frozenset(), False, 0.0, 0.0, False)


class Piece(NamedTuple):
    """A run of text or a tag.  ``block`` numbers the block of a text; ``keys`` says what encloses it."""

    text: str | None
    block: int
    keys: frozenset[str]
    aside: bool
    content: bool
    tag: str


class Element(NamedTuple):
    """A start tag: the number of the element that encloses it, whether it encloses others, and the words of its
    names (class, id, role): all, those that are a whole name, and those of compound names.
    """

    parent: int
    tag: str
    holds: bool
    words: frozenset[str]
    whole: frozenset[str]
    compound: frozenset[str]


def pieces(html: str, weights: Weights | None = None) -> list[Piece]:
    """The page as texts and tags.  Elements left open end with what encloses them.

    A name of one word, as ``sidebar``, tells what an element is for.  One of several, as ``sidebar-right``, a mixed
    one, as ``widget``, and a form may also be those of a wrapper around the content, so they do not count for an
    element with most of the content.
    """
    weights = weights or learned({})
    tokens, elements = _read(html)
    opened = _all_opened(elements, frozenset(), frozenset(), weights)
    doubtful = [i for i, e in enumerate(elements) if e.tag == "form" or e.compound & MARKS or e.whole & MIXED_WORDS]
    if doubtful:
        wrappers, linked = _wrappers(tokens, elements, opened, doubtful)
        opened = _all_opened(elements, frozenset(doubtful) - wrappers, linked, weights)
    out: list[Piece] = []
    for text, tag, block, top, element in tokens:
        around = opened[top]
        if element is None:
            out.append(Piece(text, block, around.keys if text is not None else frozenset((tag,)), around.aside, around.content, tag))
            continue
        own, parent = opened[element], opened[elements[element].parent]
        keys = own.keys - (parent.keys if elements[element].holds else frozenset())
        out.append(Piece(None, block, keys | {tag}, own.aside, own.content, tag))
    return out


def _read(html: str) -> tuple[list[tuple[str | None, str, int, int, int | None]], list[Element]]:
    """Texts and tags (text, tag, block, number of what encloses it, number of the element if it starts one) and all elements.

    The number of what nothing encloses is -1.
    """
    out: list[tuple[str | None, str, int, int, int | None]] = []
    elements: list[Element] = []
    stack: list[Element] = []
    numbers: list[int] = []
    block = 0
    for token in _TOKEN.finditer(html):
        top = numbers[-1] if numbers else -1
        text, tag = token["text"], token["tag"]
        if text is not None:
            out.append((text, "", block, top, None))
            continue
        if tag is None:
            continue
        tag = tag.lower()
        block += tag in BLOCK
        if tag == "br":
            out.append((" ", "", block, top, None))
        if token["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    del stack[i:], numbers[i:]
                    break
            out.append((None, tag, block, top, None))
            continue
        _end_open(stack, tag)
        del numbers[len(stack) :]
        attributes = token["attributes"] or ""
        element = _element(numbers[-1] if numbers else -1, tag, tag not in VOID and not attributes.endswith("/"), attributes)
        out.append((None, tag, block, top, len(elements)))
        if element.holds:
            stack.append(element)
            numbers.append(len(elements))
        elements.append(element)
    return out, elements


def _element(parent: int, tag: str, holds: bool, attributes: str) -> Element:
    words: set[str] = set()
    whole: set[str] = set()
    compound: set[str] = set()
    if tag not in ("html", "body"):
        for named in _NAMED.finditer(attributes):
            for name in (named[2] or named[3] or named[4] or "").split():
                parts = {p.lower() for p in _PARTS.findall(name) if not p.isdigit()}
                words |= parts
                if len(parts) == 1:
                    whole |= parts
                elif not parts & STATE_WORDS:
                    compound |= parts
    if tag == "main":
        whole, compound = set(), set()
    if tag == "article":
        # an article is content by its tag; a name as a whole may still tell that it is a comment or an advert
        whole, compound = set(), set() if whole & CONTENT_WORDS else whole
    return Element(parent, tag, holds, frozenset(words), frozenset(whole), frozenset(compound))


def _all_opened(elements: list[Element], sure: frozenset[int], linked: frozenset[int], weights: Weights) -> list[Open]:
    """All elements as open ones, those that are ``sure`` with all their evidence, and at the end, as number -1, that outside of all."""
    out: list[Open] = []
    for i, element in enumerate(elements):
        out.append(_opened(out[element.parent] if element.parent >= 0 else NOTHING, element, i in sure, i in linked, weights))
    return [*out, NOTHING]


def _wrappers(tokens: list, elements: list[Element], opened: list[Open], doubtful: list[int]) -> tuple[frozenset[int], frozenset[int]]:
    """Doubtful elements that hold more than half of the words of labelled content, or of all words if nothing is
    labelled, and those whose words are mostly those of links.

    Texts that are aside without the doubtful evidence do not count.
    """
    words, links = [0] * (len(elements) + 1), [0] * (len(elements) + 1)
    for text, _, _, top, _ in tokens:
        if text is not None:
            n = len(text.split())
            words[top] += n
            if "a" in opened[top].keys:
                links[top] += n
    wrappers: frozenset[int] = frozenset()
    for labelled in (True, False):
        held = [n if not o.aside and (o.content or not labelled) else 0 for n, o in zip(words, opened)]
        for i in range(len(elements) - 1, -1, -1):
            held[elements[i].parent] += held[i]
        if held[-1]:
            wrappers = frozenset(i for i in doubtful if 2 * held[i] > held[-1])
            break
    for i in range(len(elements) - 1, -1, -1):
        words[elements[i].parent] += words[i]
        links[elements[i].parent] += links[i]
    return wrappers, frozenset(i for i in doubtful if 2 * links[i] >= words[i])


def _end_open(stack: list[Element], tag: str) -> None:
    """Elements that the start of another one ends: paragraphs before blocks, and rows of their own kind."""
    if tag in BLOCK:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag == "p":
                del stack[i:]
                break
            if stack[i].tag in BLOCK:
                break
    if tag in ENDS:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag in ENDS[tag]:
                del stack[i:]
                if tag != "tr":
                    break
            elif stack[i].tag in ("ul", "ol", "dl", "table", "select", "menu") or stack[i].tag in CONTENT:
                break


def _opened(parent: Open, element: Element, sure: bool, linked: bool, weights: Weights) -> Open:
    tag, words = element.tag, element.words
    # the evidence of other marks is void for a wrapper
    marks = (element.whole - MIXED_WORDS | (element.whole | element.compound if sure else frozenset())) & MARKS
    if parent.content:
        # the page's own headers are aside, an article's are not
        marks -= HEADER_WORDS
    labels = words & CONTENT_WORDS if tag in BLOCK else frozenset()
    strong = tag in CONTENT or (len(labels) > 1 or bool(labels & {"article", "articlebody"})) and not marks
    content = parent.content or tag in CONTENT or bool(labels) and not marks
    purpose, apart = parent.purpose, parent.apart
    if strong and purpose < 0:
        purpose *= _THROUGH
    names = [f".{w}" for w in (words - MARKS - (CONTENT_WORDS - labels)) | marks]
    void = "form" if not sure else "header" if parent.content else ""
    own = [weights.purpose.get(key, 0.0) for key in (tag, *names) if key != void]
    if linked:
        # a block of links is what a mixed name says, rather than text
        own += [-3.0 for w in marks & MIXED_WORDS]
    apart += sum(weights.purpose.get(f".{w}", 0.0) for w in marks & APART_WORDS)
    purpose += sum(own) - sum(weights.purpose.get(f".{w}", 0.0) for w in marks & APART_WORDS)
    hard = (parent.hard and tag not in CONTENT) or tag in HARD
    # what a name does not mark does not speak against the element either; of an article the learned scores decide
    shown = words if tag == "article" else words - (MARKS - marks)
    return Open(tag, parent.keys | {tag} | {f".{w}" for w in shown}, hard, max(_LEAST, min(_MOST, purpose)), apart, content)


class Weights(NamedTuple):
    """Evidence of the keys that enclose a word, costs of tags, and evidence of what elements are for."""

    words: dict[str, float]
    tags: dict[str, float]
    purpose: dict[str, float] = PURPOSE

    def word(self, keys: frozenset[str]) -> float:
        return max(-4.0, min(4.0, 1.0 + sum(self.words.get(k, 0.0) for k in keys)))

    def tag(self, keys: frozenset[str]) -> float:
        return min((self.tags.get(k, -0.5) for k in keys), default=-0.5)


# Weights before any page is seen.
_PRIOR_WORDS = {"p": 1.0, "article": 4.0, "main": 4.0, ".articlebody": 4.0, "h1": 1.0, "blockquote": 1.0, "pre": 1.0, "a": -2.0, "li": -1.0, "header": -1.0}
#: Words after which what was seen of a name counts as much as what was guessed.
GUESS_WORDS = 200


def learned(counts: dict[tuple[str, str, bool], int]) -> Weights:
    """Weights from how often each key encloses words, and each tag stands, inside and outside of labelled content."""
    words, tags, purpose = dict(_PRIOR_WORDS), {}, dict(PURPOSE)
    for kind, weights in (("word", words), ("tag", tags)):
        inside, outside = (sum(n for (k, _, i), n in counts.items() if k == kind and i is side) for side in (True, False))
        for key in {k for t, k, _ in counts if t == kind}:
            a, b = counts.get((kind, key, True), 0), counts.get((kind, key, False), 0)
            if a + b < LEAST_SEEN:
                continue
            odds = math.log((a + 1) / (inside + 2)) - math.log((b + 1) / (outside + 2))
            if kind == "tag":
                weights[key] = max(-8.0, min(-0.1, odds - 0.5))
            elif key not in CONTENT:
                weights[key] = max(-2.0, min(2.0, odds))
                if key.startswith("."):
                    # adverts and the like also stand within an article, so that speaks little for them
                    guess = PURPOSE.get(key, 0.0)
                    seen = max(-8.0, min(2.0 if guess <= -6 else 8.0, odds))
                    purpose[key] = guess + seen * (a + b) / (a + b + GUESS_WORDS)
    return Weights(words, tags, purpose)


def labels_of(html: str) -> Counter:
    """What a page teaches: only pages with exactly one element marked as the content do."""
    out: Counter = Counter()
    if len(re.findall(r"<(?:article|main)\b", html, re.IGNORECASE)) != 1:
        return out
    for piece in pieces(html):
        inside = not CONTENT.isdisjoint(piece.keys) if piece.text is not None else piece.content and not piece.aside
        if piece.text is None:
            out.update(("tag", k, inside) for k in piece.keys)
        else:
            n = len(piece.text.split())
            for k in piece.keys - {"html", "body"}:
                out["word", k, inside] += n
    return out


def fit(pages: DataFrame, sample: int = LABELLED_PAGES) -> Weights:
    """Learn from about ``sample`` pages, chosen by a hash of their ids; pages without marked content teach nothing.

    The pages are counted in the tasks; the driver gets one row per key.
    """
    ids = pages.where("html IS NOT NULL")
    n = ids.count()
    chosen = ids.where(F.expr("pmod(xxhash64(page_id, url), 1000000007)") < int(1_000_000_007 * min(1.0, sample / max(n, 1)))).select("html")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total: Counter = Counter()
            for html in batch["html"]:
                total.update(labels_of(html))
            yield pd.DataFrame([(*key, n) for key, n in total.items()], columns=["kind", "key", "inside", "n"])

    rows = chosen.mapInPandas(counted, "kind string, key string, inside boolean, n bigint").groupBy("kind", "key", "inside").agg(F.sum("n").alias("n"))
    return learned({(r.kind, r.key, r.inside): r.n for r in rows.where("n > 0").collect()})


def main_text(html: str, weights: Weights) -> str:
    """The text of the best region: blocks in page order, joined by an empty line."""
    parts = pieces(html, weights)
    best, first, last = 0.0, 0, 0
    total, start = 0.0, 0
    known: dict[frozenset[str], float] = {}
    for i, piece in enumerate(parts):
        if piece.text is None:
            score = weights.tag(piece.keys) if not piece.aside else -0.5
        elif piece.aside or piece.text.isspace():
            score = 0.0  # left out of the region's text anyway
        else:
            if piece.keys not in known:
                known[piece.keys] = weights.word(piece.keys)
            score = known[piece.keys] * len(piece.text.split())
        total += score
        if total > best:
            best, first, last = total, start, i + 1
        if total <= 0:
            total, start = 0.0, i + 1
    blocks: list[list[str]] = []
    block = -1
    for piece in parts[first:last]:
        if piece.text is not None and not piece.aside:
            if piece.block != block:
                blocks.append([])
                block = piece.block
            blocks[-1].append(piece.text)
    texts = (" ".join(unescape("".join(own)).split()) for own in blocks)
    return "\n\n".join(t for t in texts if t)


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every row of ``pages`` (``page_id``, ``url``, ``html``).

    A null or empty page, and one without any scoring region, has the empty text.  Null and repeated ids are
    kept, every row for itself; other columns are ignored; an empty table gives no rows.  Pages are read
    whole; nothing is shuffled.
    """

    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(html, weights) if html else "" for html in batch], dtype=object)

    texts = pages.select("page_id", "url", F.pandas_udf(extracted, "string")("html").alias("text"))
    return texts.select(F.col("page_id").cast("bigint"), "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
