"""Main text of web pages: the maximum-scoring run of words and tags.

A page is a sequence of words and tags. Words weigh what labelled pages say of the element they
stand in, tags weigh against a run; a linear scan finds the contiguous run of highest sum. Pages
that mark their article (one ``article`` or ``main`` element) are the labelled ones; what is learned
holds for pages that mark nothing. Weights choose the run and nothing else: it is completed to whole
blocks, only text of menus, forms, notices and the like is left out of it, and what remains is given
block by block.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from functools import lru_cache
from math import log
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetflow.llm.common import chunks, map_arrow

#: Labelled pages that the weights are learned from.
SAMPLE_PAGES = 2000

#: Elements that begin and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu "
    "nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements without an end, and elements whose content is no text of the page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(
    "script style textarea title noscript template iframe noembed xmp svg select "
    "annotation annotation-xml".split()  # a formula once more, in another notation
)
#: Elements, and words of class, id and role, that mark what is not the article.
NOISE_ELEMENTS = frozenset("nav footer aside form menu dialog button fieldset search".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment commentform "
    "commentlist comments complementary consent contentinfo cookie cookies dialog disqus footer gdpr menu "
    "modal nav navbar navigation newsletter notice notices pager pagination popup promo promos promotion "
    "related replies respond search share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar widget widgets".split()
)
#: Beginnings of such words, words that are so only outside a marked article, words
#: that name the remarks of readers, and words that change nothing beside one of these.
NOISE_STEMS = ("advert", "breadcrumb", "cookie", "navigation", "newsletter", "sidebar", "sponsor")
OUTER_NOISE_WORDS = frozenset("header masthead topbar".split())
REMARKS = frozenset("comment commentform commentlist comments disqus replies respond".split())
NEUTRAL = frozenset(
    "area bar block body bottom box button buttons col column container fixed form global group icons "
    "inner items left link links list main overlay page panel post posts region right row section site "
    "small sticky top unit wrap wrapper".split()
)
#: Elements that can be an insertion in a marked article by their name, and controls.
INSERTIONS = frozenset("center details div ol section ul".split())
CONTROLS = frozenset("input select textarea button".split())

#: A form of more words than this is no form to fill in; an insertion in an article holds at most
#: this share of its words.
FORM_WORDS = 100
INSERTED_SHARE = 1 / 3

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"""|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*)(?:>|\Z)|(?P<text>[^<]+|<)""",
    re.S,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[^a-z0-9]+")


class Token(NamedTuple):
    """A tag (``words`` 0) or a text, the element it counts for, and its block."""

    key: str
    words: int
    text: str
    block: int
    noise: bool
    marked: bool


class Element:
    """An element of the page and what is known of it once the page is read."""

    __slots__ = ("name", "parent", "names", "words", "controls", "noise", "key", "marked")

    def __init__(self, name: str, parent: Element | None, names: list[str]):
        self.name, self.parent, self.names = name, parent, names
        self.words = self.controls = 0
        self.noise = self.marked = False
        self.key = ""


@lru_cache(100_000)
def named_noise(label: str, outer: bool) -> tuple[bool, bool]:
    """Whether a class, id or role names an insertion, and whether the remarks of readers.

    A name counts as a whole: ``sidebar``, ``site-footer`` and ``share-buttons`` do, ``no-sidebar``,
    ``ad-free`` and ``notice-board`` do not.
    """
    noise = remarks = False
    for name in label.lower().split():
        parts = [p for p in _PART.split(name) if p]
        hits = [
            p in NOISE_WORDS or p.startswith(NOISE_STEMS) or (outer and p in OUTER_NOISE_WORDS)
            for p in parts
        ]
        others = (p for p, hit in zip(parts, hits, strict=True) if not hit)
        if any(hits) and all(p in NEUTRAL or p.isdigit() for p in others):
            noise = True
            remarks = remarks or not REMARKS.isdisjoint(parts)
    return noise, remarks


def _read(page: str) -> tuple[list[Element], list[tuple]]:
    """Elements of a page in the order they open, and its raw tokens with the element they are in.

    Unclosed elements end where an outer one does. Every step is paid for by a character or an
    element, so the work grows with the page however it is made.
    """
    elements: list[Element] = []
    found_tokens: list[tuple] = []  # element, prefix of the key, words, text, block
    stack: list[Element] = []
    opened: Counter[str] = Counter()
    place, block = 0, 0
    formula = False  # tags inside of math count for nothing, its text is text

    def drop(at: int) -> None:
        opened.subtract(e.name for e in stack[at:])
        del stack[at:]

    def add(name: str, names: list[str]) -> Element:
        elements.append(Element(name, stack[-1] if stack else None, names))
        return elements[-1]

    while found := _TOKEN.match(page, place):
        place = found.end()
        text = found["text"]
        if text is not None:
            words = len(text.split())
            if stack:
                stack[-1].words += words
            found_tokens.append((stack[-1] if stack else None, "text ", words, text, block))
            continue
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        if found["end"] or found["end2"]:
            inner = formula and name not in BLOCKS
            closed: Element | str = name
            if opened[name] > 0:
                at = len(stack) - 1
                while stack[at].name != name:
                    at -= 1
                closed = stack[at]
                formula = formula and all(e.name != "math" for e in stack[at:])
                drop(at)
            if name in BLOCKS:
                block += 1
            if not inner:
                found_tokens.append((closed, "/", 0, "", block))
            continue
        rest = found["rest"] or found["rest2"] or ""
        alone = rest.rstrip().endswith("/")
        if name in CONTROLS and stack:
            stack[-1].controls += 1
        if name in RAW:
            if not alone or name in ("script", "style", "textarea", "title"):
                close = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, place)
                place = close.end() if close else len(page)
            if not formula:
                found_tokens.append((name, "", 0, "", block))
            continue
        if formula and name in BLOCKS:  # a block ends a formula
            at = len(stack) - 1
            while stack[at].name != "math":
                at -= 1
            drop(at)
            formula = False
        if (formula and name != "br") or name == "math":
            if not alone and name not in VOID:
                stack.append(add(name, []))
                opened[name] += 1
                formula = True
            continue
        if name in BLOCKS:
            block += 1
            if stack and name == stack[-1].name and name in _REPEATED:
                drop(len(stack) - 1)
            while name != "p" and stack and stack[-1].name == "p":
                drop(len(stack) - 1)
        if name == "br":
            found_tokens.append(("br", "", 0, " ", block))
            continue
        element = add(name, ["".join(m[1:]) for m in _NAMES.findall(rest)])
        found_tokens.append((element, "", 0, "", block))
        if name not in VOID:
            stack.append(element)
            opened[name] += 1
    return elements, found_tokens


#: Elements that end where the next of their kind begins.
_REPEATED = frozenset("p li dt dd tr td th option".split())


def _judge(elements: list[Element], page_words: int) -> None:
    """Which elements are no part of the text, and the key each counts for.

    The article is the ``article`` or ``main`` element of most words. What it stands in is never
    noise; without one, what holds more than half of the words of the page is not, whatever its
    name says, unless it names remarks of readers. A form is noise if it has controls and few words.
    In the article, names count on containers of few of its words only.
    """
    for element in reversed(elements):
        if element.parent:
            element.parent.words += element.words
            element.parent.controls += element.controls
    remarked: set[int] = set()
    for element in elements:
        if id(element.parent) in remarked or any(
            named_noise(label, False)[1] for label in element.names
        ):
            remarked.add(id(element))
    marks = [
        e for e in elements
        if e.words and (e.name == "main" or (e.name == "article" and id(e) not in remarked))
    ]
    article = max(marks, key=lambda e: e.words, default=None)
    safe, around = set(), article
    while around:
        safe.add(id(around))
        around = around.parent
    for element in elements:
        name, parent = element.name, element.parent
        inside = bool(parent) and parent.marked
        inherited = bool(parent) and parent.noise
        judged = [named_noise(label, not inside) for label in element.names]
        remarks = any(r for _, r in judged)
        noise = any(n for n, _ in judged)
        if name == "form":
            noise = noise or (element.controls > 0 and element.words <= FORM_WORDS)
        if inside and not remarks and name != "form":
            noise = noise and name in INSERTIONS and element.words <= INSERTED_SHARE * article.words
        elif not article and not remarks:
            noise = noise and 2 * element.words <= page_words
        if (name in NOISE_ELEMENTS and name != "form") or (name == "header" and not inside):
            noise = True
        noise = noise and name not in ("body", "html", "main") and id(element) not in safe
        if name == "article" and not remarks:
            noise = False
        element.noise = noise or inherited
        parts = sorted({p for label in element.names for p in _PART.split(label.lower()) if p})
        element.key = name + "".join(f".{p}" for p in parts[:1])
        if inherited or (name not in BLOCKS and name != "a" and not noise):
            element.key = parent.key if parent else ""  # of inline elements only links count
        marks_it = name in ("article", "main") and not element.noise
        element.marked = marks_it or inside


def tokens(page: str) -> list[Token]:
    """Tags and texts of a page in order, with what their elements say of them."""
    elements, found = _read(page)
    _judge(elements, sum(words for _, _, words, _, _ in found))
    result = []
    for where, prefix, words, text, block in found:
        if isinstance(where, Element):
            own = where.key or (where.name if prefix != "text " else "")
            after = where.parent.marked if prefix == "/" and where.parent else where.marked
            if prefix == "/" and not where.parent:
                after = False
            result.append(Token(prefix + own, words, text, block, where.noise, after))
        else:
            result.append(Token(prefix + (where or ""), words, text, block, False, False))
    return result


def is_labelled(found: list[Token]) -> bool:
    """Whether the page marks one article that has words, and has words outside it."""
    opened = sum(t.words == 0 and t.key.split(".")[0] in ("article", "main") for t in found)
    inside = sum(t.words for t in found if t.marked)
    return opened == 1 and 0 < inside < sum(t.words for t in found)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, "html"):
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for page in chunk.column("html").to_pylist():
            found = tokens(page or "")
            if is_labelled(found):
                for t in found:
                    if t.words or not t.key.startswith("text "):
                        counts[t.marked and not t.noise][t.key] += max(t.words, 1)
        keys = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string())] + [pa.array([c[k] for k in keys], pa.int64()) for c in counts],
            ["key", "outside", "inside"],
        )


#: Keys that occur less often in the sample have the weights of unknown ones.
LEAST_SEEN = 20


class Weights:
    """What a word in an element, and a tag, weighs for a run of main text."""

    WORD, NOISE_WORD, TAG, MOST_AGAINST = 1.0, -1.0, -0.3, 3.0

    def __init__(self, counts: Mapping[str, tuple[int, int]]):
        self.known = {}
        for text in (True, False):
            rows = {k: c for k, c in counts.items() if k.startswith("text ") == text}
            outside, inside = (sum(c[i] for c in rows.values()) + 2 for i in (0, 1))
            for key, (out, own) in rows.items():
                weight = log((own + 1) / inside) - log((out + 1) / outside)
                if out + own < LEAST_SEEN:
                    continue
                # words for or against, tags never for
                self.known[key] = max(min(weight, 3.0), -3.0) if text else max(min(-0.1, weight), -3.0)

    def of(self, token: Token) -> float:
        if not token.words and token.key.startswith("text "):
            return 0.0
        if token.noise and token.marked:
            return 0.0  # it is left out, and an insertion in an article does not part it
        if token.words:
            usual = self.NOISE_WORD if token.noise else self.known.get(token.key, self.WORD)
            usual = min(usual, -0.1) if token.noise else usual
            # what is left out anyway parts a text only where little stands on one side of it
            return max(token.words * usual, -self.MOST_AGAINST) if usual < 0 else token.words * usual
        return self.known.get(token.key, self.TAG)


def best_run(weights: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous run of highest sum, the first and longest of equal ones."""
    best = total = 0.0
    begin = end = start = 0
    for i, weight in enumerate(weights):
        if total < 0:
            total, start = 0.0, i
        total += weight
        if total > best or (total == best and start == begin and best > 0):
            best, begin, end = total, start, i + 1
    return begin, end


def main_text(page: str | None, weights: Weights) -> str:
    """The blocks of main text, one to a line; empty if nothing on the page speaks for itself."""
    found = tokens(page or "")
    begin, end = best_run([weights.of(t) for t in found])
    said = [t.block for t in found[begin:end] if t.words and not t.noise]
    if said:  # what stands in one block with a text of the run belongs to it, links too
        while begin and found[begin - 1].block == said[0]:
            begin -= 1
        while end < len(found) and found[end].block == said[-1]:
            end += 1
    blocks: dict[int, list[str]] = {}
    for token in found[begin:end]:
        if token.text and not token.noise:
            blocks.setdefault(token.block, []).append(token.text)
    lines = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def train(pages: DataFrame, size: int = SAMPLE_PAGES) -> Weights:
    """Learn the weights from at most ``size`` pages, those with the smallest hash of their id."""
    ids = pages.select("page_id").filter("page_id IS NOT NULL").distinct()
    chosen = ids.orderBy(F.xxhash64("page_id"), "page_id").limit(size)
    sample = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id").select("html")
    rows = (
        map_arrow(sample, _count, "key string, outside long, inside long")
        .groupBy("key").agg(F.sum("outside").alias("outside"), F.sum("inside").alias("inside"))
        .filter(F.col("outside") + F.col("inside") >= LEAST_SEEN)
        .orderBy(F.desc(F.col("outside") + F.col("inside")), "key").limit(5000).collect()
    )
    return Weights({r["key"]: (r["outside"], r["inside"]) for r in rows})


def _extract(weights: Weights, names: list[str]):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "html"):
            texts = [main_text(page, weights) for page in chunk.column("html").to_pylist()]
            kept = [chunk.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [*names, "text", "n_chars"],
            )

    return extract


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    A null or empty page has the empty text, and so has one without main text. Broken markup is
    read as far as it goes. Rows that repeat give rows that repeat; nulls in other columns stay
    null; of equal runs the first counts. Further columns of ``pages`` play no part.
    """
    rows = pages.select("page_id", "url", "html")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return map_arrow(rows, _extract(weights, ["page_id", "url"]), schema)
