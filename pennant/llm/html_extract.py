"""Main text of web pages by minimum-cut labelling.

A page is a row of text blocks. A logistic classifier gives each block its log-odds of being content; they become
capacities to the two terminals, none above ``MOST_ODDS``. Neighbouring blocks, and blocks near each other in the DOM, are
joined by smoothness edges. The minimum cut, found by max-flow, separates content from boilerplate: a block that looks
one way among blocks that look the other way follows them.

The classifier is fitted on up to SAMPLE_PAGES pages of at most SAMPLE_BYTES each, picked by hash. Where a page says itself
what a block is (inside an article, inside a menu or footer), that is the label; half of the training rows do not show it, so
that text, links and punctuation get weights of their own for pages that say nothing. Without such pages the prior holds.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element and class names of HTML pages.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td "
    "tfoot th thead title tr ul video audio iframe".split()
)
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg math object canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER_TAGS = frozenset("nav footer aside form menu header button select option dialog head label".split())
CONTENT_TAGS = frozenset(("article", "main"))
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner sidebar aside menu "
    "nav navbar navigation breadcrumb breadcrumbs footer foot header masthead topbar notice notices cookie cookies consent gdpr alert "
    "popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended recommendations "
    "widget comments comment commentlist disqus reply replies respond discussion copyright legal toolbar pagination pager skip hidden "
    "form contentinfo complementary dialog".split()
)
# Inside an article these only name its parts; a container of reader comments is never taken for a page's frame.
PART_WORDS = frozenset("header head heading title foot form text notice search".split())
READER_WORDS = frozenset("comment comments commentlist disqus reply replies respond".split())
CONTENT_WORDS = frozenset("article content main post entry story text".split())

FEATURES = ("bias", "in_content", "boiler_tag", "boiler_word", "content_word", "hidden", "link_text", "paragraph", "heading", "list_item", "division", "sentence", "long")
DIVISIONS = frozenset(("", "div", "section", "td", "center", "body"))
SAID = slice(1, 6)  # features that say what a block is
# Log-odds that hold before any page is seen; the fit moves them.
PRIOR = np.asarray([-0.5, 2.5, -4.0, -4.0, 0.8, -4.0, -2.0, 0.6, 0.4, -0.4, -0.2, 0.6, 1.0])
SAMPLE_PAGES, SAMPLE_BYTES = 300, 50_000
MOST_ODDS = 4.0
ADJACENT, SIBLING = 0.5, 0.7
WRAPPER_SHARE = 2 / 3  # of a page's text outside links

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)((?:[^>\"'a-zA-Z]++|[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


@dataclass(slots=True)
class Block:
    text: list[str] = field(default_factory=list)
    link: int = 0
    size: int = 0
    tag: str = ""
    element: int = 0
    apart: int = 0  # steps in the DOM from the block before


@dataclass(slots=True)
class Element:
    tag: str
    parent: int
    depth: int
    words: frozenset[str] = frozenset()
    hidden: bool = False
    # of the element and all below it
    text: int = 0
    landmarks: int = 0
    headings: int = 0
    paragraphs: int = 0
    # passed down
    in_content: bool = False
    boiler_tag: bool = False
    boiler_word: bool = False
    content_word: bool = False


def _element(tag: str, attributes: str, parent: int, depth: int) -> Element:
    """Class, id and role words of an element, and whether it is hidden; other attributes say nothing."""
    words, hidden = frozenset(), False
    if attributes and tag not in ("html", "body"):
        given = {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTRIBUTE.finditer(attributes)}
        words = frozenset(w.lower() for k in ("class", "id", "role") if k in given for w in _WORD.findall(given[k]))
        hidden = "hidden" in given or given.get("aria-hidden", "").lower() == "true" or bool(_NO_DISPLAY.search(given.get("style", "")))
    return Element(tag, parent, depth, words, hidden)


def parse(page: str) -> tuple[list[Block], list[Element]]:
    """Text blocks in page order, and the elements they are in; element 0 is the page.

    Unclosed and crossed elements are taken as browsers take them, near enough. Work is linear in the page's length, however
    deep it is: an element knows its parent, and steps between blocks are counted as elements open and close.
    """
    out: list[Block] = []
    elements = [Element("", -1, 0)]
    stack, opened = [0], Counter()
    now = Block()
    links = lowest = last_depth = 0
    leaf = ""

    def flush() -> None:
        nonlocal now, lowest, last_depth
        if now.size:
            depth = elements[stack[-1]].depth
            low = min(lowest, depth)
            now.tag, now.element, now.apart = leaf, stack[-1], last_depth + depth - 2 * low
            lowest = last_depth = depth
            out.append(now)
        now = Block()

    def close() -> str:
        nonlocal lowest
        e = elements[stack.pop()]
        opened[e.tag] -= 1
        lowest = min(lowest, e.depth - 1)
        return e.tag

    def text(raw: str) -> None:
        if raw:
            now.text.append(raw)
            if not raw.isspace():
                now.size += len(raw)
                now.link += len(raw) if links else 0

    at, end = 0, len(page)
    while at < end:
        mark = page.find("<", at)
        if mark < 0:
            text(page[at:])
            break
        text(page[at:mark])
        m = _TOKEN.match(page, mark)
        if m is None:  # a plain less-than sign
            text("<")
            at = mark + 1
            continue
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = (m[1] if m[2] else m[4]) == "/"
        if tag in BLOCKS:
            flush()
            leaf = "" if closing else tag
        elif tag == "br":
            now.text.append(" ")
        if tag == "a":
            links = 0 if closing else 1
        if closing:
            if tag in BLOCKS and opened[tag] > 0:
                while close() != tag:
                    pass
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if tag in BLOCKS and tag not in VOID and not (m[3] or m[6] or "").endswith("/"):
            top = elements[stack[-1]].tag
            if top in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and top in (tag, "p"):
                close()
            if tag == "body" and elements[stack[-1]].tag == "head":
                close()
            elements.append(_element(tag, m[3] or m[6] or "", stack[-1], elements[stack[-1]].depth + 1))
            stack.append(len(elements) - 1)
            opened[tag] += 1
            if tag in ("div", "section", "article", "main", "nav", "ul", "ol"):
                links = 0  # an unclosed link does not reach into the next part
    flush()
    _describe(out, elements)
    return out, elements


def _describe(row: list[Block], elements: list[Element]) -> None:
    """What elements hold, from the inside out, and what they say, from the outside in.

    An element that holds all of a page's articles and most of its text is its frame: words that name a layout, and a
    form around the whole page, do not make it boilerplate.
    """
    for b in row:
        elements[b.element].text += b.size - b.link
    for e in reversed(elements[1:]):
        up = elements[e.parent]
        up.text += e.text
        up.landmarks += e.landmarks + (e.tag in CONTENT_TAGS)
        up.headings += e.headings + (e.tag == "h1")
        up.paragraphs += e.paragraphs + (e.tag == "p")
    page = elements[0]
    for e in elements[1:]:
        up = elements[e.parent]
        holds = e.landmarks == page.landmarks if page.landmarks else e.headings > 0 or e.paragraphs > 2
        frame = holds and e.text >= WRAPPER_SHARE * page.text and e.words.isdisjoint(READER_WORDS)
        article = e.tag in CONTENT_TAGS
        said = e.words - PART_WORDS if up.in_content else e.words
        named = not said.isdisjoint(READER_WORDS if article else BOILER_WORDS)
        boiler = e.tag in BOILER_TAGS and not (e.tag == "header" and up.in_content) and not (e.tag == "form" and frame)
        e.in_content = up.in_content or article
        e.boiler_tag = up.boiler_tag or boiler
        e.boiler_word = up.boiler_word or (named and not frame)
        e.content_word = up.content_word or not e.words.isdisjoint(CONTENT_WORDS)
        e.hidden = up.hidden or e.hidden


def features(row: list[Block], elements: list[Element]) -> np.ndarray:
    out = np.zeros((len(row), len(FEATURES)))
    for x, b in zip(out, row):
        e = elements[b.element]
        words = sum(t.count(" ") + 1 for t in b.text)
        out_of_it = e.boiler_tag or e.boiler_word or e.hidden  # also inside an article
        x[:] = (
            1.0, e.in_content and not out_of_it, e.boiler_tag, e.boiler_word, e.content_word and not out_of_it, e.hidden, b.link / b.size, b.tag == "p", b.tag[:1] == "h" and b.tag[1:].isdigit(),
            b.tag == "li", b.tag in DIVISIONS, any(c in ".!?。" for t in b.text for c in t[-3:]), min(words, 25) / 25,
        )
    return out


def fit(pages: list[str], steps: int = 300) -> np.ndarray:
    """Weights by gradient steps on the blocks that say what they are, with a Gaussian prior around PRIOR."""
    rows = [features(*parse(p)) for p in pages]
    x = np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))
    bad = (x[:, 2] > 0) | (x[:, 3] > 0) | (x[:, 5] > 0)
    known = bad | (x[:, 1] > 0)
    x, y = x[known], (~bad[known]).astype(float)
    if not len(x) or y.min() == y.max():
        return PRIOR.copy()
    blind = x.copy()
    blind[:, SAID] = 0.0
    x, y = np.concatenate([x, blind]), np.concatenate([y, y])
    cost = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    w = PRIOR.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 1.0 * (x.T @ (cost * (p - y)) + 0.02 * (w - PRIOR))
    return w


def edges(row: list[Block], elements: list[Element]) -> list[tuple[int, int, float]]:
    """Adjacent blocks, weaker with DOM distance, and blocks with the block before under the same parent."""
    out = []
    before: dict[int, int] = {}
    for i, b in enumerate(row):
        parent = elements[b.element].parent
        if i:
            out.append((i - 1, i, ADJACENT / (1 + max(0, b.apart - 2)) ** 2))
        if parent in before:
            out.append((before[parent], i, SIBLING))
        before[parent] = i
    return out


def min_cut(odds: list[float], joins: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of least cost: each node pays |odds| for the label against its sign, each edge its weight if cut.

    Nodes whose odds outweigh all their edges have their label for certain; they are taken out first and their edges
    become odds of their neighbours. Max-flow by blocking flows in level graphs settles the rest. A tie is boilerplate.
    """
    n = len(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in joins:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    left, label = list(odds), [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is None and abs(left[i]) >= sum(near[i].values()):
            label[i] = left[i] > 0
            for j, w in near[i].items():
                left[j] += w if label[i] else -w
                del near[j][i]
                queue.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        reached = _reached(rest, left, near)
        for i in rest:
            label[i] = i in reached
    return label


def _reached(rest: list[int], odds: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes on the source's side of the smallest minimum cut."""
    source, sink, small = -1, -2, 1e-12
    room: dict[int, dict[int, float]] = {i: dict(near[i]) for i in rest}
    room[source], room[sink] = {}, {}
    for i in rest:
        if odds[i] > 0:
            room[source][i], room[i][source] = odds[i], 0.0
        else:
            room[i][sink], room[sink][i] = -odds[i], 0.0
    while True:
        level, todo = {source: 0}, deque([source])
        while todo:
            i = todo.popleft()
            for j, w in room[i].items():
                if w > small and j not in level:
                    level[j] = level[i] + 1
                    todo.append(j)
        if sink not in level:
            return set(level)
        ahead = {i: [j for j in room[i] if level.get(j) == level[i] + 1] for i in level}
        path = [source]
        while path:
            i = path[-1]
            if i == sink:
                push = min(room[a][b] for a, b in zip(path, path[1:]))
                cut = len(path)
                for k in range(len(path) - 1, 0, -1):
                    a, b = path[k - 1], path[k]
                    room[a][b] -= push
                    room[b][a] = room[b].get(a, 0.0) + push
                    if room[a][b] <= small:
                        cut = k
                del path[cut:]
                continue
            while ahead[i] and room[i][ahead[i][-1]] <= small:
                ahead[i].pop()
            if ahead[i]:
                path.append(ahead[i][-1])
            else:  # nothing gets on from here any more
                path.pop()
                if path:
                    ahead[path[-1]].pop()


def labels(page: str, weights: np.ndarray) -> tuple[list[Block], np.ndarray, list[bool]]:
    """Blocks, their odds, and which ones the cut keeps."""
    row, elements = parse(page)
    odds = np.clip(features(row, elements) @ weights, -MOST_ODDS, MOST_ODDS) if row else np.zeros(0)
    return row, odds, min_cut(odds.tolist(), edges(row, elements))


def main_text(page: str | None, weights: np.ndarray = PRIOR) -> str:
    """Kept blocks, one a line. White space, ``[\\x20\\x09-\\x0D]`` and no other, becomes one space; no-break spaces stay."""
    row, _, keep = labels(page or "", weights)
    lines = (_SPACE.sub(" ", html.unescape("".join(b.text))).strip(" ") for b, k in zip(row, keep) if k)
    return "\n".join(x for x in lines if x)


def _sample(base: DataFrame) -> list[str]:
    """SAMPLE_PAGES different pages at most, of SAMPLE_BYTES at most each: those of smallest hash.

    A share of the hashes that gives some four times as many is kept before anything is sorted, so that what tasks send does not
    grow with their number; copies of one page are one.
    """
    parts = 1 << 30
    share = min(parts, -(-4 * SAMPLE_PAGES * parts // max(1, base.count())))
    some = base.select("html").where(F.octet_length("html").between(1, SAMPLE_BYTES) & (F.pmod(F.xxhash64("html"), F.lit(parts)) < share))
    return [r.html for r in some.distinct().orderBy(F.xxhash64("html"), "html").limit(SAMPLE_PAGES).collect()]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars per row of ``pages``; null html, and a page without content, give an empty text.

    Apart from the sample for the classifier, pages are independent: no shuffle, repeated rows repeat, other columns are
    not read. An empty table gives none.
    """
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    weights = fit(_sample(base))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, 500):
                part = b.slice(start, 500)
                out = [main_text(h, weights) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    schema = base.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return base.mapInArrow(run, schema)
