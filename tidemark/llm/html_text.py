"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with its path of elements from the root. Per path, text
outside links and punctuation are aggregated per block, smoothed over the paths next to it and
fused into one ratio; against the page's best path that gives a score between 0 and 1. What an
element or a whole class name says about its content weighs the score, parts of class names weigh
it less, and a path is content if its weighed score reaches the threshold. So a page without any
telling names goes by the ratios alone, and a name alone neither saves nor loses a path.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)([^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.DOTALL,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=\s|=|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
_WORD = re.compile(r"[a-z]+|[0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")

# Element kinds of HTML, and names that pages give to what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template svg math iframe object canvas audio video select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6".split())
BOILERPLATE = frozenset("head nav header footer aside button menu dialog".split())
FORMS = frozenset(["form", "fieldset"])
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies disqus footer form header masthead menu modal nav navbar navigation newsletter notice notices popup "
    "promo promotion related reply replies respond search share sharing sidebar sidebars social sponsor sponsored "
    "subscribe toolbar widget widgets alert disclaimer gdpr".split()
)
CONTENT = frozenset(["article", "main"])
CONTENT_NAMES = frozenset("article articlebody content entry main post story maincontent".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SAME_CLOSES = {"li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "th", "th": "td", "option": "option"}

THRESHOLD = 0.35
PUNCTUATION_WEIGHT = 10.0
LINK_WEIGHT = 0.01  # of a character inside a link
SHORT = 10  # characters outside links
CURVE = 0.5  # power of a path's ratio to the best one
# What an element or whole name, and a part of a name, does to the score of what it holds.
CONTENT_WEIGHTS, BOILERPLATE_WEIGHTS = (8.0, 2.0), (1 / 32, 1 / 4)
# What lies outside, where a page has content by a whole name (1) or an article or main element (2).
OUTSIDE_WEIGHTS = (1.0, 1 / 4, 1 / 16)
WHOLE_PAGE = 0.8  # a form with so much of a page's text is the page


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int
    weight: float
    inside: int  # 2 in an article or main element, 1 in one named so, else 0
    in_form: bool


@dataclass
class Open:
    """An element that is open, with what it and those around it say about its content."""

    name: str
    label: str
    content: float = 1.0
    boilerplate: float = 1.0
    inside: int = 0
    in_form: bool = False
    hidden: bool = False


def blocks(page: str) -> list[Block]:
    """Text blocks in page order, each with its path of block elements from the root."""
    out: list[Block] = []
    stack: list[Open] = []
    parts: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        top = stack[-1] if stack else Open("", "")
        if text and not top.hidden:
            path = tuple(one.label for one in stack if one.name not in INLINE)
            out.append(Block(path, text, linked, top.content * top.boilerplate, top.inside, top.in_form))
        parts.clear()
        linked = 0

    def close(name: str) -> None:
        nonlocal links
        while stack:
            gone = stack.pop().name
            links -= gone == "a"
            if gone == name:
                return

    at = 0
    while at < len(page):
        tag = _MARKUP.search(page, at)
        text = page[at : tag.start()] if tag else page[at:]
        if text:
            parts.append(text)
            linked += len(text) if links > 0 else 0
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        ends, attributes = bool(tag[1] or tag[4]), tag[3] or tag[6] or ""
        if name not in INLINE:
            flush()
        elif name in ("br", "wbr", "img"):
            parts.append(" " if name == "br" else "")
        if name in VOID:
            continue
        if ends:
            if any(one.name == name for one in stack):
                close(name)
            continue
        if name in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{name}(?=[\s>/])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
            continue
        if attributes.endswith("/") and name not in INLINE:
            continue
        if name not in INLINE:
            _close_implied(stack, name, close)
        _push(stack, name, attributes)
        links += name == "a"
    flush()
    return out


def _close_implied(stack: list[Open], name: str, close) -> None:
    for n in range(len(stack) - 1, -1, -1):
        open_name = stack[n].name
        if open_name in CLOSED_BY_BLOCK or open_name == name and name in SAME_CLOSES or SAME_CLOSES.get(name) == open_name:
            close(open_name)
            return
        if open_name not in INLINE:
            return


def _push(stack: list[Open], name: str, attributes: str) -> None:
    around = stack[-1] if stack else Open("", "")
    one = Open(name, name, around.content, around.boilerplate, around.inside, around.in_form, around.hidden)
    one.hidden |= bool(attributes and _HIDDEN.search(attributes))
    if name not in INLINE:
        named = [m[1] or m[2] or m[3] or "" for m in _NAMES.finditer(attributes)] if attributes else []
        whole = {w for names in named for w in names.lower().split()}
        parts = [w for names in named for w in _WORD.findall(names.lower())]
        if name not in ("html", "body"):
            kind = "" if name == "header" and around.content > 1 else name
            one.content = max(one.content, _weight(kind, whole, parts, CONTENT, CONTENT_NAMES, CONTENT_WEIGHTS))
            # Within an article, a name is taken as a whole only: it may speak of the article's own parts.
            some = parts if around.content < CONTENT_WEIGHTS[0] else []
            one.boilerplate = min(
                one.boilerplate, _weight(kind, whole, some, BOILERPLATE, BOILERPLATE_NAMES, BOILERPLATE_WEIGHTS)
            )
            one.inside = max(one.inside, 2 if name in CONTENT else 1 if not CONTENT_NAMES.isdisjoint(whole) else 0)
            one.in_form |= name in FORMS
        one.label = ".".join([name, *parts])
    stack.append(one)


def _weight(
    element: str, whole: set[str], parts: list[str], elements: frozenset, names: frozenset, weights: tuple[float, float]
) -> float:
    if element in elements or not names.isdisjoint(whole):
        return weights[0]
    return weights[1] if parts and not names.isdisjoint(parts) else 1.0


def ratios(found: list[Block]) -> tuple[dict[tuple[str, ...], int], np.ndarray]:
    """The paths in order of appearance, and the fused ratio of each."""
    order: dict[tuple[str, ...], int] = {}
    for b in found:
        order.setdefault(b.path, len(order))
    size, marks, n = (np.zeros(len(order)) for _ in range(3))
    for b in found:
        i = order[b.path]
        plain = max(0, len(b.text) - b.linked)
        size[i] += plain + LINK_WEIGHT * (len(b.text) - plain)
        marks[i] += len(_PUNCTUATION.findall(b.text)) * (b.linked < len(b.text) / 2)
        n[i] += 1
    # A path of links, or of a few characters, takes nothing from its neighbours.
    own, around = size / n, _smooth(size / n)
    length = np.where(own < SHORT, np.minimum(own, around), around)
    return order, length * (1 + PUNCTUATION_WEIGHT * _smooth(marks / n) / (1 + around))


def scores(found: list[Block]) -> tuple[dict[tuple[str, ...], int], np.ndarray]:
    """The paths in order of appearance, and the weighed score of each.

    Ratios are taken against the best path that nothing speaks against, or the best of all; a path
    beside a named article can so have more than 1. A form that holds nearly all text of a page is no form.
    """
    order, ratio = ratios(found)
    total = sum(len(b.text) for b in found)
    forms_count = sum(len(b.text) for b in found if b.in_form) < WHOLE_PAGE * total
    named = max(b.inside for b in found)
    weight = np.zeros(len(order))
    for b in found:
        here = b.weight * (BOILERPLATE_WEIGHTS[0] if b.in_form and forms_count else 1.0)
        here *= OUTSIDE_WEIGHTS[named] if b.inside < named else 1.0
        weight[order[b.path]] = max(weight[order[b.path]], here)
    fair = ratio[weight >= 1]
    best = fair.max() if fair.size else ratio.max()
    return order, (ratio / best) ** CURVE * weight


def select(found: list[Block], threshold: float = THRESHOLD) -> list[Block]:
    """Blocks on paths whose score reaches ``threshold``; headings go with what they head.

    A heading heads the paths beside it, and the next block that is none, if no name speaks against it.
    """
    if not found:
        return []
    order, score = scores(found)
    good = score >= threshold
    kept_parents = {path[:-1] for path, i in order.items() if good[i]}
    chosen, heads = [], False
    for b in reversed(found):
        own = bool(good[order[b.path]])
        if b.path and b.path[-1].split(".")[0] in HEADINGS:
            own |= b.path[:-1] in kept_parents or heads and b.weight >= 1
        else:
            heads = own
        if own:
            chosen.append(b)
    return chosen[::-1]


def _smooth(values: np.ndarray) -> np.ndarray:
    padded = np.pad(values, 1, mode="edge")
    return (padded[:-2] + 6 * padded[1:-1] + padded[2:]) / 8


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    """Main text: blocks joined by a blank line; empty for a null or empty page."""
    return "\n\n".join(b.text for b in select(blocks(page or ""), threshold))


def extract(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages(page_id, url, html)``.

    Character references are decoded, white space inside a block becomes one space. Broken or
    cut markup is read as far as it goes. Repeated rows stay; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), threshold) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array((t.encode("utf-8", "replace").decode() for t in texts), pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
