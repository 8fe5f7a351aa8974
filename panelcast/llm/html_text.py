"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block of text. A line weighs as much as its text outside links; lines of
menus, headers, footers, sidebars, notices, adverts, forms and reader comments weigh nothing, and where such a
part or the article itself begins or ends, blank lines keep the windows apart. The sums of weights over windows
of lines then rise from zero where a run of text begins (surge) and fall back to zero where it ends (dive). If the
page marks an article, every run inside it is kept; else the runs whose peak comes near the highest. All text
between surge and dive is kept, short lines included.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import bounded_batches, strings, text_or_empty

#: Lines in a window, and blank lines between parts that must not share one.
WINDOW = 3
#: Without an article: share of the highest peak that a run of lines must reach.
PEAK_SHARE = 0.25
#: Elements by role.
RAW = "script|style|noscript|template|textarea|title|svg|iframe|object"
BESIDE = frozenset("nav header footer aside form menu dialog button select head".split())
ARTICLE = frozenset("article main".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of a class, id or role that mark a part as no main text.
BESIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments commentlist consent contentinfo "
    "cookie cookies disclaimer disqus footer gdpr masthead menu menubar modal nav navbar navigation newsletter notice "
    "notices pager pagination paywall popup promo promotion related respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe subscription tags toolbar widget".split()
)
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.DOTALL | re.IGNORECASE,
)
NAMING = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")


@dataclass
class Lines:
    """Lines of text, with their weights and whether they lie in the article."""

    texts: list[str] = field(default_factory=list)
    weights: list[int] = field(default_factory=list)
    inside: list[bool] = field(default_factory=list)
    part: list[str] = field(default_factory=list)
    linked: int = 0

    def add(self, text: str, link: bool) -> None:
        self.part.append(text)
        if link:
            self.linked += len(text)

    def end(self, beside: bool, article: bool) -> None:
        if not self.part:
            return
        text = " ".join(unescape("".join(self.part)).split())
        linked, self.part, self.linked = self.linked, [], 0
        if text:
            self.texts.append(text)
            self.weights.append(0 if beside else len(text) if article else max(0, len(text) - linked))
            self.inside.append(article and not beside)

    def gap(self) -> None:
        self.texts += [""] * WINDOW
        self.weights += [0] * WINDOW
        self.inside += [False] * WINDOW


def _is_beside(name: str, attributes: str, article: bool) -> bool:
    if name in BESIDE:
        return not (article and name == "header")
    if not attributes or name in ARTICLE or name in ("body", "html"):
        return False
    words = {w for m in NAMING.finditer(attributes) for w in WORD.findall((m[1] or m[2] or m[3] or "").lower())}
    return not words.isdisjoint(BESIDE_WORDS) or (not article and "header" in words)


def lines_of(html: str) -> Lines:
    """Strip the markup. Elements that are never closed end where their parent, an article or the page ends."""
    out, stack, open_count = Lines(), [], Counter()
    beside = article = links = 0  # how many open elements are of the kind
    at = 0

    def close(entry) -> None:
        nonlocal beside, article, links
        name, was_beside = entry
        open_count[name] -= 1
        if was_beside or name in ARTICLE:
            out.gap()
        beside -= was_beside
        article -= name in ARTICLE
        links -= name == "a"

    for m in TOKEN.finditer(html):
        out.add(html[at : m.start()], links > 0)
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            out.end(beside > 0, article > 0)
            if name == "br":
                continue
        if m[2]:
            if open_count[name] > 0:
                while True:
                    entry = stack.pop()
                    if entry[0] != name and entry[0] in BLOCKS:
                        out.end(beside > 0, article > 0)
                    close(entry)
                    if entry[0] == name:
                        break
            continue
        if name in VOID or m[4].endswith("/") and name not in BLOCKS:
            continue
        if name == "p":  # a paragraph is never inside another, and is not tracked
            continue
        if name in ARTICLE and beside and not article:
            while stack:  # what stands before an article and was never closed is over
                close(stack.pop())
        is_beside = _is_beside(name, m[4], article > 0)
        if is_beside or name in ARTICLE:
            out.end(beside > 0, article > 0)
            out.gap()
        stack.append((name, is_beside))
        open_count[name] += 1
        beside += is_beside
        article += name in ARTICLE
        links += name == "a"
    out.add(html[at:], links > 0)
    out.end(beside > 0, article > 0)
    return out


def runs(weights: np.ndarray) -> list[tuple[int, int, int]]:
    """(surge, dive, peak) of every run: first line, line behind the last, and largest sum of a window."""
    if not len(weights):
        return []
    total = np.concatenate([[0], np.cumsum(weights)])
    ends = np.minimum(np.arange(len(weights)) + WINDOW, len(weights))
    window = total[ends] - total[np.arange(len(weights))]
    high = np.concatenate([[0], (window > 0).astype(np.int8), [0]])
    surges, dives = np.flatnonzero(np.diff(high) == 1), np.flatnonzero(np.diff(high) == -1)
    return [(int(a), int(b), int(window[a:b].max())) for a, b in zip(surges, dives)]


def main_text(html: str) -> str:
    lines = lines_of(html)
    weights = np.array(lines.weights, dtype=np.int64)
    inside = np.array(lines.inside, dtype=bool)
    if (weights[inside] > 0).any():
        weights = np.where(inside, weights, 0)
        least = 1
    else:
        least = None
    found = runs(weights)
    if not found:
        return ""
    if least is None:
        least = max(1, PEAK_SHARE * max(peak for _, _, peak in found))
    kept = [t for a, b, peak in found if peak >= least for t in lines.texts[a:b] if t]
    return " ".join(kept)


def text_column(html: Column) -> Column:
    @F.arrow_udf("string")
    def extracted(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p) for p in strings(pages)], type=pa.string())

    return extracted(html)


def extract(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """Add the main text of every page.

    Null, empty and text-free pages give the empty text. A column already called like ``text`` is replaced;
    others and repeated rows stay; each page is read whole and judged alone; an empty table gives an empty result.
    """
    bounded_batches(df.sparkSession)
    return df.withColumn(text, text_column(text_or_empty(html)))
