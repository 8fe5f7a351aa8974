"""Runs of words that repeat with a period, found by seeds on diagonals.

A run is a stretch of words in which words one period apart are equal, that no neighbouring word extends. Two
occurrences of the same gram lie on the diagonal of their distance (lag); a run of period q and length n shows as
n - q equal words in a row on diagonal q.

Lags are taken in bands (``2**(m-1)``, ``2**m``]. A run of some lag has a certain overlap at least, and the grams
indexed for a band have the least overlap of its lags and all greater ones. As that is no less than any lag of the
band, a gram inside a run recurs exactly one period later and nowhere before (else the period were not the smallest). So the occurrence
pairs of neighbours in the list of a gram are all that is needed: n pairs a band, however often a gram occurs.
Names of grams are exact: they are made by doubling, from the names of their halves, and positions whose gram is
alone in its text leave at once.

Each seed is extended along its diagonal both ways. A table of the furthest position covered on every lag skips the
seeds that an extension has passed already.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import bounded_batches, raw, text_or_empty, unused

#: Bytes of text that are searched at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class Rule:
    """Runs hold at least ``least`` words and ``repeats`` periods. Fewer than three are refused: see ``overlap``."""

    least: int = 6
    repeats: int = 4

    def __post_init__(self):
        if self.repeats < 3 or self.least < 2:
            raise ValueError("runs need three periods and two words at least")

    def length(self, period: int) -> int:
        return max(self.least, self.repeats * period)

    def overlap(self, period: int) -> int:
        """Equal words in a row on the diagonal, at least. From three periods on no less than any lag of its band."""
        return self.length(period) - period


def least_overlap(rule: Rule, low: int) -> int:
    """The least overlap of all lags from ``low`` on: it falls with the lag, and rises again from ``turn`` on."""
    turn = max(rule.least // rule.repeats, low)
    return min(rule.overlap(low), rule.overlap(turn), rule.overlap(turn + 1))


def named(keys: np.ndarray) -> np.ndarray:
    """Numbers from 1 for the keys that occur more than once, 0 for those that are alone and for key -1."""
    _, number, times = np.unique(keys, return_inverse=True, return_counts=True)
    repeated = (times > 1)[number] & (keys >= 0)
    names = np.zeros(len(keys), dtype=np.int64)
    names[repeated] = np.unique(number[repeated], return_inverse=True)[1] + 1
    return names


def joined(names: np.ndarray, apart: int) -> np.ndarray:
    """Keys of the pairs of names ``apart`` words from each other; -1 where one is alone or beyond the end."""
    keys = np.full(len(names), -1, dtype=np.int64)
    if apart < len(names):
        here = np.flatnonzero(names[: len(names) - apart])
        here = here[names[here + apart] > 0]
        keys[here] = names[here] * (names.max() + 1) + names[here + apart]
    return keys


def seeds(keys: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, position) of neighbouring occurrences of a key whose lag is in the band, by lag and then position."""
    at = np.flatnonzero(keys >= 0)
    at = at[np.argsort(keys[at], kind="stable")]
    lag = np.diff(at)
    found = (keys[at[1:]] == keys[at[:-1]]) & (lag >= low) & (lag <= high)
    lag, place = lag[found], at[:-1][found]
    order = np.lexsort((place, lag))
    return lag[order], place[order]


def extended(words: np.ndarray, place: int, lag: int) -> tuple[int, int]:
    """Bounds of the equal words in a row on a diagonal, around a position that has equal words."""
    start, end, step, last = place, place + 1, 64, len(words) - lag
    while end < last:
        stop = min(end + step, last)
        differ = np.flatnonzero(words[end:stop] != words[end + lag : stop + lag])
        if len(differ):
            end += int(differ[0])
            break
        end, step = stop, 2 * step
    step = 64
    while start > 0:
        stop = max(start - step, 0)
        differ = np.flatnonzero(words[stop:start] != words[stop + lag : start + lag])
        if len(differ):
            start = stop + int(differ[-1]) + 1
            break
        start, step = stop, 2 * step
    return start, end


def runs_of(words: np.ndarray, rule: Rule = Rule()) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and then period.

    ``words`` holds numbers; those of one text must not occur in another that follows in the same array.
    """
    found: list[tuple[int, int, int]] = []
    names, size, low, high = named(words), 1, 1, 1
    while len(words) and rule.length(low) <= len(words) and names.any():
        gram = least_overlap(rule, low)
        while 2 * size <= gram:
            names, size = named(joined(names, size)), 2 * size
        keys = joined(names, gram - size) if gram > size else np.where(names > 0, names, -1)
        covered: dict[int, int] = {}
        lags, places = seeds(keys, low, high)
        k = 0
        while k < len(lags):
            lag, place = int(lags[k]), int(places[k])
            if place >= covered.get(lag, 0):
                start, end = extended(words, place, lag)
                covered[lag] = end
                if end - start >= rule.overlap(lag):
                    found.append((start, end - start + lag, lag))
            # the next seed that is not covered: further on the same lag, or the first of the next one
            same = int(np.searchsorted(lags, lag, "right"))
            k += int(np.searchsorted(places[k:same], covered[lag]))
        low, high = high + 1, 2 * high
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), dtype=np.int64).reshape(-1, 3)


def dropped(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether each of ``n`` words lies in a run after that run's first period."""
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:n]) > 0


MADE = ("n_words", "runs", "collapsed")
RUN = "struct<start: bigint, length: bigint, period: bigint>"
ARROW_RUN = pa.struct((n, pa.int64()) for n in ("start", "length", "period"))
ARROW_FOUND = pa.struct(zip(MADE, [pa.int64(), pa.list_(ARROW_RUN), pa.string()]))


def found_in(texts: list[bytes], rule: Rule) -> pa.Array:
    """Words, runs and collapsed text of some texts. One array holds the words of all, numbered by text."""
    split = [t.split() for t in texts]
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    first = np.r_[0, np.cumsum(sizes)]
    flat = np.empty(int(first[-1]), dtype=object)
    flat[:] = [w for words in split for w in words]
    codes = pd.factorize(flat)[0].astype(np.int64)
    codes += np.repeat(np.arange(len(texts), dtype=np.int64), sizes) * (len(codes) + 1)
    runs = runs_of(codes, rule)
    gone = dropped(len(codes), runs)
    owner = np.searchsorted(first, runs[:, 0], "right") - 1
    collapsed = []
    for words, start in zip(split, first.tolist()):
        out = gone[start : start + len(words)]
        collapsed.append(b" ".join([w for w, x in zip(words, out.tolist()) if not x] if out.any() else words))
    columns = [pa.array(runs[:, 0] - first[owner]), pa.array(runs[:, 1]), pa.array(runs[:, 2])]
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    listed = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(columns, ["start", "length", "period"]))
    shown = pa.array(collapsed, type=pa.binary()).cast(pa.string())
    return pa.StructArray.from_arrays([pa.array(sizes), listed, shown], MADE)


def sliced(texts: list[bytes], size: int = SLICE_BYTES) -> list[list[bytes]]:
    """Runs of texts of about ``size`` bytes."""
    parts, held = [[]], 0
    for t in texts:
        if held >= size:
            parts.append([])
            held = 0
        parts[-1].append(t)
        held += len(t)
    return parts


def find_runs(df: DataFrame, rule: Rule = Rule(), text: str = "text") -> DataFrame:
    """Add ``n_words`` (long), ``runs`` (array of start, length, period, by start and period) and ``collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. ``collapsed`` is the text without the words that any run holds
    after its first period, joined by one space. Null and empty texts have no words, no runs and an empty text.
    Columns of these names are replaced; other columns, repeated rows and an empty table pass through.
    """
    bounded_batches(df.sparkSession)

    @F.arrow_udf(f"struct<n_words: bigint, runs: array<{RUN}>, collapsed: string>")
    def found(values: pa.Array) -> pa.Array:
        parts = [found_in(part, rule) for part in sliced(raw(values))]
        return pa.concat_arrays(parts) if len(values) else pa.array([], type=ARROW_FOUND)

    held = unused(df, "found")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in MADE]
    return df.withColumn(held, found(text_or_empty(text))).select(*kept, *[F.col(f"{held}.{n}").alias(n) for n in MADE])


def longest(runs: str = "runs") -> Column:
    """The run of greatest length; among equals the one of smallest start, then period. Null without runs."""
    order = F.transform(
        F.col(runs),
        lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")),
    )
    return F.array_min(order)


def listed(runs: str = "runs") -> Column:
    """Every run as ``start,length,period`` and a line feed."""
    return F.array_join(F.transform(F.col(runs), lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def with_planted_runs(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts of which every tenth, by the CRC-32 of its id, repeats a stretch of its words up to its end.

    With ``h`` that number, ``g = floor(h / 10)`` and n words, word i from ``a = g % n`` on becomes word
    ``a + (i - a) % p``, where ``p = 1 + floor((n - a) / (3 + g % 8))``. Texts without words, and rows without id, stay.
    """
    held = unused(df, "words")
    h = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.filter(F.split(text_or_empty(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.size(held).cast("long"), F.floor(h / 10)
    a = g % F.nullif(n, F.lit(0).cast("long"))
    p = 1 + F.floor((n - a) / (3 + g % 8))

    def planted(i: Column) -> Column:
        return F.get(F.col(held), F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))

    texts = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), planted), " ")
    rows = df.withColumn(held, F.when(chosen, words).otherwise(F.array().cast("array<string>")))
    return rows.withColumn(text, F.when(F.size(held) > 0, texts).otherwise(F.col(f"`{text}`"))).drop(held)
