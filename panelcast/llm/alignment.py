"""Alignment of the tokens of two tokenizers over the same bytes, by pointer jumping.

Both tokenizers cut the same bytes, so a token of one overlaps some tokens of the other. Every token points to the
farthest-right token that it overlaps; one that nothing reaches beyond points to itself. Doubling the successors of
all tokens at once (``next[next]``) brings each to the last token of its component in a number of rounds that grows
with the logarithm of the longest chain. Components are the groups between offsets at which both tokenizers end a
token; the two tokens that end a group are linked.

Texts are tokenized and aligned where they lie, in slices of bounded bytes. The links are then counted over the
corpus. Pairs with at least one in ``HEAVY`` of all links are at most ``HEAVY`` many, whatever the corpus: those are
broadcast, so that no frequent pair ends in one task. All other links meet their counts in a shuffled join, in which
no pair has more than that share.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.bpe import SETTLED, Vocabulary
from panelcast.llm.common import bounded_batches, text_or_empty, unused, with_facts, written

#: Pairs that hold at least one in so many of all links are broadcast: at most as many pairs as this.
HEAVY = 1 << 16
#: Bytes of text that are aligned at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 18
#: Bytes of a batch: the groups of a text, as text, are several times as long as the text itself.
BATCH_BYTES = "1m"
#: Stands for white space in the pieces of the second tokenizer.
PIECE_SPACE = "▁"
#: Fixed value: the public split pattern of byte-level vocabularies.
LEFT_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters and numbers on which versions of Unicode may differ.
UNSETTLED = re.compile(f"[{SETTLED}-\U0010ffff]")


class Sides:
    """Two tokenizers: a byte-level one (A) from a tokenizers file, one of pieces (B) from a sentencepiece model."""

    def __init__(self, left: str, right: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known = Vocabulary(left)
        known.library.encode_special_tokens = True
        self.library = known.library
        self.left = known.token
        made = [known.id_of[a + b] for a, b in sorted(known.rank, key=known.rank.get)]
        #: The same merges in compiled form, where ids are the order of merging; else the library encodes.
        self.core = None
        if all(x < y for x, y in zip(made, made[1:])):
            self.core = tiktoken.Encoding("left", pat_str=LEFT_SPLIT, mergeable_ranks=known.id_of, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=right)
        self.right = [self._piece(i) for i in range(self.pieces.get_piece_size())]
        self.left_size = np.array([len(t) for t in self.left], dtype=np.int64)
        self.right_size = np.array([len(t) for t in self.right], dtype=np.int64)
        #: Ids as written in a group: its first token of A and of B, then further ones.
        n = [len(self.left), len(self.right)]
        self.shown = [f"{mark}{i}" for side, mark in ((0, ";"), (0, ","), (1, "|"), (1, ",")) for i in range(n[side])]
        self.shown_at = np.cumsum([0, n[0], n[0], n[1]])

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        if self.pieces.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(PIECE_SPACE, " ").encode()

    def left_ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of A. Letters on which Unicode versions differ are left to the library itself."""
        core, library = self.core, self.library
        return [
            library.encode(t, add_special_tokens=False).ids if core is None or UNSETTLED.search(t) else core.encode_ordinary(t)
            for t in texts
        ]

    def right_ids(self, texts: list[str]) -> list[list[int]]:
        return self.pieces.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def sides(left: str, right: str) -> Sides:
    """Read once in each worker, from files that every machine has."""
    return Sides(left, right)


def last_tokens(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For every token of A, then of B, the number of the token of B that ends its component.

    ``ends_a`` and ``ends_b`` are the byte offsets at which tokens end, ascending, each token of a byte or more, both
    with the same last offset. Tokens of B are numbered from ``len(ends_a)``.
    """
    n = len(ends_a)
    follow = np.empty(n + len(ends_b), dtype=np.int64)
    follow[:n] = n + np.searchsorted(ends_b, ends_a)
    over = np.searchsorted(ends_a, ends_b)
    follow[n:] = np.where(ends_a[over] == ends_b, np.arange(n, n + len(ends_b)), over)
    while True:
        beyond = follow[follow]
        if np.array_equal(beyond, follow):
            return follow
        follow = beyond


class Aligned:
    """The groups of some texts of which both sides have tokens, one after the other."""

    def __init__(self, both: Sides, left: list[list[int]], right: list[list[int]]):
        self.both = both
        self.n_a = np.array([len(x) for x in left], dtype=np.int64)
        self.n_b = np.array([len(x) for x in right], dtype=np.int64)
        self.a = np.array([i for x in left for i in x], dtype=np.int64)
        self.b = np.array([i for x in right for i in x], dtype=np.int64)
        n = len(self.a)
        last = last_tokens(np.cumsum(both.left_size[self.a]), np.cumsum(both.right_size[self.b]))
        ending = np.zeros(len(last), dtype=bool)
        ending[last] = True
        number = np.cumsum(ending) - 1
        group = number[last]
        #: Number of the group of every token, over all texts.
        self.group_a, self.group_b = group[:n], group[n:]
        self.first_a, self.first_b = self._first(self.group_a), self._first(self.group_b)
        last_a = np.flatnonzero(np.r_[self.group_a[1:] != self.group_a[:-1], True]) if n else np.empty(0, np.int64)
        self.link_a, self.link_b = self.a[last_a], self.b[last[:n][last_a] - n]
        #: Groups before each text, and in all.
        self.before = np.r_[0, self.group_a[np.cumsum(self.n_a) - 1] + 1] if n else np.zeros(1, np.int64)

    @staticmethod
    def _first(group: np.ndarray) -> np.ndarray:
        return np.r_[True, group[1:] != group[:-1]] if len(group) else np.empty(0, bool)

    def groups(self) -> list[str]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        place = self.both.shown_at
        shown_a = self.a + np.where(self.first_a, place[0], place[1])
        shown_b = self.b + np.where(self.first_b, place[2], place[3])
        # tokens of A come after those of B of earlier groups, tokens of B after those of A of their own
        start_b, end_a = np.searchsorted(self.group_b, self.group_a), np.searchsorted(self.group_a, self.group_b, "right")
        order = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        order[np.arange(len(self.a)) + start_b] = shown_a
        order[np.arange(len(self.b)) + end_a] = shown_b
        words = list(map(self.both.shown.__getitem__, order.tolist()))
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(words[s:e])[1:] for s, e in zip([0, *ends], ends)]


MADE = ("n_a", "n_b", "n_groups", "groups", "links")
ALIGNED = "struct<n_a: bigint, n_b: bigint, n_groups: bigint, groups: string, links: array<struct<a: int, b: int>>>"
LINK = pa.struct([("a", pa.int32()), ("b", pa.int32())])
ARROW_ALIGNED = pa.struct(zip(MADE, [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(LINK)]))


def aligned_rows(both: Sides, texts: list[str]) -> list[pa.Array]:
    """Columns ``n_a, n_b, n_groups, groups, links`` of some texts, in their order.

    A text has no tokens where it is empty, or where the tokens of a side do not give back a space and the text.
    """
    spaced = [" " + t for t in texts]
    filled = [k for k, t in enumerate(texts) if t]
    left, right = both.left_ids([spaced[k] for k in filled]), both.right_ids([texts[k] for k in filled])
    same = [
        k
        for k, (i, a, b) in enumerate(zip(filled, left, right))
        if b"".join(map(both.left.__getitem__, a)) == (whole := spaced[i].encode()) and b"".join(map(both.right.__getitem__, b)) == whole
    ]
    found = Aligned(both, [left[k] for k in same], [right[k] for k in same])
    counts = np.zeros((3, len(texts)), dtype=np.int64)
    rows = np.array([filled[k] for k in same], dtype=np.int64)
    counts[:, rows] = [found.n_a, found.n_b, np.diff(found.before)]
    shown = [""] * len(texts)
    for k, groups in zip(rows.tolist(), found.groups()):
        shown[k] = groups
    pairs = pa.StructArray.from_arrays([pa.array(found.link_a.astype(np.int32)), pa.array(found.link_b.astype(np.int32))], ["a", "b"])
    bounds = pa.array(np.r_[0, np.cumsum(counts[2])].astype(np.int32))
    return [*(pa.array(c) for c in counts), pa.array(shown, type=pa.string()), pa.ListArray.from_arrays(bounds, pairs)]


def sliced(texts: list[str], size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``size`` characters."""
    start, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t)
        if held >= size:
            yield start, k + 1
            start, held = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def align(df: DataFrame, left: str, right: str, text: str = "text") -> DataFrame:
    """Add to every row ``n_a, n_b, n_groups`` (long), ``groups`` (text) and ``links`` (array of a, b).

    ``left`` is a byte-level vocabulary file, ``right`` a sentencepiece model, both at hand on every machine. Null and
    empty texts, and those that a side does not reproduce, have no tokens: zeros, an empty text and no links.
    Columns of these names are replaced; other columns, repeated rows and an empty table pass through.
    """
    bounded_batches(df.sparkSession, BATCH_BYTES)

    @F.arrow_udf(ALIGNED)
    def aligned(values: pa.Array) -> pa.Array:
        both, texts = sides(left, right), [v or "" for v in values.to_pylist()]
        parts = [aligned_rows(both, texts[s:e]) for s, e in sliced(texts)]
        return pa.concat_arrays([pa.StructArray.from_arrays(p, MADE) for p in parts] or [pa.array([], type=ARROW_ALIGNED)])

    held = unused(df, "aligned")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in MADE]
    return df.withColumn(held, aligned(text_or_empty(text))).select(*kept, *[F.col(f"{held}.{n}").alias(n) for n in MADE])


def pair_counts(links: DataFrame) -> DataFrame:
    """(a, b, n, best): links of each pair of ids, and whether no id of A has more links with that id of B."""
    counts = written(links.groupBy("a", "b").agg(F.count("*").alias("n")), "pairs")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return written(counts.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def with_link_counts(aligned: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """Add ``n_best`` and ``count_sum``: links whose pair is the most frequent of its id of B, and sum of pair counts.

    ``aligned`` has the columns of ``align``; ``links`` goes. Counts are over all rows. Rows without links have zeros.
    Columns ``n_best`` and ``count_sum`` of the input are replaced.
    """
    row = unused(aligned, "row")
    kept = [c for c in aligned.columns if c not in ("links", "n_best", "count_sum")]
    rows = written(aligned.select(*[F.col(f"`{c}`") for c in kept], "links", F.monotonically_increasing_id().alias(row)), "aligned")
    links = rows.select(row, F.explode("links").alias("link")).select(row, "link.a", "link.b")
    counts = pair_counts(links.select("a", "b")).withColumn("times", F.col("n"))
    # the links of one text lie together, so most are summed up before anything is shuffled
    found = with_facts(links, counts, ["a", "b"], "times", heavy).groupBy(row).agg(
        F.sum(F.col("best").cast("long")).alias("n_best"), F.sum("n").alias("count_sum")
    )
    zero = F.lit(0).cast("long")
    return rows.drop("links").join(found, row, "left").select(
        *[F.col(f"`{c}`") for c in kept],
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
    )
