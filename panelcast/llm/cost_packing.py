"""Packing by attention cost: every sequence full, their costs close together.

Attention makes a document of n tokens cost ``n + n * n / QUADRATIC`` (in units of a token's linear cost), so
sequences of equal length differ in cost. Within a block of documents, whole sequences are cut off documents
longer than one. What remains goes, longest first, to the sequence of lowest cost that still has room for it;
where none has, it is cut, and the cheapest sequence takes what fits.

The capacities of a block add up to its tokens exactly: as many full sequences as they fill and, for the rest,
sequences whose lengths are the powers of two of its binary form. A power of two needs no padding, so none is
left anywhere. A block is a run of rows of one input partition, of about ``BLOCK_TOKENS`` tokens: nothing is
shuffled, memory is bounded, and a task that is run again packs its own rows again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.bpe import vocabulary
from panelcast.llm.common import bounded_batches, strings, text_or_empty

LENGTH = 4096
#: Tokens at which the quadratic part of the cost equals the linear one: six times a model width of 4096.
QUADRATIC = 24_576
#: Tokens of a block. More balance better and cut less; memory is a few bytes a token.
BLOCK_TOKENS = 1 << 20


def cost(tokens):
    return tokens + tokens * tokens / QUADRATIC


def capacities(total: int, length: int = LENGTH) -> np.ndarray:
    """Lengths of the sequences that hold ``total`` tokens without padding; ``length`` is a power of two."""
    full, rest = divmod(total, length)
    powers = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.array([length] * full + powers, dtype=np.int64)


def balanced(sizes: list[int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one block; documents of no tokens have none."""
    room = capacities(sum(sizes), length)
    spent = np.zeros(len(room))
    used = np.zeros(len(room), dtype=np.int64)
    pieces: list[tuple[int, int, int, int, int]] = []

    def put(doc: int, start: int, n: int, into: int) -> None:
        pieces.append((doc, start, n, into, int(used[into])))
        used[into] += n
        room[into] -= n
        spent[into] += cost(n)

    following, left = 0, []
    for doc, size in enumerate(sizes):
        start = 0
        while size - start >= length:
            put(doc, start, length, following)
            following, start = following + 1, start + length
        if size > start:
            left.append((size - start, doc, start))
    for n, doc, start in sorted(left, key=lambda x: (-x[0], x[1])):
        while n:
            fits = np.where(room >= n, spent, np.inf)
            into = int(fits.argmin())
            if not np.isfinite(fits[into]):
                # none has room for all of it: cut as little as possible off the largest gap, the cheapest first
                into = int(np.where(room == room.max(), spent, np.inf).argmin())
            part = min(n, int(room[into]))
            put(doc, start, part, into)
            n, start = n - part, start + part
    return pieces


PIECES = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
)


def pack(
    df: DataFrame,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset and ids.

    A document is the ids of its text under ``tokenizer`` (a file that every machine has) and then ``end_id``;
    null and empty texts are the end alone. The pieces of a document cover it without overlap, those of a
    sequence fill it from 0 without a gap. A sequence is ``length`` long (a power of two), or a smaller power of
    two at the end of a block. Rows are packed where they lie: repeated ids are packed as often as they come,
    other columns are ignored, an empty table gives no pieces.
    """
    bounded_batches(df.sparkSession)
    kind = dict(df.dtypes)[id_col]
    end = np.uint32(end_id).tobytes()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = vocabulary(tokenizer).encode_all
        following = TaskContext.get().partitionId() << 40
        names, coded, held = [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal following
            sizes = [len(c) // 4 for c in coded]
            pieces = balanced(sizes, length)
            parts = [coded[doc][4 * start : 4 * (start + n)] for doc, start, n, _, _ in pieces]
            columns = [
                pa.array([names[p[0]] for p in pieces], type=name_type),
                pa.array([p[1] for p in pieces], type=pa.int64()),
                pa.array([p[2] for p in pieces], type=pa.int64()),
                pa.array([zlib.crc32(p) for p in parts], type=pa.int64()),
                pa.array([sizes[p[0]] for p in pieces], type=pa.int64()),
                pa.array([following + p[3] for p in pieces], type=pa.int64()),
                pa.array([p[4] for p in pieces], type=pa.int64()),
                pa.array(parts, type=pa.binary()),
            ]
            following += len(capacities(sum(sizes), length))
            return pa.RecordBatch.from_arrays(columns, [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

        name_type = None
        for batch in batches:
            name_type = batch.column(0).type
            for name, ids in zip(batch.column(0).to_pylist(), encode_all(strings(batch.column(1)))):
                names.append(name)
                coded.append(ids + end)
                held += len(coded[-1]) // 4
                if held >= block_tokens:
                    yield block()
                    names, coded, held = [], [], 0
        if names:
            yield block()

    rows = df.select(F.col(id_col), text_or_empty(text).alias("text"))
    return rows.mapInArrow(packed, f"`{id_col}` {kind}, {PIECES}")
