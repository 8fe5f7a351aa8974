"""Token ids as packed matrices: best-fit decreasing with a segment tree over capacities.

A document longer than a row is split into full rows and a rest. The pieces of a block go longest first into the
fullest row that still has room. A segment tree over the possible capacities counts the rows of each; the least
capacity that suffices is found on one way down, in the logarithm of the row length.

Every row of the result is a row of the matrix: ``length`` ids of 16 or 32 bits, padded at the end, the cumulative
lengths of its segments, and a position for every id that starts again at each segment. Blocks are runs of rows of
one input partition, so nothing is shuffled and a task that is run again writes its own rows again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.bpe import vocabulary
from panelcast.llm.common import bounded_batches, strings, text_or_empty

LENGTH = 2048
BLOCK_TOKENS = 1 << 20


class Capacities:
    """How many open rows have each capacity from 0 to ``most``; finds the least that suffices."""

    def __init__(self, most: int):
        self.size = 1
        while self.size <= most:
            self.size *= 2
        self.tree = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _count(self, capacity: int, change: int) -> None:
        at = capacity + self.size
        while at:
            self.tree[at] += change
            at //= 2

    def put(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        self._count(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, row) of a row with the least capacity of ``least`` or more, which is then no longer held."""
        tree, at = self.tree, least + self.size
        if not tree[at]:
            # up to the first right-hand sibling that holds a row, then down to its left-most
            while at > 1 and (at % 2 or not tree[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if tree[2 * at] else 2 * at + 1
        capacity = at - self.size
        row = self.rows[capacity].pop()
        self._count(capacity, -1)
        return capacity, row


def best_fit(sizes: list[int], length: int) -> list[list[tuple[int, int, int]]]:
    """Rows of pieces (document, start, tokens)."""
    rows: list[list[tuple[int, int, int]]] = []
    left = []
    for doc, size in enumerate(sizes):
        full = size - size % length
        rows += [[(doc, start, length)] for start in range(0, full, length)]
        if size > full:
            left.append((size - full, doc, full))
    open_rows = Capacities(length)
    for n, doc, start in sorted(left, key=lambda x: (-x[0], x[1])):
        found = open_rows.take(n)
        if found is None:
            found = (length, len(rows))
            rows.append([])
        capacity, row = found
        rows[row].append((doc, start, n))
        if capacity > n:
            open_rows.put(capacity - n, row)
    return rows


FIELDS = "sequence_id bigint, tokens bigint, doc_ids array<{kind}>, starts array<bigint>, cu_seqlens array<int>, ids binary, positions binary"


def matrices(
    df: DataFrame,
    tokenizer: str,
    end_id: int,
    pad_id: int = 0,
    id_col: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per packed sequence.

    A document is the ids of its text and then ``end_id``; null and empty texts are the end alone. ``doc_ids`` and
    ``starts`` name the document and first token of each segment, ``cu_seqlens`` (from 0) its bounds. ``ids`` and
    ``positions`` are little-endian, ``length`` values each: unsigned 16-bit if the vocabulary fits, else 32-bit; the
    positions always 32-bit. Padding is ``pad_id`` at position 0, beyond the last bound. Repeated rows are packed as
    often as they come, other columns are ignored, an empty table gives no rows.
    """
    bounded_batches(df.sparkSession)
    kind = dict(df.dtypes)[id_col]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(tokenizer)
        wide = np.dtype("<u2" if max(len(words.token), end_id + 1, pad_id + 1) <= 1 << 16 else "<u4")
        end = np.uint32(end_id).tobytes()
        following = TaskContext.get().partitionId() << 40
        names, coded, held, name_type = [], [], 0, pa.int64()

        def block(names: list, coded: list[bytes], first: int) -> pa.RecordBatch:
            arrays = [np.frombuffer(c, dtype="<u4") for c in coded]
            columns: list[list] = [[] for _ in range(7)]
            for i, row in enumerate(best_fit([len(a) for a in arrays], length)):
                ids, positions = np.full(length, pad_id, dtype=wide), np.zeros(length, dtype="<i4")
                bounds = np.cumsum([0, *[n for _, _, n in row]])
                for (doc, start, n), at in zip(row, bounds):
                    ids[at : at + n] = arrays[doc][start : start + n]
                    positions[at : at + n] = np.arange(n)
                values = (
                    first + i,
                    int(bounds[-1]),
                    [names[doc] for doc, _, _ in row],
                    [start for _, start, _ in row],
                    bounds.astype(np.int32),
                    ids.tobytes(),
                    positions.tobytes(),
                )
                for column, v in zip(columns, values):
                    column.append(v)
            types = [pa.int64(), pa.int64(), pa.list_(name_type), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, types)],
                ["sequence_id", "tokens", "doc_ids", "starts", "cu_seqlens", "ids", "positions"],
            )

        for batch in batches:
            name_type = batch.column(0).type
            for name, ids in zip(batch.column(0).to_pylist(), words.encode_all(strings(batch.column(1)))):
                names.append(name)
                coded.append(ids + end)
                held += len(coded[-1]) // 4
                if held >= block_tokens:
                    out = block(names, coded, following)
                    following += out.num_rows
                    names, coded, held = [], [], 0
                    yield out
        if names:
            yield block(names, coded, following)

    rows = df.select(F.col(id_col), text_or_empty(text).alias("text"))
    return rows.mapInArrow(packed, FIELDS.format(kind=kind))


def write_matrices(packed: DataFrame, path: str) -> DataFrame:
    """Write the matrices as Parquet, which commits whole tasks only, and read them back."""
    packed.write.option("compression", "zstd").parquet(path)
    return packed.sparkSession.read.schema(packed.schema).parquet(path)
