"""Late rows into a keyed table: the upsert as a streaming sink."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import DataStreamWriter

from panelcast.sources.sinks import upsert


def stream_upsert(
    stream: DataFrame,
    path: str,
    keys,
    update: Iterable[str],
    checkpoint: str,
    partitions: dict[str, Column] | None = None,
    order: str | None = None,
    by_key: bool = False,
) -> DataStreamWriter:
    """A writer that upserts each micro-batch into the files it touches; a replayed batch leaves the table unchanged."""
    update = list(update)

    def apply(batch: DataFrame, _epoch: int) -> None:
        if not batch.isEmpty():
            upsert(batch.sparkSession, path, batch, keys, update, partitions, order, by_key)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
