"""Bloom filters of DataFrame functions: built by an aggregate, asked inside an expression.

A filter is a binary value of 64-bit words, high byte first. Its size is chosen by the caller from counts
and never exceeds ``MOST_BITS``, so it may be sent to every task, as a scalar subquery or a constant.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import written

#: Two megabytes.
MOST_BITS = 1 << 24


def shape(keys: int, rate: float) -> tuple[int, int]:
    """Bits (a multiple of 64) and hashes for so many keys at a rate of false positives."""
    hashes = max(1, math.ceil(math.log2(1.0 / rate)))
    bits = math.ceil(max(1, keys) * hashes / math.log(2) / 64) * 64
    return min(bits, MOST_BITS), hashes


def _places(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits)) for i in range(hashes)]


def build(keys: DataFrame, key: str, level: int, bits: int, hashes: int) -> DataFrame:
    """One row with the binary ``words``. Repeated keys do no harm; without keys all words are 0.

    The bits are or-ed before the shuffle, so what meets in the last task is bounded by ``bits``.
    """
    at = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_places(F.col(key), level, bits, hashes))).alias("at"))
    bit = at.select((F.col("at") / 64).cast("long").alias("word"), F.expr("shiftleft(1L, CAST(at % 64 AS INT))").alias("bits"))
    none = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = bit.union(none).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    listed = words.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("w"))
    as_hex = F.transform("w", lambda x: F.lpad(F.hex(x["bits"]), 16, "0"))
    return listed.select(F.unhex(F.array_join(as_hex, "")).alias("words"))


def fetched(built: DataFrame) -> Column:
    """The filter as a constant, for use inside higher-order functions, where a subquery can't stand."""
    return F.lit(bytearray(built.first()["words"]))


def holds(words: Column, key: Column, level: int, bits: int, hashes: int) -> Column:
    """Whether the filter may hold the key; never false for one that it was built of."""

    def bit(at: Column) -> Column:
        byte = F.floor(at / 64) * 8 + 7 - F.floor(at % 64 / 8)
        value = F.conv(F.hex(F.substring(words, byte.cast("int") + 1, F.lit(1))), 16, 10).cast("long")
        return F.getbit(value, (at % 8).cast("int")) == 1

    checks = [bit(at) for at in _places(key, level, bits, hashes)]
    both = checks[0]
    for c in checks[1:]:
        both = both & c
    return both


def _marked(df: DataFrame, keys: DataFrame, key: str, rate: float) -> tuple[DataFrame, Column]:
    """The distinct keys as a table, and whether a row of ``df`` may have one of them."""
    keys = written(keys.select(key).distinct(), "keys")
    bits, hashes = shape(keys.count(), rate)
    words = written(build(keys, key, 0, bits, hashes), "filter").scalar()
    return keys, F.coalesce(holds(words, F.col(key), 0, bits, hashes), F.lit(False))


def without(df: DataFrame, dropped: DataFrame, key: str, rate: float = 0.01) -> DataFrame:
    """The rows of ``df`` whose key is not among those of ``dropped``; rows with a null key stay.

    Only rows that the filter can't rule out are shuffled to be compared with the keys themselves.
    """
    dropped, maybe = _marked(df, dropped, key, rate)
    return df.where(~maybe).union(df.where(maybe).join(dropped, key, "left_anti").select(df.columns))


def only(df: DataFrame, wanted: DataFrame, key: str, rate: float = 0.01) -> DataFrame:
    """The rows of ``df`` whose key is among those of ``wanted``; what the filter rules out is not shuffled."""
    wanted, maybe = _marked(df, wanted, key, rate)
    return df.where(maybe).join(wanted, key, "left_semi").select(df.columns)
