"""Near duplicates: HyperMinHash sketches, banded; estimated; then confirmed on the full sets.

A text is the set of its distinct word shingles, each hashed to 64 bits. The first 8 bits choose one of 256
buckets; of the smallest remainder in a bucket the sketch keeps the count of leading zeros and ten bits of
mantissa, 16 bits in all. A bucket that no shingle chose borrows from one that is filled, in an order that
depends on the bucket alone, so two sets agree in a bucket with a chance equal to their similarity, however
small they are.

Five registers make a band; equal bands make texts candidates. At a similarity of 0.8 the 51 bands miss a
pair with a chance of 2e-9 where registers are independent, as in sets of many more than 256 shingles. Texts with equal sets are one class from the start. Within a bucket no pairs are
listed: every class is compared with the least of the bucket, and components are formed. Links inside a component
change nothing more. Where a bucket still holds several components, any two of its classes may be similar; these
classes are joined on their rarest shingles, of which similar sets of such sizes must share one, across
components only. So no link is lost, and a large group of not quite similar texts is not compared pair by pair.

Candidates of which both sets fill the buckets must pass an estimate from all registers, corrected for registers
that agree by chance, with a margin of eight standard errors below the threshold. Smaller sets borrow most of their
registers, so their errors are not independent and no such margin holds; they are not estimated. All that are left
are confirmed by the intersection of both sets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm import bloom
from panelcast.llm.common import bounded_batches, raw, text_or_empty, written
from panelcast.llm.components import components

BUCKET_BITS, MANTISSA_BITS = 8, 10
BUCKETS = 1 << BUCKET_BITS
REST_BITS = 64 - BUCKET_BITS
BAND_ROWS = 5
BANDS = BUCKETS // BAND_ROWS
#: Standard errors of the estimate (at most 1 / (2 * sqrt(256))) that a candidate may lie below the threshold.
MARGIN = 8 / (2 * BUCKETS**0.5)
#: Sets of fewer shingles are confirmed without an estimate.
ESTIMATED = BUCKETS
#: Ways in which an empty bucket looks for a filled one before it takes the next to the right.
PROBES = 64


@dataclass(frozen=True)
class Rule:
    """Shingle width in words, and the least similarity as a fraction of whole numbers."""

    width: int = 5
    least: int = 80
    of: int = 100

    def sizes(self, n: str, m: str) -> Column:
        """Whether sets of these sizes can be similar enough."""
        return self.of * F.least(n, m) >= self.least * F.greatest(n, m)

    def reached(self, common: Column, n: Column, m: Column) -> Column:
        return self.of * common >= self.least * (n + m - common)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


PROBE = (mixed(np.arange(PROBES * BUCKETS, dtype=np.uint64) + np.uint64(1)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64).reshape(PROBES, BUCKETS)
STARTS = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(REST_BITS)


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; a shorter text is one run of its own."""
    words = text.lower().split()  # of bytes: A to Z and the six spaces only
    if not words:
        return np.empty(0, dtype=np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))
    width = min(width, len(words))
    run = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        run = mixed(run + np.uint64(0x9E3779B97F4A7C15)) ^ hashes[i : i + len(run)]
    return np.unique(mixed(run))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The 256 registers of a set of sorted hashes; all zero for the empty set."""
    out = np.zeros(BUCKETS, dtype=np.uint16)
    if not len(hashes):
        return out
    at = np.searchsorted(hashes, STARTS)
    least = hashes[np.minimum(at, len(hashes) - 1)]
    filled = (least >> np.uint64(REST_BITS)).astype(np.int64) == np.arange(BUCKETS)
    filled &= at < len(hashes)
    rest = least & np.uint64((1 << REST_BITS) - 1)
    length = np.frexp(rest.astype(np.float64))[1]  # bits, after rounding to 53: the same for the same remainder
    zeros = np.maximum(REST_BITS - length, 0)
    down = np.maximum(length - 1 - MANTISSA_BITS, 0).astype(np.uint64)
    up = np.maximum(MANTISSA_BITS + 1 - length, 0).astype(np.uint64)
    mantissa = ((rest >> down) << up) & np.uint64((1 << MANTISSA_BITS) - 1)
    out = np.where(filled, ((zeros + 1) << MANTISSA_BITS) | mantissa.astype(np.int64), 0).astype(np.uint16)
    if filled.all():
        return out
    source = np.where(filled, np.arange(BUCKETS), -1)
    for probe in PROBE:
        empty = np.flatnonzero(source < 0)
        if not len(empty):
            break
        hit = probe[empty]
        source[empty] = np.where(filled[hit], hit, -1)
    empty = np.flatnonzero(source < 0)
    if len(empty):
        there = np.flatnonzero(filled)
        source[empty] = there[np.searchsorted(there, empty) % len(there)]
    return out[source]


SKETCH = "struct<n: bigint, set_id: binary, registers: binary>"


def sketch_column(text: Column, rule: Rule) -> Column:
    """Size, identity (128 bits over the sorted hashes) and registers of a text's set."""

    @F.arrow_udf(SKETCH)
    def sketched(texts: pa.Array) -> pa.Array:
        sets = [shingles(t, rule.width) for t in raw(texts)]
        return pa.StructArray.from_arrays(
            [
                pa.array([len(s) for s in sets], type=pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], type=pa.binary()),
                pa.array([registers(s).tobytes() for s in sets], type=pa.binary()),
            ],
            ["n", "set_id", "registers"],
        )

    return sketched(text)


def set_column(text: Column, rule: Rule) -> Column:
    """The full set of shingle hashes."""

    @F.arrow_udf("array<bigint>")
    def listed(texts: pa.Array) -> pa.Array:
        sets = [shingles(t, rule.width).view(np.int64) for t in raw(texts)]
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        values = np.concatenate(sets) if sets else np.empty(0, dtype=np.int64)
        return pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(values, type=pa.int64()))

    return listed(text)


def estimated(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity from two tables of registers, less those expected to agree by chance.

    Chance agreements follow the published approximation for 2^p buckets and r bits of mantissa,
    0.1699 * 2^(p - r) * 4 x / (1 + x)^2 with x the ratio of the sizes.
    """
    ratio = np.maximum(n, m) / np.maximum(np.minimum(n, m), 1)
    chance = 0.169919487159739 * 2.0 ** (BUCKET_BITS - MANTISSA_BITS) * 4 * ratio / (1 + ratio) ** 2
    agree = (a == b).sum(axis=1)
    return (agree - chance) / (BUCKETS - chance)


def estimate_column(a: Column, b: Column, n: Column, m: Column) -> Column:
    @F.arrow_udf("double")
    def guess(x: pa.Array, y: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
        def rows(v):
            return np.frombuffer(b"".join(v.to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS)

        return pa.array(estimated(rows(x), rows(y), n.to_numpy(zero_copy_only=False), m.to_numpy(zero_copy_only=False)))

    return guess(a, b, n, m)


def band_keys(registers: Column) -> Column:
    """One 64-bit key per band."""
    size = 2 * BAND_ROWS
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring(registers, i * size + 1, F.lit(size))),
    )


class NearDuplicates:
    """The steps of one run; each result that is read more than once is a table in the shared folder."""

    def __init__(self, docs: DataFrame, rule: Rule, id_col: str, text: str):
        self.spark, self.rule = docs.sparkSession, rule
        bounded_batches(self.spark)
        self.docs = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text).alias("text"))
        sketched = self.docs.withColumn("s", sketch_column(F.col("text"), rule)).select("id", "s.*")
        self.sketches = written(sketched, "sketches")
        # equal sets have equal registers: one class, of which the least id stands for all
        classes = self.sketches.where("n > 0").groupBy("set_id", "n", "registers").agg(F.min("id").alias("id"))
        self.classes = written(classes, "classes")

    def buckets(self) -> DataFrame:
        """(key, hub, id): members of every bucket that holds two classes or more, and its least member."""
        banded = self.classes.select("id", F.explode(band_keys(F.col("registers"))).alias("key"))
        shared = banded.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("held")).where("held > 1")
        return banded.join(shared.select("key", "hub"), "key")

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(id, set) of the classes whose ids are wanted."""
        texts = bloom.only(self.docs, wanted, "id").dropDuplicates(["id"])
        return written(texts.select("id", set_column(F.col("text"), self.rule).alias("set")), "sets")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Of the pairs (u, v), those of fitting sizes whose registers don't rule them out."""
        rule, classes = self.rule, self.classes
        one = classes.select(F.col("id").alias("u"), F.col("n").alias("n"), F.col("registers").alias("a"))
        two = classes.select(F.col("id").alias("v"), F.col("n").alias("m"), F.col("registers").alias("b"))
        sized = pairs.join(one, "u").join(two, "v").where(rule.sizes("n", "m"))
        guess = estimate_column(F.col("a"), F.col("b"), F.col("n"), F.col("m"))
        fits = (F.least("n", "m") < ESTIMATED) | (F.col("guess") >= rule.least / rule.of - MARGIN)
        return written(sized.withColumn("guess", guess).where(fits).select("u", "v"), "likely")

    def confirmed(self, likely: DataFrame, sets: DataFrame) -> DataFrame:
        """Of the pairs (u, v), those whose full sets reach the threshold."""
        both = likely.join(sets.select(F.col("id").alias("u"), F.col("set").alias("a")), "u")
        both = both.join(sets.select(F.col("id").alias("v"), F.col("set").alias("b")), "v")
        common = F.size(F.array_intersect("a", "b")).cast("long")
        met = self.rule.reached(common, F.size("a"), F.size("b"))
        return written(both.where(met).select("u", "v"), "links")

    def rarest(self, sets: DataFrame) -> DataFrame:
        """(id, t, n, at, short): the first shingles of each set, rarest first, with their places.

        A set of n and one no larger of m share n * least / of shingles at least, and both one of the rest plus
        one; of the smaller set the ``short`` ones suffice, as it must share 2 * least / (of + least) of its own.
        """
        rule = self.rule
        each = sets.select("id", F.explode("set").alias("t"))
        held = each.groupBy("t").agg(F.count("*").alias("held"))
        listed = each.join(held, "t").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("held", "t"))).alias("s"))
        n = F.size("s").cast("long")
        first = F.expr(f"CAST(size(s) - (size(s) * {rule.least}L + {rule.of - 1}) DIV {rule.of} + 1 AS INT)")
        short = F.expr(f"size(s) - (2L * {rule.least} * size(s) + {rule.of + rule.least - 1}) DIV {rule.of + rule.least} + 1")
        cut = listed.select("id", n.alias("n"), short.alias("few"), F.posexplode(F.slice("s", F.lit(1), first)).alias("at", "x"))
        return cut.select("id", F.col("x.t").alias("t"), "n", "at", (F.col("at") < F.col("few")).alias("short"))

    def across(self, placed: DataFrame) -> DataFrame:
        """Pairs (u, v) of different components that may be similar, among classes (id, component)."""
        rule = self.rule
        firsts = self.rarest(self.sets(placed.select("id"))).join(placed, "id")
        spread = firsts.groupBy("t").agg(F.min("component").alias("main"), F.max("component").alias("other")).where("main <> other")
        firsts = written(firsts.join(spread.select("t", "main"), "t"), "firsts")
        x, y = firsts.where("component <> main").alias("x"), firsts.alias("y")
        smaller = F.when(F.struct("x.n", "x.id") < F.struct("y.n", "y.id"), F.col("x.short")).otherwise(F.col("y.short"))
        rest = 1 + F.least(F.col("x.n") - F.col("x.at") - 1, F.col("y.n") - F.col("y.at") - 1)
        fits = (F.col("x.component") != F.col("y.component")) & smaller & rule.sizes("x.n", "y.n")
        pairs = x.join(y, (F.col("x.t") == F.col("y.t")) & fits & rule.reached(rest, F.col("x.n"), F.col("y.n")))
        return pairs.select(F.least("x.id", "y.id").alias("u"), F.greatest("x.id", "y.id").alias("v")).distinct()

    def labels(self) -> DataFrame:
        """(id, component) of the classes that have a link."""
        buckets = written(self.buckets(), "buckets")
        stars = written(buckets.where("id <> hub").select(F.col("hub").alias("u"), F.col("id").alias("v")).distinct(), "stars")
        likely = self.likely(stars)
        links = self.confirmed(likely, self.sets(likely.select(F.col("u").alias("id")).union(likely.select("v"))))
        first = written(components(links).select(F.col("node").alias("id"), "component"), "labels")
        placed = buckets.join(first, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
        spread = placed.groupBy("key").agg(F.min("component").alias("main"), F.max("component").alias("other")).where("main <> other")
        placed = written(placed.join(spread.select("key"), "key", "left_semi").select("id", "component").distinct(), "placed")
        pairs = written(self.across(placed).join(stars, ["u", "v"], "left_anti"), "across")
        likely = self.likely(pairs)
        more = self.confirmed(likely, self.sets(likely.select(F.col("u").alias("id")).union(likely.select("v"))))
        final = components(links.union(more))
        return final.select(F.col("node").alias("id"), "component")

    def result(self) -> DataFrame:
        """(id, n, component) of every row given."""
        joined = self.classes.select("set_id", F.col("id").alias("class")).join(self.labels().withColumnRenamed("id", "class"), "class", "left")
        known = written(joined.select("set_id", F.coalesce("component", "class").alias("component")), "components")
        full = self.sketches.where("n > 0").select("id", "n", "set_id").join(known, "set_id").select("id", "n", "component")
        return full.union(self.sketches.where("n = 0").select("id", "n", F.col("id").alias("component")))


def near_duplicates(df: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: id, ``n_shingles``, ``component_id`` and ``kept``.

    ``id_col`` holds distinct whole numbers; other columns are ignored. Texts are linked when ``rule.of`` times
    the common shingles reach ``rule.least`` times all shingles of both. Null, empty and blank texts have no
    shingles and are linked with nothing, each other included. A component is named by its least id, whose
    row is kept. Copies and ties fall into one component. An empty table gives an empty result.
    """
    found = NearDuplicates(df.where(F.col(id_col).isNotNull()), rule, id_col, text).result()
    return found.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )
