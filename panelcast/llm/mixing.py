"""Mixing sources to target weights by entropy balancing.

Every document starts with a rate of one copy. Of all rates that give each source its target of tokens, entropy
balancing takes those closest to one in relative entropy, none above ``cap``. The dual of that problem has one number
per source, and its solution tilts rates exponentially by the tokens of a document: ``min(cap, exp(tilt * size))``. So
the fewest documents change: a source above its target loses long documents first, one below it repeats them first.

The dual is solved by Newton steps for all sources at once. A step is one Spark aggregate over the distinct sizes of
each source, with the tilts of the last step joined to them; a step that leaves the bracket of its root halves it.
Sums are of decimals, so they do not depend on the order of rows, and reruns agree.

Rates are rounded to copies from the longest document of a block to the shortest, and what a rounding adds or takes is
owed to the next, so a block ends within half of a short document of its sum. Blocks are sorted by Spark and read as
streams: neither a source nor a block is held in memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import text_or_empty, unused, with_facts, written

#: Sources of at least one row in so many are broadcast.
HEAVY = 1 << 16
#: Documents of one block of rounding, about.
BLOCK = 1 << 14
#: The furthest that the tokens of a solved source may lie from its target, as a share of it.
EXACT = 1e-6
#: Newton steps at most; halving the bracket alone needs fewer.
STEPS = 100


@dataclass(frozen=True)
class Mix:
    """Weights that sources take in turn, and how often a document may come."""

    weights: tuple[int, ...] = (5, 2, 1)
    cap: int = 3


def word_count(text: str) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """Add ``number``: from 0 in the order of ``source``, null last.

    Ranges of sources are numbered each on its own, from the sizes of the ranges before; strings are in the order of
    their code points.
    """
    spark = sources.sparkSession
    order = F.col("source").asc_nulls_last()
    placed = written(sources.repartitionByRange(order).withColumn("range", F.spark_partition_id()), "sources")
    before, starts = 0, []
    for part, count in sorted(placed.groupBy("range").count().collect()):
        starts.append((part, before))
        before += count
    offsets = spark.createDataFrame(starts, "range int, before long")
    within = F.row_number().over(Window.partitionBy("range").orderBy(order))
    return placed.withColumn("within", within).join(F.broadcast(offsets), "range").select(
        *sources.columns, (F.col("before") + F.col("within") - 1).alias("number")
    )


def with_targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """Add ``target`` to ``source, source_size, number``: shares of all tokens by weight, at most ``cap`` times the size.

    What lies above goes to the others by weight, until none is above.
    """
    turns = F.array(*[F.lit(w) for w in mix.weights])
    rows = sources.withColumn("weight", F.element_at(turns, (F.col("number") % len(mix.weights) + 1).cast("int")))
    limit = F.col("source_size") * mix.cap
    total, share, last = rows.agg(F.sum("source_size")).first()[0] or 0, 0.0, None
    while share != last:
        above = F.col("weight") * F.lit(share) > limit
        full, weights = rows.agg(F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight")))).first()
        share, last = (total - (full or 0)) / weights if weights else share, share
    return rows.withColumn("target", F.least(limit.cast("double"), F.col("weight") * F.lit(share))).drop("weight")


def rate(cap: int) -> Column:
    """Copies of a document of ``size`` under ``tilt``."""
    return F.least(F.lit(float(cap)), F.exp(F.least(F.col("tilt") * F.col("size"), F.lit(50.0))))


def solved(sizes: DataFrame, sources: DataFrame, mix: Mix) -> DataFrame:
    """Add ``tilt`` to the sources, so that the rates of their documents add up to the target.

    ``sizes`` holds (number, size, n): documents of every size above 0. The bracket of a root comes from the shortest
    document: were all as short, the tilt at its end would do.
    """
    shortest = F.log(F.col("target") / F.col("source_size")) / F.col("least")
    ends = sizes.groupBy("number").agg(F.min("size").alias("least"))
    state = sources.join(ends, "number").select(
        "number",
        "target",
        F.when(F.col("target") >= F.col("source_size") * mix.cap, F.lit(math.log(mix.cap)) / F.col("least")).otherwise(0.0).alias("tilt"),
        F.least(shortest, F.lit(0.0)).alias("low"),
        F.when(F.col("target") > F.col("source_size"), F.lit(math.log(mix.cap)) / F.col("least")).otherwise(0.0).alias("high"),
    )

    def exact(term: Column) -> Column:
        return F.sum(F.round(term, 3).cast("decimal(30,3)")).cast("double")

    copies = rate(mix.cap)
    tokens = F.col("n") * F.col("size") * copies
    slope = F.when(copies < mix.cap, tokens * F.col("size")).otherwise(0.0)
    miss = F.col("tokens") - F.col("target")
    done = F.abs(miss) <= F.col("target") * EXACT
    low, high = F.when(miss < 0, F.col("tilt")).otherwise(F.col("low")), F.when(miss > 0, F.col("tilt")).otherwise(F.col("high"))
    newton = F.col("tilt") - miss / F.when(F.col("slope") > 0, F.col("slope"))
    for _ in range(STEPS):
        sums = sizes.join(state, "number").groupBy("number").agg(exact(tokens).alias("tokens"), exact(slope).alias("slope"))
        state = written(
            state.join(sums, "number")
            .select("number", "target", "tilt", low.alias("low"), high.alias("high"), newton.alias("newton"), done.alias("done"))
            .select(
                "number",
                "target",
                F.when(F.col("done"), F.col("tilt"))
                .when((F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high")), F.col("newton"))
                .otherwise((F.col("low") + F.col("high")) / 2)
                .alias("tilt"),
                "low",
                "high",
                "done",
            ),
            "tilts",
        )
        if state.where("NOT done").isEmpty():
            break
    return sources.join(state.select("number", "tilt"), "number", "left")


def rounded(rows: DataFrame, cap: int, id_type: str) -> DataFrame:
    """Copies of each document from its ``rate``; ``rows`` lie by block, the longest first."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, owed = None, 0.0
        for batch in batches:
            copies = []
            for source, part, size, times, wanted in zip(*[batch.column(n).to_pylist() for n in ("number", "block", "size", "times", "rate")]):
                if (source, part) != block:
                    block, owed = (source, part), 0.0
                unit, low = size * times, math.floor(wanted)
                if wanted == low or not unit:
                    copies.append(low if unit else 0)
                    continue
                # up to one copy beyond the rate's neighbours where more than half of the document is owed
                n = math.ceil(wanted + owed / unit - 0.5)
                n = min(max(n, low - 1, 0), low + 2, cap)
                owed += (wanted - n) * unit
                copies.append(n)
            kept = [batch.column(n) for n in ("doc_id", "size", "times", "source_size", "target", "rate")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(copies, type=pa.int64())], ["doc_id", "size", "times", "source_size", "target", "rate", "copies"])

    made = f"doc_id {id_type}, size bigint, times bigint, source_size bigint, target double, rate double, copies bigint"
    return rows.mapInArrow(settle, made)


def mix_documents(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", source: str = "source", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per document: ``id_col``, size, source_size, target, rate, copies and taken (size times copies).

    Size is the number of words ``[^\\x20\\x09-\\x0D]+``, none for a null text. Documents without source (null) form one
    of their own, the last. Repeated rows of one id, source and size get the same number of copies each; a document
    without words none that count (0). An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    kind = dict(docs.dtypes)[id_col]
    counted = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"), word_count(text).alias("size"))
    entries = written(counted.groupBy("doc_id", "source", "size").agg(F.count("*").alias("times")), "sizes")
    sizes = written(entries.groupBy("source", "size").agg(F.sum("times").alias("n"), F.count("*").alias("entries")), "sizes")
    sums = sizes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("entries").alias("entries"))
    sources = written(with_targets(numbered(sums), mix), "sources")
    known = sources.select("source", "number")
    by_number = written(sizes.where("size > 0").join(known, sizes["source"].eqNullSafe(known["source"])).select("number", "size", "n"), "sizes")
    tilts = written(solved(by_number, sources, mix), "sources")
    rated = with_facts(entries, tilts.withColumn("blocks", F.ceil(F.col("entries") / block)), ["source"], "entries", HEAVY)
    rows = rated.select(
        "doc_id",
        "size",
        "times",
        "source_size",
        "target",
        "number",
        F.when(F.col("size") > 0, rate(mix.cap)).otherwise(0.0).alias("rate"),
        F.pmod(F.xxhash64("doc_id", "size"), F.col("blocks")).alias("block"),
    )
    order = ["number", "block", (F.col("size") * F.col("times")).desc(), F.xxhash64(F.col("doc_id"), F.lit(1)), "doc_id"]
    blocks = rows.repartition("number", "block").sortWithinPartitions(*order)
    found = rounded(blocks, mix.cap, kind).withColumn("taken", F.col("size") * F.col("copies"))
    columns = ["doc_id", "size", "source_size", "target", "rate", "copies", "taken"]
    return repeated(found, "times").select(F.col("doc_id").alias(id_col), *columns[1:])


def repeated(rows: DataFrame, times: str) -> DataFrame:
    """Every row as often as ``times`` says, in steps, so that no array grows with the count."""
    step, left, each = 1 << 12, unused(rows, "left"), unused(rows, "each")
    steps = F.explode(F.expr(f"sequence(0L, (`{times}` - 1) div {step})"))
    some = rows.where(F.col(times) > 0).select("*", steps.alias(left))
    part = F.least(F.lit(step), F.col(times) - F.col(left) * step).cast("int")
    return some.select("*", F.explode(F.array_repeat(F.lit(0), part)).alias(each)).drop(left, each)


def copied(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents of a mix, each as often as it is taken; ids must be distinct."""
    copies = unused(docs, "copies")
    wanted = mixed.select(F.col(id_col), F.col("copies").alias(copies))
    return repeated(docs.join(wanted, id_col).select(*[F.col(f"`{c}`") for c in docs.columns], copies), copies).drop(copies)
