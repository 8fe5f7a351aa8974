"""Order statistics: percentiles, ranks, top rows, running shares.

Nothing here sorts an unbounded group in one task. Percentiles narrow the search with sketches, in as many rounds as
it takes, and count exactly; ranks and running sums go by ranges of rows of about equal number, with the totals of the
ranges carried along.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.blocks import as_keys
from panelcast.operators.joins import attach, attach_one_row
from panelcast.session import settle

ACCURACY = 10_000
#: Values of a group that are put in order at the end of a search for percentiles.
ORDERED = 100_000
#: Parts into which a round of that search cuts what is left.
PARTS = 64


def _named(ps) -> dict[str, float]:
    return dict(ps) if isinstance(ps, dict) else {f"p{p}": p / 100.0 for p in ps}


def percentiles(
    df: DataFrame, y: str, ps, by=(), accuracy: int = ACCURACY, stable: bool = False, ordered: int = ORDERED
) -> DataFrame:
    """Exact percentiles with linear interpolation, one column each, per group.

    ``ps`` maps output names to shares, or lists percents. The built-in exact percentile keeps
    every distinct value of a group in one task; this reads the rows three times instead. They are
    written once for that, unless ``stable`` says they already come straight from files:

    1. a mergeable sketch gives, per group and share, two values that enclose the answer;
    2. one aggregate counts what lies below the enclosure and keeps the nearest value outside it
       on both sides (the sketch may be off by one row at either end);
    3. only enclosed values, merged by value, are put in order. Where more than ``ordered`` rows are enclosed, the
       merged values are cut into parts and counted again, round by round, until no more values than that are left
       (see ``_narrowed``).
    """
    named = _named(ps)
    names, keys = list(named), as_keys(by) if by else []
    slack = 2.0 / accuracy
    lows = [max(0.0, p - slack) for p in named.values()]
    highs = [min(1.0, p + slack) for p in named.values()]
    rows = df.select(*keys, F.col(y).cast("double").alias("_v")).filter(
        F.col("_v").isNotNull() & ~F.isnan("_v")
    )

    def grouped(frame, *aggregates):
        return frame.groupBy(*keys).agg(*aggregates) if keys else frame.agg(*aggregates)

    def beside(frame, stats):
        return attach(frame, stats, keys) if keys else attach_one_row(frame, stats)

    # group columns travel beside a null-safe text form that the joins compare
    labels = [F.first(k, ignorenulls=True).alias(k) for k in keys]
    group_columns = keys
    if keys:
        tags = [F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in keys]
        keys = [f"_k{i}" for i in range(len(tags))]
        rows = rows.select(*[t.alias(k) for t, k in zip(tags, keys)], *group_columns, "_v")

    if not stable:
        rows = settle(rows)
    sketch = grouped(
        rows,
        F.percentile_approx("_v", lows, accuracy).alias("_lo"),
        F.percentile_approx("_v", highs, accuracy).alias("_hi"),
    )
    value = F.col("_v")
    enclosures = [*labels, F.count(F.lit(1)).alias("_n")]
    for i, share in enumerate(named.values()):
        lo, hi = F.col("_lo")[i], F.col("_hi")[i]
        enclosures.append(
            F.struct(
                F.lit(i).alias("i"),
                F.lit(share).alias("share"),
                F.first(lo).alias("lo"),
                F.first(hi).alias("hi"),
                F.count_if(value < lo).alias("below"),
                F.count_if(value.between(lo, hi)).alias("within"),
                F.max(F.when(value < lo, value)).alias("left"),
                F.min(F.when(value > hi, value)).alias("right"),
            ).alias(f"_s{i}")
        )
    located = grouped(beside(rows, sketch), *enclosures)
    spots = F.array(*[F.col(f"_s{i}") for i in range(len(names))]).alias("_spots")
    # one row per group, written so that the third pass and the test of its size see one sketch
    located = settle(located.select(*keys, "_n", spots))

    # the third pass carries the enclosures with the rows, so all numbers stem from one sketch
    inside = F.filter("_spots", lambda s: value.between(s["lo"], s["hi"]))
    merged = (
        beside(rows, located)
        .withColumn("_s", F.explode(inside))
        .groupBy(*keys, F.col("_s.i").alias("i"), "_v")
        .agg(F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n"), F.first("_s").alias("_s"), *labels)
        .withColumn("_base", F.col("_s.below"))
    )
    position = F.col("_s.share") * (F.col("_n") - 1)
    merged = merged.withColumn("_pos", position)
    if located.filter(F.exists("_spots", lambda s: (s["lo"] < s["hi"]) & (s["within"] > ordered))).limit(1).count():
        # two neighbouring values are always needed
        merged = _narrowed(merged, [*keys, "i"], max(ordered, 2))
    running = Window.partitionBy(*keys, "i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = merged.withColumn("_end", F.col("_base") + F.sum("_c").over(running))
    start, lower, upper = F.col("_end") - F.col("_c"), F.floor("_pos"), F.ceil("_pos")

    def at(rank):
        return F.max(F.when((start <= rank) & (rank < F.col("_end")), value))

    found = placed.groupBy(*keys, "i").agg(
        at(lower).alias("_a"),
        at(upper).alias("_b"),
        F.first("_pos").alias("_pos"),
        F.first("_s").alias("_s"),
        *labels,
    )
    # off by one at an end of the enclosure: the neighbour outside it is the missing value
    low, high = F.coalesce("_a", "_s.left"), F.coalesce("_b", "_s.right")
    part = F.col("_pos") - lower
    answer = F.when(part == 0, low).otherwise(low + (high - low) * part)
    outside = (lower < F.col("_s.below") - 1) | (upper > F.col("_s.below") + F.col("_s.within"))
    missed = F.raise_error(F.lit("percentile enclosure missed its rank")).cast("double")
    wide = found.withColumn("_q", F.when(outside, missed).otherwise(answer))
    columns = [F.max(F.when(F.col("i") == i, F.col("_q"))).alias(name) for i, name in enumerate(names)]
    return grouped(wide, *labels, *columns).drop(*keys)


def _narrowed(merged: DataFrame, keys: list[str], ordered: int) -> DataFrame:
    """Only the values next to the ranks that are sought, at most ``ordered`` for each of ``keys``.

    ``merged`` holds distinct values ``_v`` with their number of rows ``_c``, the rows below them all ``_base`` and the
    position sought ``_pos``. A round cuts the values of each key into ``PARTS`` of about as many values, by a sketch,
    sums up their rows, and keeps the parts that hold the ranks around the position. As parts are counted in distinct
    values, a value that fills a third of the rows is one of many. Rows leave no task ordered; what a round writes is
    read by the next.
    """
    while True:
        merged = settle(merged)
        sizes = merged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_d"))
        if not sizes.filter(F.col("_d") > ordered).limit(1).count():
            return merged
        shares = [k / PARTS for k in range(1, PARTS)]
        cuts = merged.groupBy(*keys).agg(F.percentile_approx("_v", shares, ACCURACY).alias("_cuts"))
        cut = attach(merged, cuts, keys).withColumn("_part", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))).drop("_cuts")
        facts = [F.first(c).alias(c) for c in ("_base", "_pos")]
        totals = cut.groupBy(*keys, "_part").agg(F.sum("_c").alias("_rows"), *facts)
        # at most PARTS rows for each key
        before = Window.partitionBy(*keys).orderBy("_part")
        end = F.col("_base") + F.sum("_rows").over(before.rowsBetween(Window.unboundedPreceding, 0))
        last = F.sum("_rows").over(Window.partitionBy(*keys))
        first, beyond = F.col("_base"), F.col("_base") + last - 1
        lower = F.least(F.greatest(F.floor("_pos"), first), beyond)
        upper = F.least(F.greatest(F.ceil("_pos"), first), beyond)
        held = (
            totals.withColumns({"_end": end, "_low": lower, "_high": upper})
            .filter((F.col("_end") > F.col("_low")) & (F.col("_end") - F.col("_rows") <= F.col("_high")))
            .groupBy(*keys)
            .agg(F.min("_part").alias("_from"), F.max("_part").alias("_to"), F.min(F.col("_end") - F.col("_rows")).alias("_start"))
        )
        kept = attach(cut, held, keys).filter(F.col("_part").between(F.col("_from"), F.col("_to")))
        merged = kept.withColumn("_base", F.col("_start")).drop("_part", "_from", "_to", "_start")


def range_parts(df: DataFrame, order: list[Column], parts: int | None = None) -> DataFrame:
    """The rows dealt to ``_part`` s of about equal number, in ``order``: every row of one part precedes the next part.

    Bounds are quantiles of a sample, whatever the spread of the values. ``_row`` breaks ties, so a value on many rows
    fills several parts. The parts are written: their rows do not move when they are read again.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    dealt = numbered.repartitionByRange(parts, *order, F.col("_row"))
    return settle(dealt.withColumn("_part", F.spark_partition_id()))


def running_total(
    df: DataFrame,
    order: str,
    amount: Column,
    name: str,
    ties: Iterable[str] = (),
    parts: int | None = None,
    stable: bool = False,
) -> DataFrame:
    """Sum of ``amount`` over all rows from the largest ``order`` down to the current row.

    Rows are dealt to ranges of about equal size (``range_parts``); the totals of the ranges, one row for each, meet in
    one task, and rows are ordered only inside their range, ``ties`` after the order column. Rows equal in all of
    these come one after another in any order.
    """
    rows = (df if stable else settle(df)).withColumn("_amount", amount)
    placed = range_parts(rows, [F.desc(order), *[F.col(t) for t in ties]], parts)
    totals = placed.groupBy("_part").agg(F.sum("_amount").alias("_sum"))
    above = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("_part", F.coalesce(F.sum("_sum").over(above), F.lit(0)).alias("_above"))
    inside = (
        Window.partitionBy("_part")
        .orderBy(F.desc(order), *ties, "_row")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        placed.join(F.broadcast(carried), "_part")
        .withColumn(name, F.col("_above") + F.sum("_amount").over(inside))
        .drop("_part", "_row", "_amount", "_above")
    )


def rank_average(
    df: DataFrame, column: str, name: str | None = None, parts: int | None = None, stable: bool = False
) -> DataFrame:
    """Rank from the largest value down; equal values share the mean of their ranks.

    Values are merged first, so a value that fills a third of the rows counts as one.
    """
    name = name or f"{column}_rank"
    df = df if stable else settle(df)
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("_c"))
    known = counted.filter(F.col(column).isNotNull())
    ranked = running_total(known, column, F.col("_c"), "_upto", parts=parts, stable=True)
    mean_rank = F.col("_upto") - (F.col("_c") - 1) / F.lit(2.0)
    return attach(df, ranked.select(column, mean_rank.alias(name)), column)


def cumulative_share(df: DataFrame, column: str, ties: Iterable[str] = (), parts: int | None = None) -> DataFrame:
    """Percentage of the total per row and its running sum from the largest row down."""
    df = settle(df)
    total = df.agg(F.sum(column).alias("_total"))
    share = F.when(F.col("_total") > 0, F.col(column) / F.col("_total") * 100.0).otherwise(0.0)
    shares = attach_one_row(df, total).withColumn(f"{column}_pct", share).drop("_total")
    return running_total(
        shares, column, F.col(f"{column}_pct"), f"cumulative_{column}_pct", ties=ties, parts=parts, stable=True
    )


def top_n_per_group(df: DataFrame, group, order: list[Column], n, default: int = 0) -> DataFrame:
    """First n rows of each group; ``n`` is a number or a mapping from group to number.

    The literal bound lets Spark cut every group to that many rows before the shuffle.
    """
    keys = as_keys(group)
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    if isinstance(n, int):
        return ranked.filter(F.col("_rank") <= n).drop("_rank")
    bound = max([default, *n.values()])
    quota = F.lit(default)
    for value, count in n.items():
        quota = F.when(F.col(keys[0]) == value, count).otherwise(quota)
    return ranked.filter(F.col("_rank") <= bound).filter(F.col("_rank") <= quota).drop("_rank")


def latest_per_key(df: DataFrame, key, ts: str) -> DataFrame:
    """Newest row per key as a partial aggregate: each task keeps one candidate per key.

    Of rows of the same time the one with the greatest values stays whole, column by column in the frame's order.
    """
    keys = as_keys(key)
    rest = [ts, *[c for c in df.columns if c not in keys and c != ts]]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
