"""Series split into blocks, so that one hot series spreads over many tasks.

A window over ``partitionBy(series)`` sorts a whole series in one task. Here a series is cut
into blocks, each block also receives the neighbouring rows its frames reach into (the halo),
the window runs per ``(series, block)``, and the halo copies are dropped. Two ways to cut:

* by time, exact where a frame is bounded in time; needs one shuffle and no extra pass;
* by row number, exact where a frame counts rows; rows are numbered in two phases (counts per
  series and cell, running sum of those few counts, local row number), so no task sorts a series.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelcast.functions.timecols import micros

HOUR = 3600
DAY = 24 * HOUR
MICRO = 1_000_000

Build = Callable[[WindowSpec], dict[str, Column]]


def as_keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _spread(df: DataFrame, position: Column, width: int, back: int, ahead: int) -> DataFrame:
    """Copy each row into every block whose rows look back or ahead far enough to see it."""
    first = F.floor((position - F.lit(ahead)) / F.lit(width))
    last = F.floor((position + F.lit(back)) / F.lit(width))
    copies = df.withColumn("_block", F.explode_outer(F.sequence(first, last)))
    # a row without a position stays in the null block and keeps itself
    own = F.col("_block").eqNullSafe(F.floor(position / F.lit(width)))
    return copies.withColumn("_own", own)


def _finish(
    df: DataFrame, build: Build, keys: list[str], order: str, scratch: list[str], tasks: int | None
) -> DataFrame:
    """Run the window per block and drop the halo.

    Spark may merge small shuffle partitions, which is right unless the window is heavy or feeds
    an expansion; ``tasks`` then fixes the number of tasks at no extra shuffle.
    """
    if tasks:
        df = df.repartition(tasks, *keys, "_block")
    window = Window.partitionBy(*keys, "_block").orderBy(order)
    return df.withColumns(build(window)).filter(F.col("_own")).drop("_block", "_own", *scratch)


def default_tasks(df: DataFrame) -> int:
    """The session's shuffle partition count, the size the operator of the cluster chose."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def over_time_blocks(
    df: DataFrame,
    key,
    ts: str,
    build: Build,
    back: int = 0,
    ahead: int = 0,
    width: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Window columns whose frames reach at most ``back`` / ``ahead`` seconds from the row.

    ``build`` gets a window ordered by microseconds, so range frames are given in microseconds.
    """
    width = width or max(28 * DAY, 4 * (back + ahead))
    placed = df.withColumn("_t", micros(ts))
    cut = _spread(placed, F.col("_t"), width * MICRO, back * MICRO, ahead * MICRO)
    return _finish(cut, build, as_keys(key), "_t", ["_t"], tasks)


def number_rows(df: DataFrame, key, ts: str, cell: int = 7 * DAY) -> DataFrame:
    """0-based position ``_rn`` of each row in its series, found without sorting a series."""
    keys = as_keys(key)
    placed = df.withColumn("_t", micros(ts)).withColumn(
        "_cell", F.floor(F.col("_t") / F.lit(cell * MICRO))
    )
    counts = placed.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_count"))
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *keys, "_cell", F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_start")
    )
    local = Window.partitionBy(*keys, "_cell").orderBy("_t")
    position = F.coalesce(F.col("_start"), F.lit(0)) + F.row_number().over(local) - 1
    return (
        placed.join(starts, [*keys, "_cell"], "left")
        .withColumn("_rn", position)
        .drop("_cell", "_start")
    )


def over_row_blocks(
    df: DataFrame,
    key,
    ts: str,
    build: Build,
    back: int = 0,
    ahead: int = 0,
    rows: int | None = None,
    cell: int = 7 * DAY,
    tasks: int | None = None,
) -> DataFrame:
    """Window columns whose frames reach at most ``back`` / ``ahead`` rows from the row."""
    rows = rows or max(2048, 8 * (back + ahead))
    columns = df.columns
    cut = _spread(number_rows(df, key, ts, cell), F.col("_rn"), rows, back, ahead)
    out = _finish(cut, build, as_keys(key), "_rn", ["_t", "_rn"], tasks)
    return out.select(*columns, *[c for c in out.columns if c not in columns])


def carry_known(
    df: DataFrame, key, ts: str, y: str, width: int = 28 * DAY
) -> DataFrame:
    """Nearest known value and time at or before (``_prev``) and at or after (``_next``) each row.

    Two-level scan: the first and last known point of each block, those few points carried
    along the series, then a window inside the block that falls back on the carried point.
    """
    keys = as_keys(key)
    placed = df.withColumn("_t", micros(ts)).withColumn(
        "_block", F.floor(F.col("_t") / F.lit(width * MICRO))
    )
    point = F.when(F.col(y).isNotNull(), F.struct(F.col("_t"), F.col(y).alias("_y")))
    ends = placed.groupBy(*keys, "_block").agg(
        F.min(point).alias("_first"), F.max(point).alias("_last")
    )
    along = Window.partitionBy(*keys).orderBy("_block")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    after = along.rowsBetween(1, Window.unboundedFollowing)
    carried = ends.select(
        *keys,
        "_block",
        F.last("_last", ignorenulls=True).over(before).alias("_before"),
        F.first("_first", ignorenulls=True).over(after).alias("_after"),
    )
    inside = Window.partitionBy(*keys, "_block").orderBy("_t")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    from_here = inside.rowsBetween(0, Window.unboundedFollowing)
    return (
        placed.join(carried, [*keys, "_block"], "left")
        .withColumns(
            {
                "_prev": F.coalesce(F.last(point, ignorenulls=True).over(so_far), F.col("_before")),
                "_next": F.coalesce(F.first(point, ignorenulls=True).over(from_here), F.col("_after")),
            }
        )
        .drop("_block", "_before", "_after")
    )
