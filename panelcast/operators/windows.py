"""Lag, lead, rolling and normalising operators on panels of one row per series and time.

The panel is expected to hold non-null keys and times (``quality.require_non_null``) and one row
per key and time (``quality.coalesce_duplicates``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from panelcast.operators.blocks import HOUR, MICRO, as_keys, over_row_blocks, over_time_blocks
from panelcast.operators.joins import attach
from panelcast.schemas import require_columns

ROLLING = {
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "sum": F.sum,
}


def checked_shift(ts: str, y: str, steps: int, window: WindowSpec, step: int = HOUR) -> Column:
    """Value ``steps`` rows back (negative: ahead) if that row lies exactly that many steps away."""
    moved = F.unix_micros(F.lag(F.col(ts), steps).over(window).cast("timestamp"))
    here = F.unix_micros(F.col(ts).cast("timestamp"))
    exact = here - moved == F.lit(steps * step * MICRO)
    return F.when(exact, F.lag(F.col(y), steps).over(window))


def lag_rows(df: DataFrame, key, ts: str, columns: dict[str, str], lags: Iterable[int], rows=None) -> DataFrame:
    """Value n rows earlier; ``columns`` maps a measure to the stem of its output names."""
    lags = list(lags)
    require_columns(df, [*as_keys(key), ts, *columns])

    def build(w):
        return {f"{stem}_{n}h": F.lag(y, n).over(w) for y, stem in columns.items() for n in lags}

    return over_row_blocks(df, key, ts, build, back=max(lags), rows=rows)


def lag_checked(
    df: DataFrame, key, ts: str, y: str, lags: Iterable[int], stem: str = "demand_lag", step: int = HOUR, width=None
) -> DataFrame:
    """Lag by n rows, kept only where that row is exactly n steps older.

    Time blocks are exact here: a row outside the halo is more than n steps older, hence null.
    """
    lags = list(lags)
    require_columns(df, [*as_keys(key), ts, y])

    def build(w):
        return {f"{stem}_{n}h": checked_shift(ts, y, n, w, step) for n in lags}

    return over_time_blocks(df, key, ts, build, back=max(lags) * step, width=width)


def lead_checked(
    df: DataFrame, key, ts: str, columns: dict[str, str], steps: int, step: int = HOUR, width=None
) -> DataFrame:
    """Values ``steps`` rows ahead where that row is exactly as many steps newer."""
    require_columns(df, [*as_keys(key), ts, *columns])

    def build(w):
        return {name: checked_shift(ts, y, -steps, w, step) for y, name in columns.items()}

    return over_time_blocks(df, key, ts, build, ahead=steps * step, width=width)


def lag_exact(
    df: DataFrame, key, ts: str, y: str, lags: Iterable[int], stem: str = "lag_exact", step: int = HOUR, width=None
) -> DataFrame:
    """Value at exactly n steps earlier, looked up by time whatever rows lie between."""
    lags = list(lags)
    require_columns(df, [*as_keys(key), ts, y])

    def build(w):
        points = {n: -n * step * MICRO for n in lags}
        return {f"{stem}_{n}h": F.max(y).over(w.rangeBetween(p, p)) for n, p in points.items()}

    return over_time_blocks(df, key, ts, build, back=max(lags) * step, width=width)


def rolling_columns(
    window: WindowSpec, y: str, stem: str, sizes: Iterable[int], funcs: Iterable[str], current: bool
) -> dict[str, Column]:
    """Trailing statistics over n rows that end at the current row or just before it."""
    out = {}
    for n in sizes:
        frame = window.rowsBetween(1 - n, 0) if current else window.rowsBetween(-n, -1)
        for name in funcs:
            out[f"{stem}_{name}_{n}h"] = ROLLING[name](y).over(frame)
    return out


def rolling_past(df, key, ts, y, sizes, funcs=("mean", "min", "max"), stem="demand_rolling", rows=None):
    """Statistics of the n rows before the current one."""
    sizes = list(sizes)
    require_columns(df, [*as_keys(key), ts, y])
    return over_row_blocks(
        df, key, ts, lambda w: rolling_columns(w, y, stem, sizes, funcs, False), back=max(sizes), rows=rows
    )


def rolling_trailing(df, key, ts, y, sizes, funcs=("mean",), stem="temperature_rolling", rows=None):
    """Statistics of the n rows that end at the current one."""
    sizes = list(sizes)
    require_columns(df, [*as_keys(key), ts, y])
    return over_row_blocks(
        df, key, ts, lambda w: rolling_columns(w, y, stem, sizes, funcs, True), back=max(sizes) - 1, rows=rows
    )


def rolling_sum0(df, key, ts, y, sizes, stem="precipitation_rolling", rows=None):
    """Trailing sum in which a missing value counts as zero."""
    sizes = list(sizes)
    filled = df.withColumn("_filled", F.coalesce(F.col(y), F.lit(0.0)))
    out = over_row_blocks(
        filled,
        key,
        ts,
        lambda w: rolling_columns(w, "_filled", stem, sizes, ["sum"], True),
        back=max(sizes) - 1,
        rows=rows,
    )
    return out.drop("_filled")


def zscore(df: DataFrame, key, y: str, name: str = "demand_normalized") -> DataFrame:
    """Distance from the series mean in sample standard deviations.

    Mean and deviation come from a partial aggregate, so a hot series is never gathered.
    """
    stats = df.groupBy(*as_keys(key)).agg(
        F.avg(y).alias("_mean"), F.stddev_samp(y).alias("_std")
    )
    score = F.try_divide(F.col(y) - F.col("_mean"), F.col("_std"))
    return attach(df, stats, key).withColumn(name, score).drop("_mean", "_std")
