"""Series repair and features at a point in time."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalars import pct_change, safe_ratio
from panelcast.operators.blocks import DAY, HOUR, MICRO, as_keys, carry_known
from panelcast.operators.joins import attach
from panelcast.operators.quality import dedup_ordered
from panelcast.functions.timecols import micros

DEMAND_LAGS = [1, 2, 3, 6, 12, 24, 48, 72, 144, 168, 336]
DEMAND_WINDOWS = [3, 6, 12, 24, 48, 72, 168]
WEATHER_LAGS = [1, 3, 6, 12, 24, 48, 72, 168]


def regularize(
    df: DataFrame, key, ts: str, end: datetime | None = None, step: int = HOUR, width: int = 28 * DAY
) -> DataFrame:
    """Every step of each series from its first row to ``end`` (or its own last row).

    The grid is generated in two stages, blocks first and steps inside a block second, so that
    no row holds a whole series and the steps of one series come from many tasks.
    """
    keys = as_keys(key)
    stop = F.unix_micros(F.lit(end).cast("timestamp")) if end else F.max(micros(ts))
    span = df.groupBy(*keys).agg(F.min(micros(ts)).alias("_from"), stop.alias("_to"))
    step_us, block_us = step * MICRO, (width // step) * step * MICRO
    starts = F.sequence(F.col("_from"), F.col("_to"), F.lit(block_us))
    blocks = (
        span.filter(F.col("_from") <= F.col("_to"))
        .select(*keys, "_to", F.explode(starts).alias("_start"))
        .repartition(*keys, "_start")
    )
    last = F.least(F.col("_to"), F.col("_start") + F.lit(block_us - step_us))
    kind = dict(df.dtypes)[ts]
    grid = blocks.select(
        *keys, F.explode(F.sequence(F.col("_start"), last, F.lit(step_us))).alias("_at")
    ).select(*keys, F.timestamp_micros("_at").cast(kind).alias(ts))
    return grid.join(df, [*keys, ts], "left").select(*df.columns)


def interpolate_linear(
    df: DataFrame, key, ts: str, y: str, limit: int = 2, step: int = HOUR, width: int = 28 * DAY
) -> DataFrame:
    """Fill at most the first ``limit`` steps of every inner gap, linearly in time.

    The slope spans the whole gap, however long it is. Leading and trailing gaps stay open.
    """
    columns = df.columns
    placed = carry_known(df, key, ts, y, width)
    since = F.col("_t") - F.col("_prev._t")
    slope = (F.col("_next._y") - F.col("_prev._y")) / (F.col("_next._t") - F.col("_prev._t"))
    inner = F.col("_prev").isNotNull() & F.col("_next").isNotNull()
    fill = F.when(inner & (since <= limit * step * MICRO), F.col("_prev._y") + slope * since)
    value = F.when(F.col(y).isNull(), fill).otherwise(F.col(y))
    return placed.withColumn(y, value).select(*columns)


def continuous_history(df: DataFrame, key, ts: str, y: str, end: datetime) -> DataFrame:
    """Deduplicated hourly history up to ``end`` with short holes filled."""
    keys = as_keys(key)
    slim = df.select(*keys, ts, y)
    unique = dedup_ordered(slim, [*keys, ts], [y], keep="last")
    return interpolate_linear(regularize(unique, key, ts, end), key, ts, y)


def history_slice(df: DataFrame, ts: str, ref: datetime, hours: int = 388) -> DataFrame:
    """Rows of the last ``hours`` hours up to and including the reference time."""
    start = ref - timedelta(hours=hours)
    return df.filter((F.col(ts) >= F.lit(start)) & (F.col(ts) <= F.lit(ref)))


def _at(ts: str, y: str, ref: datetime, hours: int = 0) -> Column:
    return F.max(F.when(F.col(ts) == F.lit(ref - timedelta(hours=hours)), F.col(y)))


def _within(ts: str, y: str, ref: datetime, hours: int) -> Column:
    """Values of the ``hours`` hours that end at the reference time."""
    start = ref - timedelta(hours=hours - 1)
    return F.when(F.col(ts).between(F.lit(start), F.lit(ref)), F.col(y))


STATS = {"min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_samp}


def window_stats(ts, y, ref, sizes, stem, names=("min", "max", "mean", "std")) -> list[Column]:
    return [
        STATS[name](_within(ts, y, ref, n)).alias(f"{stem}_{name}_{n}h") for n in sizes for name in names
    ]


def lags_at(ts, y, ref, lags, stem, offset: int = 0) -> list[Column]:
    return [_at(ts, y, ref, n - offset).alias(f"{stem}_{n}h") for n in lags]


def stats_at(
    df: DataFrame, key, ts: str, y: str, ref: datetime, sizes: Iterable[int] = DEMAND_WINDOWS, stem="demand_rolling"
) -> DataFrame:
    """Window statistics that end at and include the reference time; one aggregate per series."""
    sizes = list(sizes)
    scope = history_slice(df, ts, ref, max(sizes) - 1)
    return scope.groupBy(*as_keys(key)).agg(*window_stats(ts, y, ref, sizes, stem))


def demand_features_at(
    df: DataFrame,
    key,
    ts: str,
    y: str,
    ref: datetime,
    lags: Iterable[int] = DEMAND_LAGS,
    sizes: Iterable[int] = DEMAND_WINDOWS,
) -> DataFrame:
    """Lags, window statistics, changes and ratios at the reference time.

    Relative changes are percentages here, as the scoring side expects them.
    """
    lags, sizes = sorted({*lags, 1, 24, 168}), sorted({*sizes, 24, 168})
    scope = history_slice(df, ts, ref, max(*lags, *sizes))
    wide = scope.groupBy(*as_keys(key)).agg(
        _at(ts, y, ref).alias("_ref"),
        *lags_at(ts, y, ref, lags, "demand_lag"),
        *window_stats(ts, y, ref, sizes, "demand_rolling"),
    )
    now = F.col("_ref")
    changes = {f"demand_change_{n}h": now - F.col(f"demand_lag_{n}h") for n in (1, 24, 168)}
    relative = {
        f"demand_pct_change_{n}h": pct_change(now, f"demand_lag_{n}h", scale=100.0, eps=1e-6) for n in (1, 24)
    }
    ratio = {"demand_ratio_24h_168h": safe_ratio("demand_lag_24h", "demand_lag_168h", eps=1e-6)}
    versus = {
        f"demand_vs_rolling_mean_{n}h": now - F.col(f"demand_rolling_mean_{n}h") for n in (24, 168)
    }
    return wide.withColumns({**changes, **relative, **ratio, **versus}).drop("_ref")


def weather_stats_at(
    df: DataFrame,
    key,
    ts: str,
    ref: datetime,
    lags: Iterable[int] = WEATHER_LAGS,
    sizes: Iterable[int] = DEMAND_WINDOWS,
    lag_offset: int = 0,
) -> DataFrame:
    """Weather history at the reference time: lags, changes, rolling statistics.

    ``lag_offset=1`` shifts the temperature lags one hour later, as the weekly model has them.
    """
    lags, sizes = list(lags), list(sizes)
    wide_sizes = [n for n in sizes if n in (24, 72, 168)]
    t, rh, rain = "temperature_c", "relative_humidity_pct", "precipitation_mm"
    scope = history_slice(df, ts, ref, max(*lags, *sizes))
    narrow = [n for n in sizes if n not in wide_sizes]
    wide = scope.groupBy(*as_keys(key)).agg(
        _at(ts, t, ref).alias(t),
        _at(ts, rain, ref).alias(rain),
        *lags_at(ts, t, ref, lags, "temperature_lag", lag_offset),
        *lags_at(ts, rh, ref, lags, "humidity_lag"),
        *window_stats(ts, t, ref, wide_sizes, "temperature_rolling"),
        *window_stats(ts, t, ref, narrow, "temperature_rolling", ("mean",)),
        *window_stats(ts, rh, ref, sizes, "humidity_rolling", ("mean",)),
        *[
            F.coalesce(F.sum(_within(ts, rain, ref, n)), F.lit(0.0)).alias(f"precipitation_rolling_sum_{n}h")
            for n in wide_sizes
        ],
        *[_at(ts, t, ref, n).alias(f"_t{n}") for n in (1, 6, 24)],
    )
    changes = {f"temperature_change_{n}h": F.col(t) - F.col(f"_t{n}") for n in (1, 6, 24)}
    return wide.withColumns(changes).drop("_t1", "_t6", "_t24")


def attach_by_zone(targets: DataFrame, features: DataFrame, key="zone") -> DataFrame:
    """The features of a zone on each of its target hours."""
    return attach(targets, features, key)


def interval_bits(interval: str) -> Column:
    """Set of interval numbers as a bit mask, a fixed-size state that also works on streams."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1), F.col(interval).cast("int")))


def rollup_complete_hours(
    df: DataFrame, key, hour: str, interval: str, y: str, need: int = 12
) -> DataFrame:
    """Intervals to hours: mean, min, max, distinct and last interval; incomplete hours are left out."""
    hourly = df.groupBy(*as_keys(key), hour).agg(
        F.avg(y).alias("demand_mw"),
        F.bit_count(interval_bits(interval)).alias("interval_count"),
        F.min(y).alias("demand_min_mw"),
        F.max(y).alias("demand_max_mw"),
        F.max(interval).alias("last_interval"),
    )
    return hourly.filter(F.col("interval_count") >= need)


def newest(df: DataFrame, ts: str) -> datetime | None:
    """Newest time of a frame, read on the driver as one value."""
    return df.agg(F.max(ts)).first()[0]
