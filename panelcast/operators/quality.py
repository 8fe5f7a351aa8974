"""Deduplication, validity flags and data-quality reports."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.timecols import age_minutes, seconds
from panelcast.operators.blocks import HOUR, as_keys, over_row_blocks
from panelcast.operators.projection import require_non_null

__all__ = [
    "check_bounds", "coalesce_duplicates", "complete_horizons", "coverage_rate", "dedup_any",
    "dedup_ordered", "duplicate_keys", "feature_coverage", "feed_delay", "gap_count", "gaps",
    "history_depth", "horizon_coverage", "layer_summary", "overlap_report", "quality_report",
    "require_non_null", "require_unique", "short_history", "validity_flags", "zone_diff",
    "zone_summary",
]


def _rest(df: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def dedup_ordered(df: DataFrame, key, order, keep: str = "first") -> DataFrame:
    """One row per key, the first or last in the given order.

    The rank limit is a literal, so Spark drops the losers of a hot key before the shuffle.
    """
    columns = [F.col(c) for c in as_keys(order)]
    ordering = [c.asc() if keep == "first" else c.desc() for c in columns]
    ranked = Window.partitionBy(*as_keys(key)).orderBy(*ordering)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def dedup_any(df: DataFrame, key) -> DataFrame:
    """One row per key, whichever; the whole row serves as order so that reruns agree."""
    keys = as_keys(key)
    if not _rest(df, keys):
        return df.distinct()
    smallest = F.min(F.struct(*_rest(df, keys))).alias("_row")
    picked = df.groupBy(*keys).agg(smallest)
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def coalesce_duplicates(df: DataFrame, key, order: str) -> DataFrame:
    """Merge the rows of a key: per column the first non-null value in the given order."""
    keys = as_keys(key)
    firsts = [
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
        for c in _rest(df, keys)
        if c != order
    ]
    merged = df.groupBy(*keys).agg(*firsts, F.min(order).alias(order))
    return merged.select(*df.columns)


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    return (
        df.groupBy(*as_keys(key)).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)
    )


def require_unique(df: DataFrame, key) -> DataFrame:
    """Raise if any key repeats; stops at the first one found."""
    if not duplicate_keys(df, key).isEmpty():
        raise ValueError("duplicate rows for key " + ", ".join(as_keys(key)))
    return df


def gaps(df: DataFrame, key, ts: str, step: int = HOUR, rows=None) -> DataFrame:
    """Hours since the previous row of the series, and whether that is not one step."""

    def build(w):
        since = (seconds(ts) - seconds(F.lag(ts, 1).over(w))) / F.lit(float(HOUR))
        return {"hours_since_previous": since}

    out = over_row_blocks(df, key, ts, build, back=1, rows=rows)
    off = F.col("hours_since_previous") != step / HOUR
    return out.withColumn("is_gap", F.when(off, 1).otherwise(0))


def gap_count(df: DataFrame, key, ts: str, step: int = HOUR) -> DataFrame:
    return gaps(df, key, ts, step).groupBy(*as_keys(key)).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("is_gap").alias("gap_count")
    )


def validity_flags(df: DataFrame, essential: Iterable[str], target: str) -> DataFrame:
    """0/1 flags: essential features present, target present, both."""
    holes = F.size(F.array_compact(F.array(F.lit(None).cast("int"), *[F.when(F.isnull(c), 1) for c in essential])))
    flagged = df.withColumns({"has_valid_features": F.when(holes > 0, 0).otherwise(1), "has_valid_target": F.nvl2(F.col(target), F.lit(1), F.lit(0))})
    return flagged.withColumn("is_training_row", F.least("has_valid_features", "has_valid_target"))


def overlap_report(a: DataFrame, b: DataFrame, key: str, ts: str) -> DataFrame:
    """Per key the rows and period on both sides, and whether both sides hold it."""

    def side(df, tag):
        return df.groupBy(key).agg(
            F.count(F.lit(1)).alias(f"{tag}_rows"),
            F.min(ts).alias(f"{tag}_first"),
            F.max(ts).alias(f"{tag}_last"),
        )

    both = side(a, "left").join(side(b, "right"), key, "full")
    shared = F.col("left_rows").isNotNull() & F.col("right_rows").isNotNull()
    return both.withColumn("is_shared", shared.cast("int"))


def zone_diff(a: DataFrame, b: DataFrame, key: str = "zone") -> DataFrame:
    """Keys that only one of two frames holds, with the side they are missing from."""
    left, right = a.select(key).distinct(), b.select(key).distinct()
    only_left = left.join(right, key, "left_anti").withColumn("missing_from", F.lit("right"))
    only_right = right.join(left, key, "left_anti").withColumn("missing_from", F.lit("left"))
    return only_left.unionByName(only_right)


def history_depth(df: DataFrame, key: str, ts: str, y: str, need: int = 336) -> DataFrame:
    """Rows, period, missing values and available hours per series."""
    depth = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(ts).alias("first_datetime"),
        F.max(ts).alias("last_datetime"),
        F.count_if(F.col(y).isNull()).alias("missing_demand"),
    )
    hours = (seconds("last_datetime") - seconds("first_datetime")) / F.lit(float(HOUR)) + 1
    return depth.withColumn("available_hours", hours).withColumn(
        "is_short", (F.col("available_hours") < need).cast("int")
    )


def short_history(df: DataFrame, key: str, ts: str, y: str, need: int = 336) -> DataFrame:
    return history_depth(df, key, ts, y, need).filter("is_short = 1").drop("is_short")


#: Horizons in one mask of a whole number.
MASK_BITS = 62


def _completeness(df: DataFrame, lo: int, hi: int, key, horizon: str) -> DataFrame:
    """Per issue whether its horizons are exactly those of the range; masks are or-ed before the shuffle."""
    place = F.col(horizon) - lo
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(MASK_BITS)).cast("int"))
    words = range((hi - lo) // MASK_BITS + 1)
    masks = [F.bit_or(F.when(F.floor(place / MASK_BITS) == w, bit)).alias(f"_mask{w}") for w in words]
    spans = df.groupBy(*as_keys(key)).agg(F.min(horizon).alias("_least"), F.max(horizon).alias("_most"), *masks)
    held = sum((F.bit_count(F.coalesce(F.col(f"_mask{w}"), F.lit(0).cast("long"))) for w in words), F.lit(0))
    whole = (F.col("_least") == lo) & (F.col("_most") == hi) & (held == hi - lo + 1)
    return spans.select(*as_keys(key), F.coalesce(whole, F.lit(False)).alias("is_complete"))


def complete_horizons(
    df: DataFrame, lo: int, hi: int, key=("issue_datetime", "zone"), horizon: str = "forecast_horizon_hours"
) -> DataFrame:
    """Rows of the issues that hold every horizon of the range."""
    complete = _completeness(df, lo, hi, key, horizon).filter("is_complete")
    return df.join(complete.select(*as_keys(key)), as_keys(key), "left_semi")


def coverage_rate(
    df: DataFrame, lo: int, hi: int, key=("issue_datetime", "zone"), horizon: str = "forecast_horizon_hours"
) -> DataFrame:
    """How many issues there are and what share of them is complete."""
    done = F.col("is_complete").cast("int")
    return _completeness(df, lo, hi, key, horizon).agg(
        F.count(F.lit(1)).alias("issues"),
        F.sum(done).alias("complete_issues"),
        F.avg(done).alias("coverage_rate"),
    )


# Plausible ranges of the weather measures (C, %, km/h).
WEATHER_BOUNDS = {
    "temperature_c": (-50.0, 50.0),
    "relative_humidity_pct": (0.0, 100.0),
    "wind_speed_kmh": (0.0, 150.0),
}


def quality_report(df: DataFrame, columns: Iterable[str], bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Missing and out-of-range counts per column, from one pass over the rows."""
    columns = list(columns)

    def outside(c):
        if c not in bounds:
            return F.lit(False)
        lo, hi = bounds[c]
        return (F.col(c) < lo) | (F.col(c) > hi)

    counts = [F.count(F.lit(1)).alias("total_rows")]
    for c in columns:
        counts.append(F.count_if(F.col(c).isNull()).alias(f"missing_{c}"))
        counts.append(F.count_if(outside(c)).alias(f"outliers_{c}"))
    one = df.agg(*counts)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"missing_{c}").alias("missing_values"),
                F.col(f"outliers_{c}").alias("outliers"),
            )
            for c in columns
        ]
    )
    faults = reduce(or_, (F.col(f"{kind}_{c}") > 0 for kind in ("missing", "outliers") for c in columns))
    return one.select("total_rows", (~faults).cast("int").alias("all_valid"), F.inline(rows))


def check_bounds(df: DataFrame, hour: str = "hour", interval: str = "interval", strict: bool = False) -> DataFrame:
    """Counts of hours outside 1..24 and intervals outside 1..12; ``strict`` fails the job on any."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col(hour).between(1, 24)).alias("bad_hours"),
        F.count_if(~F.col(interval).between(1, 12)).alias("bad_intervals"),
    )
    if strict:
        bad = (F.col("bad_hours") > 0) | (F.col("bad_intervals") > 0)
        counted = counted.withColumn(
            "rows", F.when(bad, F.raise_error(F.lit("hour or interval out of range")).cast("long")).otherwise(F.col("rows"))
        )
    return counted


def feature_coverage(columns: Iterable[str], expected: Iterable[str]) -> dict[str, list[str]]:
    """Which expected features a frame's columns hold and lack."""
    have, want = set(columns), set(expected)
    return {"present": sorted(want & have), "missing": sorted(want - have)}


def feed_delay(df: DataFrame, ts: str, now, limit_minutes: float = 180) -> DataFrame:
    """Newest time of a feed, its age in minutes and whether that is over the limit."""
    newest = df.agg(F.max(ts).alias("latest"))
    age = age_minutes("latest", F.lit(now))
    return newest.withColumn("delay_minutes", age).withColumn(
        "is_late", F.when(F.col("delay_minutes") > limit_minutes, 1).otherwise(0)
    )


def layer_summary(
    df: DataFrame, key: str, times: Iterable[str], flags: Iterable[str] = (), means: Iterable[str] = ()
) -> DataFrame:
    """All checks of a layer in one aggregate: rows, series, periods, flag sums, means."""
    parts = [F.count(F.lit(1)).alias("total_rows"), F.count_distinct(key).alias("zones")]
    for t in times:
        parts += [F.min(t).alias(f"min_{t}"), F.max(t).alias(f"max_{t}")]
    parts += [F.sum(f).alias(f"sum_{f}") for f in flags]
    parts += [F.avg(m).alias(f"avg_{m}") for m in means]
    return df.agg(*parts)


def zone_summary(
    df: DataFrame,
    key: str,
    means: dict[str, str],
    ts: str | None = None,
    flags: Iterable[str] = (),
    missing: Iterable[str] = (),
    digits: int = 2,
) -> DataFrame:
    """Per series: rows, period, flag sums, rounded means and the share of missing values."""
    parts = [F.count(F.lit(1)).alias("observations")]
    if ts:
        parts += [F.min(ts).alias("first_obs"), F.max(ts).alias("last_obs")]
    parts += [F.sum(f).alias(f"sum_{f}") for f in flags]
    parts += [F.round(F.avg(c), digits).alias(name) for c, name in means.items()]
    for c in missing:
        share = F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0))
        parts.append(F.round(F.lit(100.0) * share, 3).alias(f"missing_{c}_pct"))
    return df.groupBy(key).agg(*parts)


def horizon_coverage(df: DataFrame, y: str, horizon: str = "forecast_horizon_hours") -> DataFrame:
    """Rows, rows with a target and mean target per horizon."""
    return df.groupBy(horizon).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(y).alias("rows_with_target"),
        F.avg(y).alias("mean_target"),
    )
