"""Projections, filters and reshaping."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.timecols import micros, seconds
from panelcast.operators.blocks import HOUR, MICRO
from panelcast.schemas import require_columns

# Fixed value: names under which reports carry totals instead of geographic zones.
AGGREGATE_ZONES = "(?i)^(diff|total|zone.?total|market)$"
# Report columns that are totals, compared trimmed and in lower case.
AGGREGATE_COLUMNS = {"zone total", "diff", "market demand", "market_demand"}
# Columns that are never model inputs.
NEVER_FEATURES = ["datetime", "date", "load_mw", "demand", "target"]


def coerce_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Columns as doubles; text that is no number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def require_non_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def exclude_aggregates(df: DataFrame, key: str = "zone", pattern: str = AGGREGATE_ZONES) -> DataFrame:
    return df.filter(~F.col(key).rlike(pattern))


def zone_columns(columns: Iterable[str], technical: Iterable[str]) -> list[str]:
    """Report columns that are geographic zones."""
    technical = set(technical)
    return [c for c in columns if c not in technical and c.strip().lower() not in AGGREGATE_COLUMNS]


def select_ordered(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Projection in the given order, repeats dropped, absent names raise."""
    ordered = list(dict.fromkeys(columns))
    return require_columns(df, ordered).select(*ordered)


def unpivot_zones(
    df: DataFrame, ids: Iterable[str], zones: Iterable[str], name: str = "zone", value: str = "demand_mw"
) -> DataFrame:
    """One column per zone to one row per zone."""
    return df.unpivot(list(ids), list(zones), name, value)


def map_labels(df: DataFrame, key: str, mapping: dict[str, str], strict: bool = False) -> DataFrame:
    """Trim and relabel a key. ``strict`` fails the job on a label the mapping lacks."""
    trimmed = F.trim(F.col(key))
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    known = F.try_element_at(F.create_map(*pairs), trimmed) if pairs else F.lit(None).cast("string")
    if strict:
        message = F.concat(F.lit("no label for "), F.coalesce(trimmed, F.lit("null")))
        other = F.raise_error(message).cast("string")
    else:
        other = trimmed
    return df.withColumn(key, F.coalesce(known, other))


def split_global_zonal(
    df: DataFrame,
    ts: str = "datetime",
    technical: Iterable[str] = ("Date", "Hour", "datetime", "SourceYear"),
    total: str = "Ontario Demand",
    market: str = "Market Demand",
    total_label: str = "Ontario",
) -> tuple[DataFrame, DataFrame]:
    """A wide report as its table of totals and its long zonal table."""
    require_columns(df, [ts, total])
    market_demand = F.col(market).try_cast("double") if market in df.columns else F.lit(None).cast("double")
    totals = df.select(
        F.col(ts),
        market_demand.alias("market_demand"),
        F.col(total).try_cast("double").alias("ontario_demand"),
    ).dropna(subset=[ts])
    zones = zone_columns(df.columns, {*technical, ts})
    numbers = coerce_numeric(df.select(ts, *zones), zones)
    long = require_non_null(unpivot_zones(numbers, [ts], zones), [ts, "zone", "demand_mw"])
    return totals, map_labels(long, "zone", {total: total_label})


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


# Weather service names on the left, model names on the right.
FORECAST_NAMES = {
    "weather_target_temperature_2m": "weather_target_temperature_c",
    "weather_target_relative_humidity_2m": "weather_target_relative_humidity_pct",
    "weather_target_dew_point_2m": "weather_target_dew_point_c",
    "weather_target_wind_speed_10m": "weather_target_wind_speed_kmh",
    "weather_target_precipitation": "weather_target_precipitation_mm",
}
CLIMATE_NAMES = {
    "TEMP": "temperature_c",
    "DEW_POINT_TEMP": "dew_point_c",
    "RELATIVE_HUMIDITY": "relative_humidity_pct",
    "WIND_SPEED": "wind_speed_kmh",
    "PRECIP_AMOUNT": "precipitation_mm",
}


def recent(
    df: DataFrame, ts: str, days: int, today: date, year: str | None = None, month: str | None = None
) -> DataFrame:
    """Rows from ``days`` days before ``today`` on.

    Name the partition columns ``year`` / ``month`` derived from ``ts`` and older partitions
    are not even listed.
    """
    start = today - timedelta(days=days)
    out = df.filter(F.col(ts) >= F.lit(datetime(start.year, start.month, start.day)))
    if year and month:
        out = out.filter(
            (F.col(year) > start.year) | ((F.col(year) == start.year) & (F.col(month) >= start.month))
        )
    return out


def in_window(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Rows with ``start <= ts < end``."""
    return df.filter((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))


def incremental_window(
    df: DataFrame, ts: str, now: datetime, days: int = 7, backfill: bool = False, start: datetime = datetime(2020, 1, 1)
) -> DataFrame:
    """Everything since a fixed start, or the last ``days`` days up to ``now``."""
    since = start if backfill else now - timedelta(days=days)
    return df.filter((F.col(ts) >= F.lit(since)) & (F.col(ts) <= F.lit(now)))


def stitch_history_forecast(
    history: DataFrame, forecast: DataFrame, ts: str, now: datetime, start: datetime, end: datetime
) -> DataFrame:
    """Observed hours before ``now`` and forecast hours from ``now`` through ``end``."""
    past = history.filter((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(now)))
    future = forecast.filter((F.col(ts) >= F.lit(now)) & (F.col(ts) <= F.lit(end)))
    return past.unionByName(future)


def require_hours(stitched: DataFrame, key: str, start: datetime, end: datetime) -> DataFrame:
    """Keys with fewer rows than the window has hours; empty means the stitch is usable."""
    need = int((end - start).total_seconds() // HOUR)
    return stitched.groupBy(key).agg(F.count(F.lit(1)).alias("hours")).filter(F.col("hours") < need)


def numeric_features(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns that may serve as model inputs."""
    banned = {*NEVER_FEATURES, *exclude}
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in banned
    ]


def valid_horizon(
    df: DataFrame,
    lo: int = 1,
    hi: int = 168,
    horizon: str = "forecast_horizon_hours",
    issue: str = "issue_datetime",
    target: str = "target_datetime",
) -> DataFrame:
    """Rows whose horizon lies in range and equals the hours between issue and target."""
    apart = micros(target) - micros(issue)
    stated = F.col(horizon).cast("long") * F.lit(HOUR * MICRO)
    return df.filter(F.col(horizon).between(lo, hi) & (apart == stated))


def is_fresh(df: DataFrame, ingestion_col: str, now: datetime, hours: float = 4) -> DataFrame:
    """One row: the newest load, its age and whether it is younger than ``hours``."""
    newest = F.max(ingestion_col)
    age = (seconds(F.lit(now)) - seconds(newest)) / F.lit(float(HOUR))
    return df.agg(
        newest.alias("last_ingestion"),
        age.alias("age_hours"),
        F.coalesce(age < hours, F.lit(False)).cast("int").alias("is_fresh"),
    )


def training_view(df: DataFrame, flag: str = "is_training_row") -> DataFrame:
    return df.filter(F.col(flag) == 1)


