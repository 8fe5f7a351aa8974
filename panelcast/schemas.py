"""Table schemas and the required-column check every operator entry uses."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _D, _TS, _I, _DATE = (
    T.StringType(),
    T.DoubleType(),
    T.TimestampType(),
    T.IntegerType(),
    T.DateType(),
)

LOAD_ACTUAL = _table(
    ("datetime", _TS), ("market_demand", _D), ("ontario_demand", _D), ("ingestion_time", _TS)
)
LOAD_ZONAL = _table(("datetime", _TS), ("zone", _S), ("demand_mw", _D), ("ingestion_time", _TS))

WEATHER_MEASURES = [
    "temperature_c",
    "dew_point_c",
    "relative_humidity_pct",
    "wind_speed_kmh",
    "precipitation_mm",
]
WEATHER = _table(
    ("zone", _S),
    ("datetime", _TS),
    ("datetime_local", _TS),
    *((name, _D) for name in WEATHER_MEASURES),
    ("ingestion_time", _TS),
)
SILVER_COLUMNS = [
    "zone", "datetime", "datetime_local",
    "year", "month", "day", "hour", "day_of_week", "is_weekend",
    "demand_mw", "demand_normalized",
    *WEATHER_MEASURES, "hdd18", "cdd18",
    "ingestion_time",
]
FORECAST = _table(
    ("zone", _S), ("target_datetime", _TS), ("predicted_demand_mw", _D),
    ("prediction_time", _TS), ("target_date", _DATE),
)
FORECAST_HORIZONS = _table(
    ("zone", _S), ("target_datetime", _TS), ("forecast_horizon_hours", _I),
    ("predicted_demand_mw", _D), ("prediction_time", _TS), ("target_date", _DATE),
)
CONTRIBUTIONS = _table(
    ("zone", _S), ("target_datetime", _TS), ("feature_name", _S), ("shap_value", _D),
    ("base_value", _D), ("prediction_time", _TS), ("target_date", _DATE),
)


class MissingColumns(ValueError):
    pass


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Raise when a needed column is absent, else hand the frame back."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns("missing columns: " + ", ".join(missing))
    return df
