"""Feature tables for the day-ahead and the week-ahead model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from panelcast.functions.holidays import HOLIDAY_FLAGS
from panelcast.functions.scalars import (
    delta,
    holiday_interactions,
    horizon_features,
    pct_change,
    safe_ratio,
    target_weather,
    weather_interactions,
)
from panelcast.functions.timecols import add_hours, cyclic, date_parts, day_parts, micros, to_local
from panelcast.operators.blocks import DAY, HOUR, MICRO, as_keys, default_tasks, over_row_blocks, over_time_blocks
from panelcast.operators.calendar import with_calendar
from panelcast.operators.projection import coerce_numeric, require_non_null, select_ordered
from panelcast.operators.quality import coalesce_duplicates, validity_flags
from panelcast.operators.series import DEMAND_LAGS, DEMAND_WINDOWS, WEATHER_LAGS
from panelcast.operators.windows import checked_shift, rolling_columns
from panelcast.schemas import WEATHER_MEASURES, require_columns

STD_WINDOWS = [6, 24, 72, 168]
WIDE_WINDOWS = [24, 72, 168]
TARGET_NAMES = {
    "demand_mw": "target_demand_mw",
    **{c: f"weather_target_{c}" for c in WEATHER_MEASURES},
}
ESSENTIAL_24H = [
    "demand_lag_1h", "demand_lag_24h", "demand_lag_168h", "demand_rolling_mean_24h",
    "weather_target_temperature_c", "weather_target_relative_humidity_pct",
]
ESSENTIAL_7D = ESSENTIAL_24H[:4]

METADATA = [
    "zone", "issue_datetime", "target_datetime", "forecast_horizon_hours", "issue_date", "target_date",
    "issue_year", "issue_month", "issue_day", "issue_hour",
    "target_year", "target_month", "target_day", "target_hour",
]
TEMPORAL = [
    "issue_day_of_week", "issue_day_of_year", "issue_is_weekend", "issue_hour_sin", "issue_hour_cos",
    "target_day_of_week", "target_day_of_year", "target_is_weekend",
    *[f"target_{part}_{w}" for part in ("hour", "day_of_week", "month", "day_of_year") for w in ("sin", "cos")],
    *[f"target_time_{part}" for part in ("morning", "afternoon", "evening", "night")],
]
HORIZON = [
    "forecast_day", "forecast_hour_in_day",
    "forecast_horizon_sin_24h", "forecast_horizon_cos_24h",
    "forecast_horizon_sin_168h", "forecast_horizon_cos_168h",
    "forecast_horizon_sqrt", "forecast_horizon_log1p",
]
WEATHER_HISTORY = [
    *[f"{m}_lag_{n}h" for m in ("temperature", "humidity") for n in WEATHER_LAGS],
    *[f"temperature_change_{n}h" for n in (1, 6, 24)],
    *[f"{m}_rolling_mean_{n}h" for m in ("temperature", "humidity") for n in DEMAND_WINDOWS],
    *[f"temperature_rolling_{f}_{n}h" for f in ("min", "max", "std") for n in WIDE_WINDOWS],
    *[f"precipitation_rolling_sum_{n}h" for n in WIDE_WINDOWS],
]
TARGET_WEATHER = [
    *[f"weather_target_{c}" for c in WEATHER_MEASURES],
    *[
        f"weather_target_{c}"
        for c in (
            "temperature_sq", "temperature_cube", "hdd18", "cdd18", "hdd15_5", "cdd15_5",
            "temp_dew_spread", "wet_bulb_approx_c", "is_precipitation", "is_high_humidity", "is_strong_wind",
        )
    ],
]
DEMAND_HISTORY = [
    *[f"demand_lag_{n}h" for n in DEMAND_LAGS],
    *[f"demand_change_{n}h" for n in (1, 24, 168)],
    "demand_pct_change_1h", "demand_pct_change_24h", "demand_ratio_24h_168h",
    *[f"demand_rolling_{f}_{n}h" for f in ("mean", "min", "max") for n in DEMAND_WINDOWS],
    *[f"demand_rolling_std_{n}h" for n in STD_WINDOWS],
    *[f"demand_vs_rolling_mean_{n}h" for n in (24, 168)],
]
INTERACTIONS = [
    *[f"weather_target_{m}_x_hour_{w}" for m in ("temperature", "hdd18", "cdd18") for w in ("sin", "cos")],
    *[f"weather_target_{m}_x_weekend" for m in ("hdd18", "cdd18")],
    "weather_target_temperature_x_humidity",
    *[f"weather_target_{m}_x_holiday" for m in ("hdd18", "cdd18")],
    "holiday_x_target_hour_sin", "holiday_x_target_hour_cos",
]
CALENDAR = [*HOLIDAY_FLAGS, "is_holiday", "is_day_before_holiday", "is_day_after_holiday"]
FLAGS = ["has_valid_features", "has_valid_target", "is_training_row"]

FEATURES_24H = [
    *TEMPORAL, *WEATHER_MEASURES, *WEATHER_HISTORY, *TARGET_WEATHER, *DEMAND_HISTORY, *INTERACTIONS, *CALENDAR,
]
FEATURES_7D = [*TEMPORAL, *HORIZON, *FEATURES_24H[len(TEMPORAL):]]


def clean_panel(silver: DataFrame, order: str | None = None) -> DataFrame:
    """Checked, numeric rows, one per key.

    Repeated keys are merged: per column the first value that is not null, by ``order`` or else by the measures.
    """
    measures = ["demand_mw", *WEATHER_MEASURES]
    needed = require_columns(silver, ["zone", "datetime", *measures])
    slim = needed.select("zone", "datetime", *measures, *([order] if order else []))
    typed = coerce_numeric(slim, measures).withColumn("datetime", F.col("datetime").cast("timestamp"))
    keyed = require_non_null(typed, ["zone", "datetime", "demand_mw"])
    if order is None:
        keyed, order = keyed.withColumn("_order", F.struct(*measures)), "_order"
    return coalesce_duplicates(keyed, ["zone", "datetime"], order).drop(order)


def history_windows(w: WindowSpec) -> dict[str, Column]:
    """All backward-looking window columns of an issue hour."""
    out = {f"demand_lag_{n}h": checked_shift("datetime", "demand_mw", n, w) for n in DEMAND_LAGS}
    out |= rolling_columns(w, "demand_mw", "demand_rolling", DEMAND_WINDOWS, ["mean", "min", "max"], False)
    out |= rolling_columns(w, "demand_mw", "demand_rolling", STD_WINDOWS, ["std"], False)
    for column, stem in (("temperature_c", "temperature"), ("relative_humidity_pct", "humidity")):
        out |= {f"{stem}_lag_{n}h": F.lag(column, n).over(w) for n in WEATHER_LAGS}
        out |= rolling_columns(w, column, f"{stem}_rolling", DEMAND_WINDOWS, ["mean"], True)
    out |= rolling_columns(w, "temperature_c", "temperature_rolling", WIDE_WINDOWS, ["min", "max", "std"], True)
    return out | rolling_columns(w, "_rain", "precipitation_rolling", WIDE_WINDOWS, ["sum"], True)


def history_changes() -> dict[str, Column]:
    out = {f"demand_change_{n}h": delta("demand_mw", f"demand_lag_{n}h") for n in (1, 24, 168)}
    out |= {f"demand_pct_change_{n}h": pct_change("demand_mw", f"demand_lag_{n}h") for n in (1, 24)}
    out["demand_ratio_24h_168h"] = safe_ratio("demand_lag_24h", "demand_lag_168h")
    out |= {f"demand_vs_rolling_mean_{n}h": delta("demand_mw", f"demand_rolling_mean_{n}h") for n in (24, 168)}
    out |= {f"temperature_change_{n}h": delta("temperature_c", f"temperature_lag_{n}h") for n in (1, 6, 24)}
    return out


def _local(ts: str, tz: str) -> Column:
    return F.col(ts) if tz == "UTC" else to_local(ts, tz)


def issue_time(tz: str) -> dict[str, Column]:
    parts = date_parts(_local("issue_datetime", tz), "issue_")
    return parts | cyclic(parts["issue_hour"], 24, "issue_hour")


def target_hour_columns(tz: str) -> dict[str, Column]:
    """What depends on the hour of the target time."""
    local = _local("target_datetime", tz)
    hour = F.hour(local)
    return {
        "target_date": F.to_date(local),
        "target_hour": hour,
        **cyclic(hour, 24, "target_hour"),
        **day_parts(hour, "target_time_"),
    }


def target_day_columns(day: str) -> dict[str, Column]:
    """What depends on the day of the target time only."""
    parts = date_parts(day, "target_")
    return {
        **{n: c for n, c in parts.items() if n not in ("target_date", "target_hour")},
        **cyclic(parts["target_day_of_week"], 7, "target_day_of_week"),
        **cyclic(parts["target_month"], 12, "target_month", offset=1),
        **cyclic(parts["target_day_of_year"], 365.25, "target_day_of_year", offset=1),
    }


def _target_features(df: DataFrame, tz: str, years: tuple[int, int] | None) -> DataFrame:
    hourly = df.withColumns(target_hour_columns(tz))
    dated = with_calendar(hourly, "target_date", years, target_day_columns)
    weather = dated.withColumns(target_weather())
    return weather.withColumns({**weather_interactions(), **holiday_interactions()})


def features_24h(
    silver: DataFrame,
    horizon: int = 24,
    tz: str = "UTC",
    years: tuple[int, int] | None = None,
    order: str | None = None,
    rows: int | None = None,
) -> DataFrame:
    """One row per zone and issue hour with the target ``horizon`` hours ahead.

    All window columns share one row-block layout, so the panel is shuffled twice whatever the
    number of features.
    """
    panel = clean_panel(silver, order).withColumn("_rain", F.coalesce("precipitation_mm", F.lit(0.0)))

    def build(w):
        ahead = {name: checked_shift("datetime", c, -horizon, w) for c, name in TARGET_NAMES.items()}
        return history_windows(w) | ahead

    windowed = over_row_blocks(
        panel, "zone", "datetime", build, back=max(DEMAND_LAGS), ahead=horizon, rows=rows, tasks=default_tasks(panel)
    )
    issued = windowed.withColumns(history_changes()).withColumnRenamed("datetime", "issue_datetime")
    timed = issued.withColumns(
        {
            "forecast_horizon_hours": F.lit(horizon),
            "target_datetime": add_hours("issue_datetime", horizon),
            **issue_time(tz),
        }
    )
    full = validity_flags(_target_features(timed, tz, years), ESSENTIAL_24H, "target_demand_mw")
    return select_ordered(full, [*METADATA, *FEATURES_24H, *FLAGS, "demand_mw", "target_demand_mw"])


def expand_with_targets(
    df: DataFrame,
    columns: dict[str, str],
    lo: int = 1,
    hi: int = 168,
    key="zone",
    ts: str = "datetime",
    step: int = HOUR,
    width: int | None = None,
    horizon: str = "forecast_horizon_hours",
) -> DataFrame:
    """One row per issue and horizon with the values at the target time.

    Same rows as expanding and then joining on the target time, but the coming values are
    gathered per issue in a bounded range frame before the rows multiply. What is shuffled is the
    panel, not the panel times the number of horizons. Rows meet only rows that lie a whole number of
    steps away, so a panel finer than the step gathers no more values than there are horizons either.
    """
    unit = step * MICRO
    picked = [F.col(c).alias(name) for c, name in columns.items()]

    def build(w):
        coming = w.rangeBetween(lo * unit, hi * unit)
        return {"_coming": F.collect_list(F.struct("_t", *picked)).over(coming)}

    kinds = dict(df.dtypes)
    # each task multiplies its rows: short blocks (halo copies are dropped before the rows multiply)
    # and a fixed task count keep the tasks small and even
    width = width or max(hi * step, 7 * DAY)
    phased = df.withColumn("_phase", F.pmod(micros(ts), F.lit(unit)))
    gathered = over_time_blocks(
        phased, [*as_keys(key), "_phase"], ts, build, ahead=hi * step, width=width, tasks=default_tasks(df)
    )
    now = micros(ts)
    present = F.transform(
        "_coming",
        lambda x: F.struct(
            ((x["_t"] - now) / F.lit(unit)).cast("int").alias(horizon), *[x[n].alias(n) for n in columns.values()]
        ),
    )
    absent = F.transform(
        F.array_except(F.sequence(F.lit(lo), F.lit(hi)), F.transform(present, lambda x: x[horizon])),
        lambda h: F.struct(
            h.alias(horizon), *[F.lit(None).cast(kinds[c]).alias(n) for c, n in columns.items()]
        ),
    )
    kept = [c for c in gathered.columns if c not in ("_coming", "_phase")]
    expanded = gathered.select(*kept, F.inline(F.concat(present, absent)))
    return expanded.withColumn("target_datetime", add_hours(ts, horizon))


def features_7d(
    silver: DataFrame,
    lo: int = 1,
    hi: int = 168,
    tz: str = "UTC",
    years: tuple[int, int] | None = None,
    order: str | None = None,
    rows: int | None = None,
    width: int | None = None,
) -> DataFrame:
    """One row per zone, issue hour and horizon."""
    panel = clean_panel(silver, order).withColumn("_rain", F.coalesce("precipitation_mm", F.lit(0.0)))
    windowed = over_row_blocks(
        panel, "zone", "datetime", history_windows, back=max(DEMAND_LAGS), rows=rows, tasks=default_tasks(panel)
    )
    issued = windowed.withColumns(history_changes())
    expanded = expand_with_targets(issued, TARGET_NAMES, lo, hi, width=width)
    timed = expanded.withColumnRenamed("datetime", "issue_datetime").withColumns(
        {**issue_time(tz), **horizon_features()}
    )
    full = validity_flags(_target_features(timed, tz, years), ESSENTIAL_7D, "target_demand_mw")
    return select_ordered(full, [*METADATA, *FEATURES_7D, *FLAGS, "demand_mw", "target_demand_mw"])
