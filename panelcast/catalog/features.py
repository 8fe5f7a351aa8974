"""Checks of feature arithmetic and of the silver, gold and scoring tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from panelcast.catalog.base import P_FORECAST, P_HOUR, check, with_sql
from panelcast.catalog.calendars import CALENDAR, calendar_sql
from panelcast.catalog.windowing import _checked, _frame, _rolling
from panelcast.functions import scalars as sc
from panelcast.operators import calendar as cal
from panelcast.operators import evaluation as ev
from panelcast.operators import windows as wn
from panelcast.operators.evaluation import metrics
from panelcast.operators.joins import expand_horizons
from panelcast.operators.series import DEMAND_LAGS, DEMAND_WINDOWS, WEATHER_LAGS
from panelcast.plans import gold
from panelcast.plans import panels as pn
from panelcast.plans.scoring import scoring_features
from panelcast.plans.silver import silver_panel
from panelcast.schemas import WEATHER_MEASURES

W = "(PARTITION BY zone ORDER BY datetime)"
LAGGED = (
    P_HOUR
    + f""", lagged AS (SELECT *, {_checked('demand_mw', 1, 'lag1')}, {_checked('demand_mw', 24, 'lag24')},
      lag(temperature_c, 6) OVER {W} AS t6, avg(demand_mw) OVER {_frame(24, False)} AS mean24 FROM p_hour)"""
)


def _lagged(t):
    panel = pn.hourly_panel(t.events)
    both = wn.lag_checked(panel, "zone", "datetime", "demand_mw", [1, 24], stem="lag")
    both = wn.lag_rows(both, "zone", "datetime", {"temperature_c": "t"}, [6])
    both = wn.rolling_past(both, "zone", "datetime", "demand_mw", [24], ["mean"], stem="r")
    names = {"lag_1h": "lag1", "lag_24h": "lag24", "t_6h": "t6", "r_mean_24h": "mean24"}
    return both.withColumnsRenamed(names)


@check(
    "deltas_and_ratios",
    "zone s, datetime t, demand_change_1h d, temperature_change_6h d, vs_mean d, pct d, pct100 d, ratio d",
    with_sql(
        LAGGED,
        """SELECT zone, datetime, demand_mw - lag1 AS demand_change_1h, temperature_c - t6 AS temperature_change_6h,
                  demand_mw - mean24 AS vs_mean,
                  CASE WHEN abs(lag1) > 0 THEN (demand_mw - lag1) / lag1 END AS pct,
                  CASE WHEN abs(lag1) > 1e-6 THEN (demand_mw - lag1) / lag1 * 100 END AS pct100,
                  CASE WHEN abs(lag24) > 0 THEN lag1 / lag24 END AS ratio FROM lagged""",
    ),
)
def _(t):
    return _lagged(t).withColumns(
        {
            "demand_change_1h": sc.delta("demand_mw", "lag1"),
            "temperature_change_6h": sc.delta("temperature_c", "t6"),
            "vs_mean": sc.delta("demand_mw", "mean24"),
            "pct": sc.pct_change("demand_mw", "lag1"),
            "pct100": sc.pct_change("demand_mw", "lag1", scale=100.0, eps=1e-6),
            "ratio": sc.safe_ratio("lag1", "lag24"),
        }
    )


def _wet_bulb(t: str, rh: str) -> str:
    return (
        f"({t} * atan(CAST(0.151977 AS DOUBLE) * sqrt({rh} + CAST(8.313659 AS DOUBLE))) + atan({t} + {rh})"
        f" - atan({rh} - CAST(1.676331 AS DOUBLE)) + CAST(0.00391838 AS DOUBLE) * pow({rh}, CAST(1.5 AS DOUBLE))"
        f" * atan(CAST(0.023101 AS DOUBLE) * {rh}) - CAST(4.686035 AS DOUBLE))"
    )


@check(
    "weather_scalars",
    "zone s, datetime t, hdd18 d, cdd18 d, hdd15_5 d, hdd_known d, squared d, cubed d, spread d, wet_bulb d, heat_index d, rain i, humid i, windy i",
    with_sql(
        P_HOUR,
        f"""SELECT zone, datetime, greatest(18 - temperature_c, 0) AS hdd18, greatest(temperature_c - 18, 0) AS cdd18,
              greatest(CAST(15.5 AS DOUBLE) - temperature_c, 0) AS hdd15_5,
              CASE WHEN temperature_c IS NOT NULL THEN greatest(18 - temperature_c, 0) END AS hdd_known,
              pow(temperature_c, 2) AS squared, pow(temperature_c, 3) AS cubed, temperature_c - dew_point_c AS spread,
              {_wet_bulb('temperature_c', 'relative_humidity_pct')} AS wet_bulb,
              temperature_c + relative_humidity_pct / 100 * 2 AS heat_index,
              CASE WHEN precipitation_mm > 0 THEN 1 ELSE 0 END AS rain,
              CASE WHEN relative_humidity_pct >= 80 THEN 1 ELSE 0 END AS humid,
              CASE WHEN wind_speed_kmh >= 30 THEN 1 ELSE 0 END AS windy FROM p_hour""",
    ),
)
def _(t):
    return pn.hourly_panel(t.events).withColumns(
        {
            "hdd18": sc.hdd("temperature_c"),
            "cdd18": sc.cdd("temperature_c"),
            "hdd15_5": sc.hdd("temperature_c", 15.5),
            "hdd_known": sc.hdd("temperature_c", null_safe=True),
            "squared": F.pow("temperature_c", F.lit(2.0)),
            "cubed": F.pow("temperature_c", F.lit(3.0)),
            "spread": sc.delta("temperature_c", "dew_point_c"),
            "wet_bulb": sc.wet_bulb("temperature_c", "relative_humidity_pct"),
            "heat_index": sc.heat_index("temperature_c", "relative_humidity_pct"),
            "rain": sc.flag(F.col("precipitation_mm") > 0),
            "humid": sc.flag(F.col("relative_humidity_pct") >= 80),
            "windy": sc.flag(F.col("wind_speed_kmh") >= 30),
        }
    )


@check(
    "interactions",
    "zone s, datetime t, hour_x_is_weekend i, hour_x_month i, temperature_c_x_relative_humidity_pct d",
    with_sql(
        P_HOUR,
        """SELECT zone, datetime, hour(datetime) * CASE WHEN isodow(datetime) >= 6 THEN 1 ELSE 0 END AS hour_x_is_weekend,
                  hour(datetime) * month(datetime) AS hour_x_month,
                  temperature_c * relative_humidity_pct AS temperature_c_x_relative_humidity_pct FROM p_hour""",
    ),
)
def _(t):
    panel = pn.hourly_panel(t.events).withColumns(
        {
            "hour": F.hour("datetime"),
            "is_weekend": F.when(F.weekday("datetime") >= 5, 1).otherwise(0),
            "month": F.month("datetime"),
        }
    )
    pairs = [("hour", "is_weekend"), ("hour", "month"), ("temperature_c", "relative_humidity_pct")]
    return panel.withColumns(sc.interact(pairs))


def _horizon_sql(h: str) -> str:
    a = f"2 * pi() * {h}"
    return f"""CAST(floor(({h} - 1) / 24) AS INTEGER) + 1 AS forecast_day, ({h} - 1) % 24 + 1 AS forecast_hour_in_day,
      sin({a} / 24) AS forecast_horizon_sin_24h, cos({a} / 24) AS forecast_horizon_cos_24h,
      sin({a} / 168) AS forecast_horizon_sin_168h, cos({a} / 168) AS forecast_horizon_cos_168h,
      sqrt({h}) AS forecast_horizon_sqrt, ln(1 + {h}) AS forecast_horizon_log1p"""


_HORIZON = ", ".join(f"{c} {'i' if c in ('forecast_day', 'forecast_hour_in_day') else 'd'}" for c in gold.HORIZON)


@check(
    "horizon_features",
    f"zone s, issue_datetime t, target_datetime t, forecast_horizon_hours i, {_HORIZON}",
    with_sql(
        P_HOUR,
        f"""SELECT zone, datetime AS issue_datetime, datetime + to_hours(h) AS target_datetime,
                   h AS forecast_horizon_hours, {_horizon_sql('h')}
            FROM p_hour, (SELECT unnest(range(1, 169)) AS h)""",
    ),
)
def _(t):
    panel = pn.hourly_panel(t.events).select("zone", F.col("datetime").alias("issue_datetime"))
    return expand_horizons(panel, "issue_datetime", 1, 168).withColumns(sc.horizon_features())


@check(
    "minmax",
    "forecast_horizon_hours i, mape_norm d, mae_norm d",
    with_sql(
        P_FORECAST,
        """, m AS (SELECT forecast_horizon_hours,
             avg(abs(prediction_mw - target_demand_mw)) AS mae,
             avg(CASE WHEN abs(target_demand_mw) > 1e-6
                 THEN abs(prediction_mw - target_demand_mw) / abs(target_demand_mw) * 100 END) AS mape
           FROM p_forecast WHERE prediction_mw IS NOT NULL GROUP BY 1)
           SELECT forecast_horizon_hours, (mape - min(mape) OVER ()) / nullif(max(mape) OVER () - min(mape) OVER (), 0) AS mape_norm,
                  (mae - min(mae) OVER ()) / nullif(max(mae) OVER () - min(mae) OVER (), 0) AS mae_norm FROM m""",
    ),
)
def _(t):
    rows = pn.forecast_panel(t.events)
    found = metrics(rows, "target_demand_mw", "prediction_mw", "forecast_horizon_hours")
    return ev.minmax(found, ["mape", "mae"])


@check(
    "naive_forecast_by_zone",
    "zone s, observations i, mae d, rmse d, r2 d, mape d, smape d, wape d, bias d, mean_lag_1h d, mean_rolling_24h d",
    with_sql(
        P_HOUR,
        f""", feats AS (
          SELECT p.*, {_checked('demand_mw', 1, 'lag1')}, avg(demand_mw) OVER {_frame(24, False)} AS mean24 FROM p_hour p
        ), pairs AS (
          SELECT f.zone, f.demand_mw AS y, b.demand_mw AS p, f.lag1, f.mean24 FROM feats f
          JOIN p_hour b ON b.zone = f.zone AND b.datetime = f.datetime - INTERVAL 24 HOUR
        )
        SELECT zone, count(*) AS observations, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
               CASE WHEN count(*) >= 2 THEN 1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(*), 0) END AS r2,
               avg(CASE WHEN abs(y) > 1e-6 THEN abs(y - p) / abs(y) * 100 END) AS mape,
               avg(CASE WHEN abs(y) + abs(p) > 1e-6 THEN 2 * abs(y - p) / (abs(y) + abs(p)) * 100 END) AS smape,
               sum(abs(y - p)) / nullif(sum(abs(y)), 0) * 100 AS wape, avg(p - y) AS bias,
               avg(lag1) AS mean_lag_1h, avg(mean24) AS mean_rolling_24h
        FROM pairs GROUP BY zone""",
    ),
)
def _(t):
    panel = pn.hourly_panel(t.events).select("zone", "datetime", "demand_mw")
    rows = wn.lag_checked(panel, "zone", "datetime", "demand_mw", [1])
    rows = wn.rolling_past(rows, "zone", "datetime", "demand_mw", [24], ["mean"])
    rows = wn.lag_exact(rows, "zone", "datetime", "demand_mw", [24], stem="naive")
    pairs = ev.finite_pairs(rows, "demand_mw", "naive_24h")
    return pairs.groupBy("zone").agg(
        *ev.metric_columns("demand_mw", "naive_24h"),
        F.avg("demand_lag_1h").alias("mean_lag_1h"),
        F.avg("demand_rolling_mean_24h").alias("mean_rolling_24h"),
    )


# --- silver ----------------------------------------------------------------------------------

_LOADED = datetime(2024, 2, 1)
_SILVER = (
    "zone s, datetime t, datetime_local t, year i, month i, day i, hour i, day_of_week i, is_weekend i, demand_mw d, "
    "demand_normalized d, temperature_c d, dew_point_c d, relative_humidity_pct d, wind_speed_kmh d, "
    "precipitation_mm d, hdd18 d, cdd18 d, ingestion_time t"
)


@check(
    "silver_panel",
    _SILVER,
    with_sql(
        P_HOUR,
        """, d AS (SELECT zone, datetime, demand_mw FROM p_hour), w AS (SELECT * FROM p_hour WHERE hour(datetime) % 9 <> 0),
           j AS (SELECT d.zone, d.datetime, d.demand_mw, w.datetime AS datetime_local, w.temperature_c, w.dew_point_c,
                        w.relative_humidity_pct, w.wind_speed_kmh, w.precipitation_mm,
                        CASE WHEN w.zone IS NOT NULL THEN greatest(18 - w.temperature_c, 0) END AS hdd18,
                        CASE WHEN w.zone IS NOT NULL THEN greatest(w.temperature_c - 18, 0) END AS cdd18
                 FROM d LEFT JOIN w ON w.zone = d.zone AND w.datetime = d.datetime)
           SELECT *, year(datetime) AS year, month(datetime) AS month, day(datetime) AS day, hour(datetime) AS hour,
                  dayofweek(datetime) AS day_of_week, CASE WHEN dayofweek(datetime) >= 5 THEN 1 ELSE 0 END AS is_weekend,
                  (demand_mw - avg(demand_mw) OVER (PARTITION BY zone))
                    / nullif(stddev_samp(demand_mw) OVER (PARTITION BY zone), 0) AS demand_normalized,
                  TIMESTAMP '2024-02-01' AS ingestion_time FROM j""",
    ),
)
def _(t):
    panel = pn.hourly_panel(t.events)
    demand = panel.select("zone", "datetime", "demand_mw").withColumn("ingestion_time", F.lit(_LOADED))
    weather = panel.filter(F.hour("datetime") % 9 != 0).withColumn("datetime_local", F.col("datetime"))
    return silver_panel(demand, weather)


# --- gold ------------------------------------------------------------------------------------

WHOLE = {
    *[c for c in gold.METADATA if c not in ("zone",) and "datetime" not in c and not c.endswith("_date")],
    *[c for c in gold.TEMPORAL if not c.endswith(("_sin", "_cos"))],
    "forecast_day", "forecast_hour_in_day",
    "weather_target_is_precipitation", "weather_target_is_high_humidity", "weather_target_is_strong_wind",
    *CALENDAR, *gold.FLAGS,
}


def gold_columns(names):
    def kind(c):
        if c == "zone":
            return "s"
        if c.endswith("_datetime"):
            return "t"
        if c in ("issue_date", "target_date"):
            return "date"
        return "i" if c in WHOLE else "d"

    return [(c, kind(c)) for c in names]


def _cycle(expr: str, period: str, name: str) -> str:
    angle = f"2 * pi() * ({expr}) / CAST({period} AS DOUBLE)"
    return f"sin({angle}) AS {name}_sin, cos({angle}) AS {name}_cos"


def _parts_sql(ts: str, p: str) -> str:
    return f"""CAST({ts} AS DATE) AS {p}_date, year({ts}) AS {p}_year, month({ts}) AS {p}_month, day({ts}) AS {p}_day,
      hour({ts}) AS {p}_hour, isodow({ts}) - 1 AS {p}_day_of_week, dayofyear({ts}) AS {p}_day_of_year,
      CASE WHEN isodow({ts}) >= 6 THEN 1 ELSE 0 END AS {p}_is_weekend, {_cycle(f'hour({ts})', '24', p + '_hour')}"""


HISTORY_SQL = ", ".join(
    [
        *[_checked("demand_mw", n, f"demand_lag_{n}h") for n in DEMAND_LAGS],
        _rolling("demand_mw", "demand_rolling", DEMAND_WINDOWS, ("mean", "min", "max"), False),
        _rolling("demand_mw", "demand_rolling", gold.STD_WINDOWS, ("std",), False),
        *[f"lag(temperature_c, {n}) OVER {W} AS temperature_lag_{n}h" for n in WEATHER_LAGS],
        *[f"lag(relative_humidity_pct, {n}) OVER {W} AS humidity_lag_{n}h" for n in WEATHER_LAGS],
        _rolling("temperature_c", "temperature_rolling", DEMAND_WINDOWS, ("mean",), True),
        _rolling("relative_humidity_pct", "humidity_rolling", DEMAND_WINDOWS, ("mean",), True),
        _rolling("temperature_c", "temperature_rolling", gold.WIDE_WINDOWS, ("min", "max", "std"), True),
        _rolling("coalesce(precipitation_mm, 0)", "precipitation_rolling", gold.WIDE_WINDOWS, ("sum",), True),
    ]
)
CHANGES_SQL = ", ".join(
    [
        *[f"demand_mw - demand_lag_{n}h AS demand_change_{n}h" for n in (1, 24, 168)],
        *[
            f"CASE WHEN abs(demand_lag_{n}h) > 0 THEN (demand_mw - demand_lag_{n}h) / demand_lag_{n}h END AS demand_pct_change_{n}h"
            for n in (1, 24)
        ],
        "CASE WHEN abs(demand_lag_168h) > 0 THEN demand_lag_24h / demand_lag_168h END AS demand_ratio_24h_168h",
        *[f"demand_mw - demand_rolling_mean_{n}h AS demand_vs_rolling_mean_{n}h" for n in (24, 168)],
        *[f"temperature_c - temperature_lag_{n}h AS temperature_change_{n}h" for n in (1, 6, 24)],
    ]
)
TARGET_TIME_SQL = ", ".join(
    [
        _parts_sql("target_datetime", "target"),
        _cycle("isodow(target_datetime) - 1", "7", "target_day_of_week"),
        _cycle("month(target_datetime) - 1", "12", "target_month"),
        _cycle("dayofyear(target_datetime) - 1", "365.25", "target_day_of_year"),
        "CASE WHEN hour(target_datetime) BETWEEN 6 AND 11 THEN 1 ELSE 0 END AS target_time_morning",
        "CASE WHEN hour(target_datetime) BETWEEN 12 AND 17 THEN 1 ELSE 0 END AS target_time_afternoon",
        "CASE WHEN hour(target_datetime) BETWEEN 18 AND 21 THEN 1 ELSE 0 END AS target_time_evening",
        "CASE WHEN hour(target_datetime) < 6 OR hour(target_datetime) >= 22 THEN 1 ELSE 0 END AS target_time_night",
        calendar_sql("target_datetime"),
    ]
)
_T = "weather_target_"
TARGET_WEATHER_SQL = f"""pow({_T}temperature_c, 2) AS {_T}temperature_sq, pow({_T}temperature_c, 3) AS {_T}temperature_cube,
  greatest(18 - {_T}temperature_c, 0) AS {_T}hdd18, greatest({_T}temperature_c - 18, 0) AS {_T}cdd18,
  greatest(CAST(15.5 AS DOUBLE) - {_T}temperature_c, 0) AS {_T}hdd15_5,
  greatest({_T}temperature_c - CAST(15.5 AS DOUBLE), 0) AS {_T}cdd15_5,
  {_T}temperature_c - {_T}dew_point_c AS {_T}temp_dew_spread,
  {_wet_bulb(_T + 'temperature_c', _T + 'relative_humidity_pct')} AS {_T}wet_bulb_approx_c,
  CASE WHEN coalesce({_T}precipitation_mm, 0) > 0 THEN 1 ELSE 0 END AS {_T}is_precipitation,
  CASE WHEN {_T}relative_humidity_pct >= 80 THEN 1 ELSE 0 END AS {_T}is_high_humidity,
  CASE WHEN {_T}wind_speed_kmh >= 30 THEN 1 ELSE 0 END AS {_T}is_strong_wind"""
INTERACTION_SQL = ", ".join(
    [
        *[f"{_T}temperature_c * target_hour_{w} AS {_T}temperature_x_hour_{w}" for w in ("sin", "cos")],
        *[f"{_T}{m} * target_hour_{w} AS {_T}{m}_x_hour_{w}" for m in ("hdd18", "cdd18") for w in ("sin", "cos")],
        *[f"{_T}{m} * target_is_weekend AS {_T}{m}_x_weekend" for m in ("hdd18", "cdd18")],
        f"{_T}temperature_c * {_T}relative_humidity_pct AS {_T}temperature_x_humidity",
        *[f"{_T}{m} * is_holiday AS {_T}{m}_x_holiday" for m in ("hdd18", "cdd18")],
        *[f"is_holiday * target_hour_{w} AS holiday_x_target_hour_{w}" for w in ("sin", "cos")],
    ]
)


def _flags_sql(essential) -> str:
    ok = " AND ".join(f"{c} IS NOT NULL" for c in essential)
    return f"""CASE WHEN {ok} THEN 1 ELSE 0 END AS has_valid_features,
      CASE WHEN target_demand_mw IS NOT NULL THEN 1 ELSE 0 END AS has_valid_target,
      CASE WHEN {ok} AND target_demand_mw IS NOT NULL THEN 1 ELSE 0 END AS is_training_row"""


def gold_24h_sql(panel: str = P_HOUR) -> str:
    ahead = ", ".join(_checked(c, -24, name) for c, name in gold.TARGET_NAMES.items())
    return with_sql(
        panel,
        f""", base AS (SELECT p.* FROM p_hour p),
        windowed AS (SELECT *, {HISTORY_SQL}, {ahead} FROM base),
        timed AS (SELECT *, {CHANGES_SQL}, 24 AS forecast_horizon_hours, datetime AS issue_datetime,
                         datetime + INTERVAL 24 HOUR AS target_datetime, {_parts_sql('datetime', 'issue')} FROM windowed),
        dated AS (SELECT *, {TARGET_TIME_SQL}, {TARGET_WEATHER_SQL} FROM timed)
        SELECT *, {INTERACTION_SQL}, {_flags_sql(gold.ESSENTIAL_24H)} FROM dated""",
    )


GOLD_24H = [*gold.METADATA, *gold.FEATURES_24H, *gold.FLAGS, "demand_mw", "target_demand_mw"]


@check("gold_features_day_ahead", gold_columns(GOLD_24H), gold_24h_sql())
def _(t):
    panel = pn.hourly_panel(t.events)
    return gold.features_24h(panel, years=cal.year_bounds(t.events, "ts"))


def gold_7d_sql(hi: int) -> str:
    targets = ", ".join(f"x.{c} AS {name}" for c, name in gold.TARGET_NAMES.items())
    return with_sql(
        P_HOUR,
        f""", windowed AS (SELECT *, {HISTORY_SQL} FROM p_hour),
        changed AS (SELECT *, {CHANGES_SQL} FROM windowed),
        expanded AS (SELECT c.*, h AS forecast_horizon_hours, datetime AS issue_datetime,
                            datetime + to_hours(h) AS target_datetime
                     FROM changed c, (SELECT unnest(range(1, {hi + 1})) AS h)),
        aimed AS (SELECT e.*, {targets} FROM expanded e
                  LEFT JOIN p_hour x ON x.zone = e.zone AND x.datetime = e.target_datetime),
        dated AS (SELECT *, {_parts_sql('issue_datetime', 'issue')}, {TARGET_TIME_SQL},
                         {_horizon_sql('forecast_horizon_hours')}, {TARGET_WEATHER_SQL} FROM aimed)
        SELECT *, {INTERACTION_SQL}, {_flags_sql(gold.ESSENTIAL_7D)} FROM dated""",
    )


GOLD_7D = [*gold.METADATA, *gold.FEATURES_7D, *gold.FLAGS, "demand_mw", "target_demand_mw"]


# the table has 168 rows per hour and zone: every column of all of them is compared by its mean and count
WEEK_NUMBERS = [name for name, kind in gold_columns(GOLD_7D) if kind[0] in "id" and kind != "date" and name != "forecast_horizon_hours"]


@check(
    "gold_features_week_ahead",
    "zone s, forecast_horizon_hours i, rows i, first_issue t, last_target t, "
    + ", ".join(f"{c} d, n_{c} i" for c in WEEK_NUMBERS),
    "SELECT zone, forecast_horizon_hours, count(*) AS rows, min(issue_datetime) AS first_issue, max(target_datetime) AS last_target, "
    + ", ".join(f"avg({c}) AS {c}, count({c}) AS n_{c}" for c in WEEK_NUMBERS)
    + f" FROM ({gold_7d_sql(168)}) AS week GROUP BY 1, 2",
)
def _(t):
    week = gold.features_7d(pn.hourly_panel(t.events), years=cal.year_bounds(t.events, "ts"))
    each = [f(c).alias(n) for c in WEEK_NUMBERS for f, n in ((F.avg, c), (F.count, f"n_{c}"))]
    return week.groupBy("zone", "forecast_horizon_hours").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("issue_datetime").alias("first_issue"),
        F.max("target_datetime").alias("last_target"),
        *each,
    )


@check(
    "targets_for_all_horizons",
    "zone s, forecast_horizon_hours i, rows i, targets i, mean_target d, mean_temperature d",
    with_sql(
        P_HOUR,
        """, e AS (SELECT zone, datetime, h, datetime + to_hours(h) AS target FROM p_hour, (SELECT unnest(range(1, 169)) AS h))
           SELECT e.zone, h AS forecast_horizon_hours, count(*) AS rows, count(x.demand_mw) AS targets,
                  avg(x.demand_mw) AS mean_target, avg(x.temperature_c) AS mean_temperature
           FROM e LEFT JOIN p_hour x ON x.zone = e.zone AND x.datetime = e.target GROUP BY 1, 2""",
    ),
)
def _(t):
    expanded = gold.expand_with_targets(
        pn.hourly_panel(t.events).select("zone", "datetime", "demand_mw", "temperature_c"),
        {"demand_mw": "target_demand_mw", "temperature_c": "target_temperature_c"},
    )
    return expanded.groupBy("zone", "forecast_horizon_hours").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("target_demand_mw").alias("targets"),
        F.avg("target_demand_mw").alias("mean_target"),
        F.avg("target_temperature_c").alias("mean_temperature"),
    )


# --- scoring ---------------------------------------------------------------------------------

_REF = datetime(2024, 1, 25, 8, 0)
_R = "TIMESTAMP '2024-01-25 08:00:00'"
_SCORED = [
    "demand_lag_1h", "demand_lag_24h", "demand_lag_168h", "demand_rolling_mean_24h", "demand_rolling_std_168h",
    "demand_pct_change_24h", "temperature_lag_24h", "temperature_rolling_mean_72h",
    "weather_target_temperature_c", "weather_target_hdd18", "weather_target_wet_bulb_approx_c",
    "target_hour_sin", "target_day_of_year_cos", "precipitation_rolling_sum_24h",
]
_WEIGHT = "CASE zone " + " ".join(f"WHEN '{z}' THEN {w}" for z, w in pn.EVENT_WEIGHTS.items()) + " END"


def _weighted(y: str) -> str:
    w = f"CAST({_WEIGHT} AS DOUBLE)"
    return f"sum({w} * {y}) / nullif(sum(CASE WHEN {y} IS NOT NULL THEN {w} END), 0)"


def _at(y: str, n: int) -> str:
    return f"max({y}) FILTER (datetime = {_R} - INTERVAL {n} HOUR)"


def _in(f: str, y: str, n: int) -> str:
    return f"{f}({y}) FILTER (datetime BETWEEN {_R} - INTERVAL {n - 1} HOUR AND {_R})"


SCORING_CTES = f"""hist AS (SELECT zone, datetime, demand_mw FROM p_hour WHERE datetime BETWEEN {_R} - INTERVAL 388 HOUR AND {_R}),
    grid AS (SELECT zone, unnest(generate_series(min(datetime), {_R}, INTERVAL 1 HOUR)) AS datetime FROM hist GROUP BY zone),
    regular AS (SELECT g.zone, g.datetime, h.demand_mw AS y, CASE WHEN h.demand_mw IS NOT NULL THEN g.datetime END AS known
                FROM grid g LEFT JOIN hist h ON h.zone = g.zone AND h.datetime = g.datetime),
    edges AS (SELECT *, last_value(y IGNORE NULLS) OVER b AS py, last_value(known IGNORE NULLS) OVER b AS pt,
                     first_value(y IGNORE NULLS) OVER a AS ny, first_value(known IGNORE NULLS) OVER a AS nt FROM regular
              WINDOW b AS (PARTITION BY zone ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     a AS (PARTITION BY zone ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    filled AS (SELECT zone, datetime, CASE WHEN y IS NOT NULL THEN y
                 WHEN py IS NOT NULL AND ny IS NOT NULL AND epoch(datetime) - epoch(pt) <= 7200
                 THEN py + (ny - py) * (epoch(datetime) - epoch(pt)) / (epoch(nt) - epoch(pt)) END AS y FROM edges),
    demand AS (SELECT zone, {_at('y', 0)} AS d0, {_at('y', 1)} AS demand_lag_1h, {_at('y', 24)} AS demand_lag_24h,
                 {_at('y', 168)} AS demand_lag_168h, {_in('avg', 'y', 24)} AS demand_rolling_mean_24h,
                 {_in('stddev_samp', 'y', 168)} AS demand_rolling_std_168h FROM filled GROUP BY zone),
    wh AS (SELECT zone, datetime, temperature_c, precipitation_mm FROM p_hour
           UNION ALL
           SELECT 'Total', datetime, {_weighted('temperature_c')}, {_weighted('precipitation_mm')} FROM p_hour GROUP BY datetime),
    weather AS (SELECT zone, {_at('temperature_c', 24)} AS temperature_lag_24h,
                  {_in('avg', 'temperature_c', 72)} AS temperature_rolling_mean_72h,
                  coalesce({_in('sum', 'precipitation_mm', 24)}, 0) AS precipitation_rolling_sum_24h FROM wh GROUP BY zone),
    zt AS (SELECT zone, datetime AS target_datetime, temperature_c AS t, relative_humidity_pct AS rh FROM p_hour
           WHERE datetime >= {_R} AND datetime < {_R} + INTERVAL 25 HOUR),
    tt AS (SELECT zone, target_datetime, t, rh FROM zt UNION ALL
           SELECT 'Total', target_datetime, {_weighted('t')}, {_weighted('rh')} FROM zt GROUP BY target_datetime)"""
SCORING_SELECT = f"""SELECT tt.zone, target_datetime, date_diff('hour', {_R}, target_datetime) AS forecast_horizon_hours,
           demand_lag_1h, demand_lag_24h, demand_lag_168h, demand_rolling_mean_24h, demand_rolling_std_168h,
           CASE WHEN abs(demand_lag_24h) > 1e-6 THEN (d0 - demand_lag_24h) / demand_lag_24h * 100 END AS demand_pct_change_24h,
           temperature_lag_24h, temperature_rolling_mean_72h, t AS weather_target_temperature_c,
           greatest(18 - t, 0) AS weather_target_hdd18, {_wet_bulb('t', 'rh')} AS weather_target_wet_bulb_approx_c,
           sin(2 * pi() * hour(target_datetime) / 24) AS target_hour_sin,
           cos(2 * pi() * dayofyear(target_datetime) / CAST(365.25 AS DOUBLE)) AS target_day_of_year_cos,
           precipitation_rolling_sum_24h
    FROM tt LEFT JOIN demand ON demand.zone = tt.zone LEFT JOIN weather ON weather.zone = tt.zone"""
_SCORING_SQL = with_sql(P_HOUR, f", {SCORING_CTES} {SCORING_SELECT}")


@check(
    "scoring_features",
    "zone s, target_datetime t, forecast_horizon_hours i, " + ", ".join(f"{c} d" for c in _SCORED),
    _SCORING_SQL,
)
def _(t):
    panel = pn.hourly_panel(t.events)
    forecast = panel.select(
        "zone",
        F.col("datetime").alias("target_datetime"),
        *[F.col(c).alias(f"weather_target_{c}") for c in WEATHER_MEASURES],
    )
    return scoring_features(
        panel, panel, forecast, _REF, _REF, datetime(2024, 1, 26, 9, 0), pn.EVENT_WEIGHTS, "Total"
    )
