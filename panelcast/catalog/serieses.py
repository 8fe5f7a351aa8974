"""Checks of series repair and point-in-time features."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from panelcast.catalog.base import P_DENSE, P_HOUR, check, with_sql
from panelcast.functions.timecols import hour_start
from panelcast.operators import series as sr
from panelcast.operators import windows as wn
from panelcast.plans import panels as pn

REF = datetime(2024, 1, 25, 8, 0)
REF_SQL = "TIMESTAMP '2024-01-25 08:00:00'"
END = datetime(2024, 1, 31, 0, 0)

GRID = (
    P_HOUR
    + """, grid AS (
  SELECT zone, unnest(generate_series(min(datetime), TIMESTAMP '2024-01-31 00:00:00', INTERVAL 1 HOUR)) AS datetime
  FROM p_hour GROUP BY zone
), regular AS (
  SELECT g.zone, g.datetime, p.demand_mw, p.temperature_c FROM grid g
  LEFT JOIN p_hour p ON p.zone = g.zone AND p.datetime = g.datetime
)"""
)


@check(
    "regularize",
    "zone s, datetime t, demand_mw d, temperature_c d",
    with_sql(GRID, "SELECT zone, datetime, demand_mw, temperature_c FROM regular"),
)
def _(t):
    return sr.regularize(pn.hourly_panel(t.events), "zone", "datetime", END)


FILLED = (
    GRID
    + """, edges AS (
  SELECT zone, datetime, temperature_c,
         last_value(temperature_c IGNORE NULLS) OVER b AS py,
         last_value(CASE WHEN temperature_c IS NOT NULL THEN datetime END IGNORE NULLS) OVER b AS pt,
         first_value(temperature_c IGNORE NULLS) OVER a AS ny,
         first_value(CASE WHEN temperature_c IS NOT NULL THEN datetime END IGNORE NULLS) OVER a AS nt
  FROM regular
  WINDOW b AS (PARTITION BY zone ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         a AS (PARTITION BY zone ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), filled AS (
  SELECT zone, datetime,
         CASE WHEN temperature_c IS NOT NULL THEN temperature_c
              WHEN py IS NOT NULL AND ny IS NOT NULL AND epoch(datetime) - epoch(pt) <= 7200
              THEN py + (ny - py) * (epoch(datetime) - epoch(pt)) / (epoch(nt) - epoch(pt)) END AS temperature_c
  FROM edges
)"""
)


@check(
    "interpolate_linear",
    "zone s, datetime t, temperature_c d",
    with_sql(FILLED, "SELECT zone, datetime, temperature_c FROM filled"),
)
def _(t):
    grid = sr.regularize(pn.hourly_panel(t.events).select("zone", "datetime", "temperature_c"), "zone", "datetime", END)
    return sr.interpolate_linear(grid, "zone", "datetime", "temperature_c")


@check(
    "lag_exact",
    "zone s, datetime t, " + ", ".join(f"lag_exact_{n}h d" for n in (1, 24, 168)),
    with_sql(
        P_HOUR,
        "SELECT p.zone, p.datetime, "
        + ", ".join(f"l{n}.demand_mw AS lag_exact_{n}h" for n in (1, 24, 168))
        + " FROM p_hour p "
        + " ".join(
            f"LEFT JOIN p_hour l{n} ON l{n}.zone = p.zone AND l{n}.datetime = p.datetime - INTERVAL {n} HOUR"
            for n in (1, 24, 168)
        ),
    ),
)
def _(t):
    return wn.lag_exact(pn.hourly_panel(t.events), "zone", "datetime", "demand_mw", [1, 24, 168])


def _stat(f: str, y: str, n: int) -> str:
    return f"{f}({y}) FILTER (datetime BETWEEN {REF_SQL} - INTERVAL {n - 1} HOUR AND {REF_SQL})"


def _lag(y: str, n: int) -> str:
    return f"max({y}) FILTER (datetime = {REF_SQL} - INTERVAL {n} HOUR)"


_FUNCS = {"min": "min", "max": "max", "mean": "avg", "std": "stddev_samp"}


@check(
    "stats_at",
    "zone s, " + ", ".join(f"demand_rolling_{f}_{n}h d" for n in (3, 24, 168) for f in _FUNCS),
    with_sql(
        P_HOUR,
        "SELECT zone, "
        + ", ".join(f"{_stat(g, 'demand_mw', n)} AS demand_rolling_{f}_{n}h" for n in (3, 24, 168) for f, g in _FUNCS.items())
        + f" FROM p_hour WHERE datetime BETWEEN {REF_SQL} - INTERVAL 167 HOUR AND {REF_SQL} GROUP BY zone",
    ),
)
def _(t):
    return sr.stats_at(pn.hourly_panel(t.events), "zone", "datetime", "demand_mw", REF, [3, 24, 168])


_DEMAND = [
    *[f"demand_lag_{n}h" for n in sr.DEMAND_LAGS],
    *[f"demand_rolling_{f}_{n}h" for n in sr.DEMAND_WINDOWS for f in _FUNCS],
    "demand_change_1h", "demand_change_24h", "demand_change_168h",
    "demand_pct_change_1h", "demand_pct_change_24h", "demand_ratio_24h_168h",
    "demand_vs_rolling_mean_24h", "demand_vs_rolling_mean_168h",
]


def _pct(n: int) -> str:
    return (
        f"CASE WHEN abs(demand_lag_{n}h) > 1e-6 THEN (r - demand_lag_{n}h) / demand_lag_{n}h * 100 END"
        f" AS demand_pct_change_{n}h"
    )


@check(
    "demand_features_at",
    "zone s, " + ", ".join(f"{c} d" for c in _DEMAND),
    with_sql(
        P_HOUR,
        ", wide AS (SELECT zone, "
        + _lag("demand_mw", 0)
        + " AS r, "
        + ", ".join(f"{_lag('demand_mw', n)} AS demand_lag_{n}h" for n in sr.DEMAND_LAGS)
        + ", "
        + ", ".join(
            f"{_stat(g, 'demand_mw', n)} AS demand_rolling_{f}_{n}h" for n in sr.DEMAND_WINDOWS for f, g in _FUNCS.items()
        )
        + f" FROM p_hour WHERE datetime BETWEEN {REF_SQL} - INTERVAL 336 HOUR AND {REF_SQL} GROUP BY zone)"
        + " SELECT *, "
        + ", ".join(f"r - demand_lag_{n}h AS demand_change_{n}h" for n in (1, 24, 168))
        + f", {_pct(1)}, {_pct(24)}, CASE WHEN abs(demand_lag_168h) > 1e-6 THEN demand_lag_24h / demand_lag_168h END"
        + " AS demand_ratio_24h_168h, "
        + ", ".join(f"r - demand_rolling_mean_{n}h AS demand_vs_rolling_mean_{n}h" for n in (24, 168))
        + " FROM wide",
    ),
)
def _(t):
    return sr.demand_features_at(pn.hourly_panel(t.events), "zone", "datetime", "demand_mw", REF)


def _weather_sql(offset: int) -> str:
    t, rh, rain = "temperature_c", "relative_humidity_pct", "precipitation_mm"
    parts = [f"{_lag(t, 0)} AS temperature_c", f"{_lag(rain, 0)} AS precipitation_mm"]
    parts += [f"{_lag(t, n - offset)} AS temperature_lag_{n}h" for n in sr.WEATHER_LAGS]
    parts += [f"{_lag(rh, n)} AS humidity_lag_{n}h" for n in sr.WEATHER_LAGS]
    for n in (24, 72, 168):
        parts += [f"{_stat(g, t, n)} AS temperature_rolling_{f}_{n}h" for f, g in _FUNCS.items()]
        parts.append(f"coalesce({_stat('sum', rain, n)}, 0) AS precipitation_rolling_sum_{n}h")
    parts += [f"{_stat('avg', t, n)} AS temperature_rolling_mean_{n}h" for n in (3, 6, 12, 48)]
    parts += [f"{_stat('avg', rh, n)} AS humidity_rolling_mean_{n}h" for n in sr.DEMAND_WINDOWS]
    parts += [f"{_lag(t, 0)} - {_lag(t, n)} AS temperature_change_{n}h" for n in (1, 6, 24)]
    scope = f"datetime BETWEEN {REF_SQL} - INTERVAL 168 HOUR AND {REF_SQL}"
    return with_sql(P_HOUR, f"SELECT zone, {', '.join(parts)} FROM p_hour WHERE {scope} GROUP BY zone")


_WEATHER = [
    "temperature_c", "precipitation_mm",
    *[f"{m}_lag_{n}h" for m in ("temperature", "humidity") for n in sr.WEATHER_LAGS],
    *[f"temperature_rolling_{f}_{n}h" for f in _FUNCS for n in (24, 72, 168)],
    *[f"precipitation_rolling_sum_{n}h" for n in (24, 72, 168)],
    *[f"temperature_rolling_mean_{n}h" for n in (3, 6, 12, 48)],
    *[f"humidity_rolling_mean_{n}h" for n in sr.DEMAND_WINDOWS],
    *[f"temperature_change_{n}h" for n in (1, 6, 24)],
]


@check("weather_stats_at", "zone s, " + ", ".join(f"{c} d" for c in _WEATHER), _weather_sql(0))
def _(t):
    return sr.weather_stats_at(pn.hourly_panel(t.events), "zone", "datetime", REF)


@check("weather_stats_at_shifted", "zone s, " + ", ".join(f"{c} d" for c in _WEATHER), _weather_sql(1))
def _(t):
    return sr.weather_stats_at(pn.hourly_panel(t.events), "zone", "datetime", REF, lag_offset=1)


@check(
    "attach_by_zone",
    "zone s, datetime t, temperature_c d, demand_lag_24h d",
    with_sql(
        P_HOUR,
        f"""SELECT p.zone, p.datetime, p.temperature_c, f.v AS demand_lag_24h FROM p_hour p
            LEFT JOIN (SELECT zone, {_lag('demand_mw', 24)} AS v FROM p_hour GROUP BY zone) f ON f.zone = p.zone
            WHERE p.datetime > {REF_SQL}""",
    ),
)
def _(t):
    panel = pn.hourly_panel(t.events)
    features = sr.demand_features_at(panel, "zone", "datetime", "demand_mw", REF).select("zone", "demand_lag_24h")
    return sr.attach_by_zone(panel.filter(F.col("datetime") > F.lit(REF)), features)


@check(
    "rollup_complete_hours",
    "zone s, datetime t, demand_mw d, interval_count i, demand_min_mw d, demand_max_mw d, last_interval i",
    with_sql(
        P_DENSE,
        """SELECT zone, CAST(date AS TIMESTAMP) + to_hours(CAST(hour - 1 AS BIGINT)) AS datetime,
                  avg(demand_mw) AS demand_mw, count(DISTINCT "interval") AS interval_count,
                  min(demand_mw) AS demand_min_mw, max(demand_mw) AS demand_max_mw, max("interval") AS last_interval
           FROM p_interval GROUP BY 1, 2 HAVING count(DISTINCT "interval") >= 12""",
    ),
)
def _(t):
    rows = pn.dense_interval_panel(t.events).withColumn("datetime", hour_start("date", "hour"))
    return sr.rollup_complete_hours(rows, "zone", "datetime", "interval", "demand_mw")


@check(
    "history_slice",
    "zone s, datetime t, demand_mw d",
    with_sql(
        P_HOUR,
        f"""SELECT zone, datetime, demand_mw FROM p_hour
            WHERE datetime BETWEEN {REF_SQL} - INTERVAL 388 HOUR AND {REF_SQL}""",
    ),
)
def _(t):
    return sr.history_slice(pn.hourly_panel(t.events), "datetime", REF)
