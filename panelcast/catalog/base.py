"""Registry: a query, its output columns and its SQL twin.

The column list is the contract between both sides. It is written ``name kind`` with the kinds
``s`` text, ``i`` whole number, ``d`` double rounded to 6 places (``d2`` to 2, and so on),
``t`` timestamp without zone, ``date`` as ISO text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from panelcast.plans.panels import EVENT_ZONES, Tables


@dataclass
class Check:
    name: str
    columns: list[tuple[str, str]]
    run: Callable[[Tables], DataFrame]
    sql: str | None

    def frame(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.run(Tables(spark, folder))
        return df.selectExpr(*[_shape(n, k) for n, k in self.columns]) if self.columns else df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        columns = ", ".join(_shape_sql(n, k) for n, k in self.columns)
        return f"SELECT {columns} FROM ({self.sql}) AS q"


CHECKS: dict[str, Check] = {}


def _digits(kind: str) -> int:
    return int(kind[1:] or 6)


def _nudge(digits: int) -> float:
    """A shift far below the last digit: exact halves then round the same way on both sides."""
    return 0.037 * 10.0**-digits


def _shape(name: str, kind: str) -> str:
    quoted = f"`{name}`"
    if kind == "s":
        value = f"CAST({quoted} AS STRING)"
    elif kind == "i":
        value = f"CAST({quoted} AS BIGINT)"
    elif kind == "t":
        value = f"CAST(CAST({quoted} AS TIMESTAMP) AS TIMESTAMP_NTZ)"
    elif kind == "date":
        value = f"CAST(CAST({quoted} AS DATE) AS STRING)"
    else:
        digits = _digits(kind)
        # adding zero turns a rounded -0.0 into 0.0
        value = f"round(CAST({quoted} AS DOUBLE) + {_nudge(digits):e}D, {digits}) + 0.0D"
    return f"{value} AS {quoted}"


def _shape_sql(name: str, kind: str) -> str:
    quoted = f'"{name}"'
    if kind == "s":
        value = f"CAST({quoted} AS VARCHAR)"
    elif kind == "i":
        value = f"CAST({quoted} AS BIGINT)"
    elif kind == "t":
        value = f"CAST({quoted} AS TIMESTAMP)"
    elif kind == "date":
        value = f"CAST(CAST({quoted} AS DATE) AS VARCHAR)"
    else:
        digits = _digits(kind)
        nudge = f"CAST({_nudge(digits):e} AS DOUBLE)"
        value = f"round(CAST({quoted} AS DOUBLE) + {nudge}, {digits}) + CAST(0 AS DOUBLE)"
    return f"{value} AS {quoted}"


def columns(text: str) -> list[tuple[str, str]]:
    """``"zone s, datetime t"`` to pairs."""
    return [tuple(part.split()) for part in text.split(",") if part.strip()]


def check(name: str, spec: str | list[tuple[str, str]] = "", sql: str | None = None):
    """Register the decorated function, which maps the tables to a DataFrame."""

    def register(run):
        if name in CHECKS:
            raise ValueError(f"query {name} is registered twice")
        pairs = columns(spec) if isinstance(spec, str) else spec
        CHECKS[name] = Check(name, pairs, run, sql)
        return run

    return register


# --- SQL twins of the derived panels -------------------------------------------------------

P_HOUR = """p_hour AS (
  SELECT zone, datetime, demand_mw, temperature_c,
         temperature_c - (100 - relative_humidity_pct) / 5 AS dew_point_c,
         relative_humidity_pct, wind_speed_kmh, precipitation_mm
  FROM (
    SELECT event_type AS zone, date_trunc('hour', ts) AS datetime, sum(value) AS demand_mw,
           CASE WHEN hour(date_trunc('hour', ts)) % 11 <> 0
                THEN avg(k) * CAST(0.5 AS DOUBLE) - 15 END AS temperature_c,
           avg(user_id % 80) + 20 AS relative_humidity_pct,
           avg(k % 40) AS wind_speed_kmh,
           CAST(greatest(min(k) - 50, 0) AS DOUBLE) / 10 AS precipitation_mm
    FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)
    GROUP BY event_type, date_trunc('hour', ts)
  )
)"""

P_INTERVAL = """p_interval AS (
  SELECT event_type AS zone, CAST(ts AS DATE) AS date, hour(ts) + 1 AS hour,
         CAST(floor(minute(ts) / 5) AS INTEGER) + 1 AS "interval", avg(value) AS demand_mw
  FROM events GROUP BY ALL
)"""

P_DENSE = P_INTERVAL.replace("CAST(ts AS DATE)", "CAST(date_trunc('month', ts) AS DATE)")

# the hourly panel with short gaps of demand filled, so that windows of a week have no holes
P_STEADY = (
    P_HOUR.replace("p_hour AS (", "p_raw AS (")
    + """, p_grid AS (
  SELECT zone, unnest(generate_series(min(datetime), max(datetime), INTERVAL 1 HOUR)) AS datetime FROM p_raw GROUP BY zone
), p_edges AS (
  SELECT zone, datetime, p.* EXCLUDE (zone, datetime),
         last_value(demand_mw IGNORE NULLS) OVER b AS py,
         last_value(CASE WHEN demand_mw IS NOT NULL THEN datetime END IGNORE NULLS) OVER b AS pt,
         first_value(demand_mw IGNORE NULLS) OVER a AS ny,
         first_value(CASE WHEN demand_mw IS NOT NULL THEN datetime END IGNORE NULLS) OVER a AS nt
  FROM p_grid LEFT JOIN p_raw p USING (zone, datetime)
  WINDOW b AS (PARTITION BY zone ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         a AS (PARTITION BY zone ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), p_filled AS (
  SELECT * EXCLUDE (py, pt, ny, nt) REPLACE (
         CASE WHEN demand_mw IS NOT NULL THEN demand_mw WHEN epoch(datetime) - epoch(pt) <= 7200
              THEN py + (ny - py) * (epoch(datetime) - epoch(pt)) / (epoch(nt) - epoch(pt)) END AS demand_mw)
  FROM p_edges
), p_hour AS (SELECT * FROM p_filled WHERE demand_mw IS NOT NULL)"""
)

ZONE_NAMES = [zone for zone, *_ in EVENT_ZONES]
P_WIDE = (
    P_HOUR
    + """, p_wide AS (
  SELECT datetime, """
    + ", ".join(f"sum(CASE WHEN zone = '{n}' THEN demand_mw END) AS \"{n}\"" for n in ZONE_NAMES)
    + """, sum(demand_mw) AS "Ontario Demand", sum(demand_mw) * CAST(1.02 AS DOUBLE) AS "Market Demand",
         sum(demand_mw) AS "Zone Total", CAST(0 AS DOUBLE) AS "Diff"
  FROM p_hour GROUP BY datetime
)"""
)

P_DAY = """p_day AS (
  SELECT o_orderpriority AS zone, o_orderdate AS date, sum(o_totalprice) AS y, count(*) AS n_orders
  FROM orders GROUP BY ALL
)"""

P_DUP = (
    P_HOUR
    + """, p_dup AS (
  SELECT *, 1 AS seq FROM p_hour
  UNION ALL
  SELECT zone, datetime, demand_mw + 1, temperature_c, dew_point_c, relative_humidity_pct,
         wind_speed_kmh, precipitation_mm, 2 AS seq
  FROM p_hour WHERE hour(datetime) % 5 = 0
)"""
)

P_TARGETS = (
    P_HOUR
    + """, p_targets AS (
  SELECT a.zone, a.datetime AS target_datetime, a.demand_mw AS target_demand_mw,
         b.demand_mw AS prediction_mw, c.demand_mw AS lag_168_mw
  FROM p_hour a
  LEFT JOIN p_hour b ON b.zone = a.zone AND b.datetime = a.datetime - INTERVAL 24 HOUR
  LEFT JOIN p_hour c ON c.zone = a.zone AND c.datetime = a.datetime - INTERVAL 168 HOUR
)"""
)

# a horizon of h hours is predicted by the value of ceil(h / 24) days before the target: 24 horizons share a day
P_FORECAST = (
    P_HOUR
    + """, p_days AS (
  SELECT a.zone, a.datetime, a.demand_mw, a.d, b.demand_mw AS prediction_mw, c.demand_mw AS lag_168_mw
  FROM (SELECT *, unnest(range(1, 8)) AS d FROM p_hour) a
  LEFT JOIN p_hour b ON b.zone = a.zone AND b.datetime = a.datetime - to_hours(24 * a.d)
  LEFT JOIN p_hour c ON c.zone = a.zone AND c.datetime = a.datetime - INTERVAL 168 HOUR
), p_forecast AS (
  SELECT zone, datetime AS target_datetime, demand_mw AS target_demand_mw, prediction_mw, lag_168_mw,
         CAST(24 * d - k AS INTEGER) AS forecast_horizon_hours,
         datetime - to_hours(CAST(24 * d - k AS BIGINT)) AS issue_datetime
  FROM (SELECT *, unnest(range(0, 24)) AS k FROM p_days)
)"""
)

P_PROD = """p_prod AS (
  SELECT *, "OutputMW" / "CapabilityMW" AS "UtilizationRate" FROM (
    SELECT r_name AS "Zone", p_type AS "FuelType", l_shipdate AS datetime,
           sum(l_quantity) AS "OutputMW", CAST(count(*) * 50 AS DOUBLE) AS "CapabilityMW",
           count(DISTINCT l_suppkey) AS "NumGenerators"
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ALL
  )
)"""

P_TOTALS = (
    P_FORECAST
    + """, p_totals AS (
  SELECT zone, issue_datetime, target_datetime, forecast_horizon_hours, target_demand_mw, prediction_mw
  FROM p_forecast
  UNION ALL
  SELECT 'Total', issue_datetime, target_datetime, forecast_horizon_hours,
         sum(target_demand_mw), sum(prediction_mw) * CAST(1.01 AS DOUBLE)
  FROM p_forecast GROUP BY issue_datetime, target_datetime, forecast_horizon_hours
)"""
)


def with_sql(panel: str, body: str) -> str:
    return f"WITH {panel} {body}"
