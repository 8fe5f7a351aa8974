"""Checks of lag, lead, rolling, ranking and top-n operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.catalog.base import P_DAY, P_FORECAST, P_HOUR, check, with_sql
from panelcast.operators import ranking as rk
from panelcast.operators import splits as sp
from panelcast.operators import windows as wn
from panelcast.plans import panels as pn

W = "(PARTITION BY zone ORDER BY datetime)"
LAGS = [1, 2, 3, 6, 12, 24, 48, 72, 144, 168, 336]
SIZES = (3, 6, 12, 24, 48, 72, 168)


def _frame(n: int, current: bool) -> str:
    end = "CURRENT ROW" if current else "1 PRECEDING"
    return f"(PARTITION BY zone ORDER BY datetime ROWS BETWEEN {n - 1 if current else n} PRECEDING AND {end})"


def _hours(cols: list[str]) -> str:
    return "zone s, datetime t, " + ", ".join(f"{c} d" for c in cols)


@check(
    "lag_rows",
    _hours([f"temperature_lag_{n}h" for n in LAGS]),
    with_sql(
        P_HOUR,
        "SELECT zone, datetime, "
        + ", ".join(f"lag(temperature_c, {n}) OVER {W} AS temperature_lag_{n}h" for n in LAGS)
        + " FROM p_hour",
    ),
)
def _(t):
    return wn.lag_rows(pn.hourly_panel(t.events), "zone", "datetime", {"temperature_c": "temperature_lag"}, LAGS)


def _checked(y: str, n: int, name: str) -> str:
    word, steps, sign = ("lag", n, 1) if n > 0 else ("lead", -n, -1)
    gap = f"{sign} * date_diff('second', {word}(datetime, {steps}) OVER {W}, datetime)"
    return f"CASE WHEN {gap} = {steps * 3600} THEN {word}({y}, {steps}) OVER {W} END AS {name}"


@check(
    "lag_checked",
    _hours([f"demand_lag_{n}h" for n in LAGS]),
    with_sql(
        P_HOUR,
        "SELECT zone, datetime, " + ", ".join(_checked("demand_mw", n, f"demand_lag_{n}h") for n in LAGS) + " FROM p_hour",
    ),
)
def _(t):
    return wn.lag_checked(pn.hourly_panel(t.events), "zone", "datetime", "demand_mw", LAGS)


@check(
    "lead_checked",
    _hours(["target_demand_mw", "weather_target_temperature_c"]),
    with_sql(
        P_HOUR,
        "SELECT zone, datetime, "
        + _checked("demand_mw", -24, "target_demand_mw")
        + ", "
        + _checked("temperature_c", -24, "weather_target_temperature_c")
        + " FROM p_hour",
    ),
)
def _(t):
    names = {"demand_mw": "target_demand_mw", "temperature_c": "weather_target_temperature_c"}
    return wn.lead_checked(pn.hourly_panel(t.events), "zone", "datetime", names, 24)


SQL_FUNCS = {"mean": "avg", "min": "min", "max": "max", "std": "stddev_samp", "sum": "sum"}


def _rolling(y: str, stem: str, sizes, funcs, current: bool) -> str:
    return ", ".join(
        f"{SQL_FUNCS[f]}({y}) OVER {_frame(n, current)} AS {stem}_{f}_{n}h" for n in sizes for f in funcs
    )


@check(
    "rolling_past",
    _hours([f"demand_rolling_{f}_{n}h" for n in SIZES for f in ("mean", "min", "max", "std")]),
    with_sql(
        P_HOUR,
        "SELECT zone, datetime, "
        + _rolling("demand_mw", "demand_rolling", SIZES, ("mean", "min", "max", "std"), False)
        + " FROM p_hour",
    ),
)
def _(t):
    funcs = ("mean", "min", "max", "std")
    return wn.rolling_past(pn.hourly_panel(t.events), "zone", "datetime", "demand_mw", list(SIZES), funcs)


@check(
    "rolling_trailing",
    _hours([f"temperature_rolling_{f}_{n}h" for n in SIZES for f in ("mean", "min", "max", "std")]),
    with_sql(
        P_HOUR,
        "SELECT zone, datetime, "
        + _rolling("temperature_c", "temperature_rolling", SIZES, ("mean", "min", "max", "std"), True)
        + " FROM p_hour",
    ),
)
def _(t):
    funcs = ("mean", "min", "max", "std")
    return wn.rolling_trailing(pn.hourly_panel(t.events), "zone", "datetime", "temperature_c", list(SIZES), funcs)


@check(
    "rolling_sum0",
    _hours([f"precipitation_rolling_sum_{n}h" for n in (24, 72, 168)]),
    with_sql(
        P_HOUR,
        "SELECT zone, datetime, "
        + _rolling("coalesce(rain, 0)", "precipitation_rolling", (24, 72, 168), ("sum",), True)
        + " FROM (SELECT *, CASE WHEN hour(datetime) % 5 <> 0 THEN precipitation_mm END AS rain FROM p_hour)",
    ),
)
def _(t):
    holed = F.when(F.hour("datetime") % 5 != 0, F.col("precipitation_mm"))
    panel = pn.hourly_panel(t.events).withColumn("rain", holed)
    return wn.rolling_sum0(panel, "zone", "datetime", "rain", [24, 72, 168])


@check(
    "zscore",
    "zone s, datetime t, demand_normalized d",
    with_sql(
        P_HOUR,
        """SELECT zone, datetime, (demand_mw - avg(demand_mw) OVER z) / nullif(stddev_samp(demand_mw) OVER z, 0)
                  AS demand_normalized FROM p_hour WINDOW z AS (PARTITION BY zone)""",
    ),
)
def _(t):
    return wn.zscore(pn.hourly_panel(t.events), "zone", "demand_mw")


@check(
    "rank_average",
    "o_custkey i, total d2, total_rank d",
    """SELECT o_custkey, total, rank() OVER (ORDER BY total DESC) + (count(*) OVER (PARTITION BY total) - 1) / 2
              AS total_rank
       FROM (SELECT o_custkey, round(sum(o_totalprice) / 10000) AS total FROM orders GROUP BY 1)""",
)
def _(t):
    totals = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice") / 10000).alias("total"))
    return rk.rank_average(totals, "total", "total_rank")


@check(
    "top_n_per_group",
    "o_orderpriority s, o_orderkey i, o_totalprice d2",
    """SELECT o_orderpriority, o_orderkey, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders)
       WHERE r <= CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '5-LOW' THEN 6 ELSE 2 END""",
)
def _(t):
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]
    quotas = {"1-URGENT": 5, "2-HIGH": 4, "5-LOW": 6}
    return rk.top_n_per_group(t.orders, "o_orderpriority", order, quotas, default=2)


@check(
    "latest_per_key",
    "zone s, datetime t, demand_mw d, temperature_c d",
    with_sql(
        P_HOUR,
        """SELECT zone, datetime, demand_mw, temperature_c FROM p_hour
           QUALIFY row_number() OVER (PARTITION BY zone ORDER BY datetime DESC) = 1""",
    ),
)
def _(t):
    return rk.latest_per_key(pn.hourly_panel(t.events), "zone", "datetime")


@check(
    "cumulative_share",
    "o_custkey i, gain d2, gain_pct d, cumulative_gain_pct d",
    """SELECT o_custkey, gain, pct AS gain_pct,
              sum(pct) OVER (ORDER BY gain DESC, o_custkey ROWS UNBOUNDED PRECEDING) AS cumulative_gain_pct
       FROM (SELECT *, gain / sum(gain) OVER () * 100 AS pct
             FROM (SELECT o_custkey, sum(o_totalprice) AS gain FROM orders GROUP BY 1))""",
)
def _(t):
    gains = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("gain"))
    return rk.cumulative_share(gains, "gain", ties=["o_custkey"])


@check(
    "downsample_issues",
    "zone s, issue_datetime t, forecast_horizon_hours i, target_demand_mw d",
    with_sql(
        P_FORECAST,
        """, thin AS (
             SELECT *, CAST(issue_datetime AS DATE) AS issue_date FROM p_forecast
             WHERE (CAST(issue_datetime AS DATE) - DATE '2020-01-01') % 3 = 0)
           SELECT zone, issue_datetime, forecast_horizon_hours, target_demand_mw FROM thin
           WHERE (zone, issue_datetime) IN (SELECT (zone, min(issue_datetime)) FROM thin GROUP BY zone, issue_date)""",
    ),
)
def _(t):
    return sp.downsample_issues(pn.forecast_panel(t.events), stride=3)


@check(
    "percentiles",
    "p1 d2, p25 d2, p50 d2, p75 d2, p99 d2",
    "SELECT "
    + ", ".join(f"quantile_cont(o_totalprice, CAST({p / 100} AS DOUBLE)) AS p{p}" for p in (1, 25, 50, 75, 99))
    + " FROM orders",
)
def _(t):
    return rk.percentiles(t.orders, "o_totalprice", [1, 25, 50, 75, 99], stable=True)


@check(
    "percentiles_by_group",
    "l_returnflag s, l_quantity i, p10 d2, p50 d2, p90 d2",
    "SELECT l_returnflag, l_quantity, "
    + ", ".join(f"quantile_cont(l_extendedprice, CAST({p / 100} AS DOUBLE)) AS p{p}" for p in (10, 50, 90))
    + " FROM lineitem GROUP BY 1, 2",
)
def _(t):
    return rk.percentiles(t.lineitem, "l_extendedprice", [10, 50, 90], ["l_returnflag", "l_quantity"], stable=True)


def _folds_sql(k: int, days: int) -> str:
    return f"""last AS (SELECT max(date) AS m FROM p_day),
    folds AS (SELECT CAST(i AS INTEGER) AS fold,
                     m - to_days(CAST(({k} - i + 1) * {days} AS INTEGER)) AS test_start,
                     m - to_days(CAST(({k} - i) * {days} AS INTEGER)) AS test_end
              FROM last, (SELECT unnest(range(1, {k} + 1)) AS i))"""


@check(
    "walk_forward_folds",
    "fold i, test_start t, test_end t, train_rows i, test_rows i",
    with_sql(
        P_DAY + ", " + _folds_sql(5, 30),
        """SELECT fold, test_start, test_end,
                  (SELECT count(*) FROM p_day WHERE date < test_start) AS train_rows,
                  (SELECT count(*) FROM p_day WHERE date >= test_start AND date < test_end) AS test_rows
           FROM folds""",
    ),
)
def _(t):
    return sp.walk_forward_folds(pn.daily_panel(t.orders), issue="date")


SPLIT_SQL = (
    P_DAY
    + """, bounds AS (SELECT max(date) - INTERVAL 60 DAY AS v, max(date) - INTERVAL 30 DAY AS s, max(date) AS e FROM p_day),
split AS (
  SELECT * FROM (
    SELECT zone, date AS issue_datetime, date + INTERVAL 7 DAY AS target_datetime, y,
      CASE WHEN date < v AND date + INTERVAL 7 DAY <= v - INTERVAL 1 HOUR THEN 'train'
           WHEN date >= v AND date < s AND date + INTERVAL 7 DAY <= s - INTERVAL 1 HOUR THEN 'validation'
           WHEN date >= s AND date < e THEN 'test' END AS split
    FROM p_day, bounds) WHERE split IS NOT NULL)"""
)


def _split(t):
    rows = pn.daily_panel(t.orders).withColumnRenamed("date", "issue_datetime")
    ahead = rows.withColumn("target_datetime", F.timestamp_add("DAY", F.lit(7), F.col("issue_datetime")))
    return sp.purged_split(ahead)


@check(
    "purged_split",
    "zone s, issue_datetime t, target_datetime t, split s, y d2",
    with_sql(SPLIT_SQL, "SELECT zone, issue_datetime, target_datetime, split, y FROM split"),
)
def _(t):
    return _split(t)


@check(
    "split_report",
    "split s, rows i, first_issue t, last_issue t, last_target t",
    with_sql(
        SPLIT_SQL,
        """SELECT split, count(*) AS rows, min(issue_datetime) AS first_issue, max(issue_datetime) AS last_issue,
                  max(target_datetime) AS last_target FROM split GROUP BY split""",
    ),
)
def _(t):
    return sp.split_report(_split(t))
