"""Checks of forecast evaluation on the seasonal-naive forecast panel."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from panelcast.catalog.base import P_DAY, P_FORECAST, P_TOTALS, check, with_sql
from panelcast.operators import evaluation as ev
from panelcast.operators.splits import with_folds
from panelcast.plans import panels as pn
from panelcast.plans.monitoring import evaluation_tables

Y, P = "target_demand_mw", "prediction_mw"
ROWS = P_FORECAST + f", ok AS (SELECT *, {Y} AS y, {P} AS p FROM p_forecast WHERE {P} IS NOT NULL AND {Y} IS NOT NULL)"


def _r2(y: str = "y", p: str = "p") -> str:
    return (
        f"CASE WHEN count(*) >= 2 THEN 1 - sum(({y} - {p}) * ({y} - {p})) / nullif(var_pop({y}) * count(*), 0) END"
    )


def _mape(y: str = "y", p: str = "p") -> str:
    return f"avg(CASE WHEN abs({y}) > 1e-6 THEN abs({y} - {p}) / abs({y}) * 100 END)"


def metrics_sql(y: str = "y", p: str = "p", prefix: str = "") -> str:
    return f"""count(*) AS {prefix}observations, avg(abs({y} - {p})) AS {prefix}mae,
      sqrt(avg(({y} - {p}) * ({y} - {p}))) AS {prefix}rmse, {_r2(y, p)} AS {prefix}r2, {_mape(y, p)} AS {prefix}mape,
      avg(CASE WHEN abs({y}) + abs({p}) > 1e-6 THEN 2 * abs({y} - {p}) / (abs({y}) + abs({p})) * 100 END) AS {prefix}smape,
      sum(abs({y} - {p})) / nullif(sum(abs({y})), 0) * 100 AS {prefix}wape, avg({p} - {y}) AS {prefix}bias"""


METRICS = "observations i, mae d, rmse d, r2 d, mape d, smape d, wape d, bias d"


def _rows(t):
    return pn.forecast_panel(t.events)


@check("metrics_overall", METRICS, with_sql(ROWS, f"SELECT {metrics_sql()} FROM ok"))
def _(t):
    return ev.metrics(_rows(t), Y, P)


@check(
    "metrics_by_zone",
    f"zone s, {METRICS}",
    with_sql(ROWS, f"SELECT zone, {metrics_sql()} FROM ok GROUP BY zone"),
)
def _(t):
    return ev.metrics(_rows(t), Y, P, "zone")


@check(
    "metrics_by_zone_and_horizon",
    f"zone s, forecast_horizon_hours i, {METRICS}",
    with_sql(ROWS, f"SELECT zone, forecast_horizon_hours, {metrics_sql()} FROM ok GROUP BY 1, 2"),
)
def _(t):
    return ev.metrics(_rows(t), Y, P, ["zone", "forecast_horizon_hours"])


def full_sql() -> str:
    bands = ", ".join(
        f"avg(CASE WHEN abs((p - y) / nullif(y, 0)) * 100 <= {b} THEN 1.0 ELSE 0.0 END) * 100 AS coverage_{b}pct"
        for b in (1, 2, 5, 10)
    )
    spread = ", ".join(
        f"quantile_cont(abs(p - y), CAST({q / 100} AS DOUBLE)) AS error_q{q}" for q in (25, 50, 75, 90, 95, 99)
    )
    return f"""avg(abs(p - y)) AS mae, sqrt(avg((p - y) * (p - y))) AS rmse, {_mape()} AS mape, {_r2()} AS r2,
      avg(p - y) AS bias_mw, avg(p - y) / nullif(avg(y), 0) * 100 AS bias_pct, {bands}, {spread},
      count(*) AS n_samples, avg(y) AS mean_actual, stddev_samp(y) AS std_actual, avg(p) AS mean_pred, stddev_samp(p) AS std_pred"""


FULL = (
    "mae d, rmse d, mape d, r2 d, bias_mw d, bias_pct d, coverage_1pct d, coverage_2pct d, coverage_5pct d, "
    "coverage_10pct d, error_q25 d, error_q50 d, error_q75 d, error_q90 d, error_q95 d, error_q99 d, n_samples i, "
    "mean_actual d, std_actual d, mean_pred d, std_pred d"
)


@check("metrics_full", FULL, with_sql(ROWS, f"SELECT {full_sql()} FROM ok"))
def _(t):
    return ev.metrics_full(_rows(t), Y, P)


@check("metrics_full_by_zone", f"zone s, {FULL}", with_sql(ROWS, f"SELECT zone, {full_sql()} FROM ok GROUP BY zone"))
def _(t):
    return ev.metrics_full(_rows(t), Y, P, "zone")


def _slice(by: str, dimension: str, hour: str, dow: str, name: str, kind: str, bias: str) -> str:
    return f"""SELECT '{dimension}' AS time_dimension, {hour} AS hour, {dow} AS day_of_week, {name} AS day_name,
      {kind} AS day_type, {_mape()} AS mape, avg(abs(p - y)) AS mae, sqrt(avg((p - y) * (p - y))) AS rmse,
      avg(y) AS avg_demand, count(*) AS n_samples, {bias} AS bias_pct FROM ok GROUP BY {by}"""


_DOW = "isodow(target_datetime) - 1"
_NAME = "list_extract([" + ", ".join(f"'{n}'" for n in ev.WEEKDAYS) + "], isodow(target_datetime))"
_KIND = "CASE WHEN isodow(target_datetime) >= 6 THEN 'Weekend' ELSE 'Weekday' END"


_BY_TIME_COLUMNS = (
    "time_dimension s, hour i, day_of_week i, day_name s, day_type s, mape d, mae d, rmse d, avg_demand d, n_samples i, bias_pct d"
)
_BY_TIME = " UNION ALL ".join(
    [
        _slice(
            "hour(target_datetime)", "hour", "hour(target_datetime)", "NULL", "NULL", "NULL",
            "avg(p - y) / nullif(avg(y), 0) * 100",
        ),
        _slice("isodow(target_datetime)", "day_of_week", "NULL", _DOW, _NAME, "NULL", "NULL"),
        _slice(_KIND, "day_type", "NULL", "NULL", "NULL", _KIND, "NULL"),
    ]
)


@check("metrics_by_time", _BY_TIME_COLUMNS, with_sql(ROWS, _BY_TIME))
def _(t):
    return ev.metrics_by_time(_rows(t), Y, P)


_BY_HORIZON_COLUMNS = "horizon_hours i, horizon_label s, mape d, mae d, rmse d, bias_pct d, r2 d, avg_demand d, n_samples i"
_BY_HORIZON = f"""SELECT forecast_horizon_hours AS horizon_hours, 'H+' || forecast_horizon_hours AS horizon_label,
  {_mape()} AS mape, avg(abs(p - y)) AS mae, sqrt(avg((p - y) * (p - y))) AS rmse,
  avg(p - y) / nullif(avg(y), 0) * 100 AS bias_pct, {_r2()} AS r2, avg(y) AS avg_demand, count(*) AS n_samples
  FROM ok WHERE forecast_horizon_hours IN (1, 6, 12, 24, 48, 72, 96, 120, 144, 168) GROUP BY 1"""


@check("metrics_by_horizon", _BY_HORIZON_COLUMNS, with_sql(ROWS, _BY_HORIZON))
def _(t):
    return ev.metrics_by_horizon(_rows(t), Y, P)


@check(
    "degradation",
    "first_value d, last_value d, slope d, trend_r2 d, degradation d, degradation_pct d",
    with_sql(
        ROWS,
        f""", h AS ({_BY_HORIZON}), e AS (
          SELECT arg_min(mape, horizon_hours) AS first_value, arg_max(mape, horizon_hours) AS last_value,
                 regr_slope(mape, horizon_hours) AS slope, regr_r2(mape, horizon_hours) AS trend_r2 FROM h)
        SELECT *, last_value - first_value AS degradation, (last_value - first_value) / first_value * 100 AS degradation_pct
        FROM e""",
    ),
)
def _(t):
    return ev.degradation(ev.metrics_by_horizon(_rows(t), Y, P), "horizon_hours", "mape")


_SPREAD_COLUMNS = (
    "error_mean d, error_std d, error_median d, error_abs_mean d, error_abs_median d, error_pct_mean d, error_pct_std d, "
    + ", ".join(f"{n} d" for n in ev.DISTRIBUTION_SHARES)
)
_SPREAD = (
    "SELECT avg(p - y) AS error_mean, stddev_samp(p - y) AS error_std, quantile_cont(p - y, 0.5) AS error_median, "
    "avg(abs(p - y)) AS error_abs_mean, quantile_cont(abs(p - y), 0.5) AS error_abs_median, "
    "avg((p - y) / nullif(y, 0) * 100) AS error_pct_mean, stddev_samp((p - y) / nullif(y, 0) * 100) AS error_pct_std, "
    + ", ".join(f"quantile_cont(abs(p - y), CAST({q} AS DOUBLE)) AS {n}" for n, q in ev.DISTRIBUTION_SHARES.items())
    + " FROM ok"
)


@check("error_distribution", _SPREAD_COLUMNS, with_sql(ROWS, _SPREAD))
def _(t):
    return ev.error_distribution(_rows(t), Y, P)


@check(
    "row_errors",
    "zone s, issue_datetime t, forecast_horizon_hours i, error_mw d, absolute_error_mw d, absolute_percentage_error d",
    with_sql(
        P_FORECAST,
        f"""SELECT zone, issue_datetime, forecast_horizon_hours, {P} - {Y} AS error_mw, abs({P} - {Y}) AS absolute_error_mw,
              CASE WHEN abs({Y}) > 1e-6 THEN abs({P} - {Y}) / abs({Y}) * 100 END AS absolute_percentage_error FROM p_forecast""",
    ),
)
def _(t):
    return ev.row_errors(_rows(t), Y, P)


def _banded(t):
    scaled = {"p10": 0.8, "p50": 1.0, "p90": 1.25}
    return _rows(t).withColumns({n: F.col(P) * s for n, s in scaled.items()})


_BAND = ROWS + """, banded AS (SELECT *, p * CAST(0.8 AS DOUBLE) AS p10, p AS p50, p * CAST(1.25 AS DOUBLE) AS p90 FROM ok)"""


@check(
    "pinball_loss",
    "zone s, pinball_p10 d, pinball_p50 d, pinball_p90 d",
    with_sql(
        _BAND,
        "SELECT zone, "
        + ", ".join(
            f"avg(greatest(CAST({q} AS DOUBLE) * (y - {n}), (CAST({q} AS DOUBLE) - 1) * (y - {n}))) AS pinball_{n}"
            for n, q in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9))
        )
        + " FROM banded GROUP BY zone",
    ),
)
def _(t):
    return ev.pinball(_banded(t), Y, {"p10": 0.1, "p50": 0.5, "p90": 0.9}, "zone")


@check(
    "interval_coverage",
    "zone s, coverage_pct d, mean_width d",
    with_sql(
        _BAND,
        """SELECT zone, avg(CASE WHEN y BETWEEN p10 AND p90 THEN 1.0 ELSE 0.0 END) * 100 AS coverage_pct,
                  avg(p90 - p10) AS mean_width FROM banded GROUP BY zone""",
    ),
)
def _(t):
    return ev.interval_coverage(ev.finite_pairs(_banded(t), Y, P), Y, "p10", "p90", "zone")


@check(
    "compare_baselines",
    f"model s, {METRICS}",
    with_sql(
        P_FORECAST,
        f""", long AS (SELECT '{P}' AS model, {Y} AS y, {P} AS p FROM p_forecast WHERE {P} IS NOT NULL
             UNION ALL SELECT 'lag_168_mw', {Y}, lag_168_mw FROM p_forecast WHERE lag_168_mw IS NOT NULL)
           SELECT model, {metrics_sql()} FROM long GROUP BY model""",
    ),
)
def _(t):
    return ev.compare_baselines(_rows(t), Y, [P, "lag_168_mw"])


_RECON = (
    P_TOTALS
    + f""", zs AS (SELECT issue_datetime, target_datetime, sum({Y}) AS bottomup_actual_mw, sum({P}) AS bottomup_predicted_mw
                  FROM p_totals WHERE zone <> 'Total' GROUP BY 1, 2),
            ds AS (SELECT issue_datetime, target_datetime, min({Y}) AS direct_actual_mw, min({P}) AS direct_predicted_mw
                  FROM p_totals WHERE zone = 'Total' GROUP BY 1, 2),
            rec AS (SELECT * FROM zs JOIN ds USING (issue_datetime, target_datetime))"""
)


@check(
    "reconcile_bottom_up",
    "issue_datetime t, target_datetime t, bottomup_actual_mw d, bottomup_predicted_mw d, direct_actual_mw d, direct_predicted_mw d",
    with_sql(_RECON, "SELECT * FROM rec"),
)
def _(t):
    return ev.reconcile_bottom_up(pn.totals_with_zones(_rows(t)), Y, P, "Total")


def _pair(side: str) -> str:
    keep = f"{side}_actual_mw IS NOT NULL AND {side}_predicted_mw IS NOT NULL"
    return f"(SELECT {metrics_sql(side + '_actual_mw', side + '_predicted_mw', side + '_')} FROM rec WHERE {keep})"


@check(
    "coherence",
    "coherence_gap_mw d, "
    + ", ".join(f"{s}_{m}" for s in ("bottomup", "direct") for m in METRICS.split(", ")),
    with_sql(
        _RECON,
        f"""SELECT * FROM (SELECT avg(abs(bottomup_actual_mw - direct_actual_mw)) AS coherence_gap_mw FROM rec),
            {_pair('bottomup')}, {_pair('direct')}""",
    ),
)
def _(t):
    return ev.coherence(ev.reconcile_bottom_up(pn.totals_with_zones(_rows(t)), Y, P, "Total"))


@check(
    "verdict",
    "zone s, mape d, bias_pct d, verdict s, bias_class s",
    with_sql(
        ROWS,
        f""", m AS (SELECT zone, {_mape()} AS mape, avg(p - y) / nullif(avg(y), 0) * 100 AS bias_pct FROM ok GROUP BY zone)
           SELECT *, CASE WHEN mape < 170 THEN 'excellent' WHEN mape < 300 THEN 'acceptable' ELSE 'insufficient' END AS verdict,
                  CASE WHEN abs(bias_pct) < 0.5 THEN 'negligible' WHEN abs(bias_pct) < 1.0 THEN 'slight'
                       ELSE 'significant' END AS bias_class FROM m""",
    ),
)
def _(t):
    found = ev.metrics_full(_rows(t), Y, P, "zone").withColumn("model_type", F.lit("naive"))
    return ev.verdict(found, {"naive": (170.0, 300.0)})


_PER_DAY = f"d AS (SELECT CAST(target_datetime AS DATE) AS day, {_mape()} AS mape FROM ok GROUP BY 1)"


@check(
    "day_stats",
    "mean d, median d, std d, variation_pct d, days_under_target i, days i",
    with_sql(
        ROWS,
        f""", {_PER_DAY} SELECT avg(mape) AS mean, quantile_cont(mape, 0.5) AS median, stddev_samp(mape) AS std,
              stddev_samp(mape) / avg(mape) * 100 AS variation_pct, count(*) FILTER (mape < 200) AS days_under_target,
              count(*) AS days FROM d""",
    ),
)
def _(t):
    by_day = ev.metrics(_rows(t).withColumn("day", F.to_date("target_datetime")), Y, P, "day")
    return ev.day_stats(by_day, "mape", 200.0)


@check(
    "fold_summary",
    "folds i, wape_mean d, wape_std d, mae_mean d2, mae_std d2, rmse_mean d2, rmse_std d2, mape_mean d, mape_std d",
    with_sql(
        P_DAY,
        f""", pairs AS (SELECT a.date, a.y, b.y AS p FROM p_day a
                       JOIN p_day b ON b.zone = a.zone AND b.date = a.date - INTERVAL 7 DAY),
           last AS (SELECT max(date) AS m FROM pairs),
           tagged AS (SELECT *, CAST(ceil(date_diff('day', date, m) / 30) AS INTEGER) AS back FROM pairs, last WHERE date < m),
           f AS (SELECT back, {metrics_sql()} FROM tagged WHERE back <= 5 GROUP BY back)
           SELECT count(*) AS folds, """
        + ", ".join(f"avg({m}) AS {m}_mean, stddev_samp({m}) AS {m}_std" for m in ("wape", "mae", "rmse", "mape"))
        + " FROM f",
    ),
)
def _(t):
    from panelcast.operators.windows import lag_exact

    days = lag_exact(pn.daily_panel(t.orders), "zone", "date", "y", [7], stem="p", step=24 * 3600)
    pairs = days.filter(F.col("p_7h").isNotNull())
    folded = with_folds(pairs, 5, 30, "date").filter("fold > 0")
    return ev.fold_summary(ev.metrics(folded, "y", "p_7h", "fold"))


@check(
    "latest_issue_profile",
    "target_datetime t, actual_demand_mw d, predicted_demand_mw d",
    with_sql(
        P_FORECAST,
        f"""SELECT target_datetime, sum({Y}) AS actual_demand_mw, sum({P}) AS predicted_demand_mw FROM p_forecast
            WHERE issue_datetime = (SELECT max(issue_datetime) FROM p_forecast) GROUP BY 1""",
    ),
)
def _(t):
    return ev.latest_issue_profile(_rows(t), Y, P)


def _tables(t) -> dict:
    return evaluation_tables(ev.finite_pairs(_rows(t), Y, P), "24h", "run", datetime(2024, 2, 1))


_STAMP = "TIMESTAMP '2024-02-01 00:00:00' AS evaluation_time, '24h' AS model_type, 'run' AS model_run_id"
_STAMPED = "evaluation_time t, model_type s, model_run_id s"


@check(
    "evaluation_global",
    f"{FULL}, test_period_start t, test_period_end t, {_STAMPED}",
    with_sql(
        ROWS,
        f"""SELECT {full_sql()}, min(target_datetime) AS test_period_start, max(target_datetime) AS test_period_end, {_STAMP}
            FROM ok""",
    ),
)
def _(t):
    return _tables(t)["model_performance_global"]


@check("evaluation_by_zone", f"zone s, {FULL}, {_STAMPED}", with_sql(ROWS, f"SELECT zone, {full_sql()}, {_STAMP} FROM ok GROUP BY zone"))
def _(t):
    return _tables(t)["model_performance_by_zone"]


@check(
    "evaluation_by_time",
    f"{_BY_TIME_COLUMNS}, {_STAMPED}",
    with_sql(ROWS, f"SELECT *, {_STAMP} FROM ({_BY_TIME})"),
)
def _(t):
    return _tables(t)["model_performance_by_time"]


@check(
    "evaluation_by_horizon",
    f"{_BY_HORIZON_COLUMNS}, {_STAMPED}",
    with_sql(ROWS, f"SELECT *, {_STAMP} FROM ({_BY_HORIZON})"),
)
def _(t):
    return _tables(t)["model_performance_by_horizon"]


@check(
    "evaluation_errors",
    f"{_SPREAD_COLUMNS}, {_STAMPED}",
    with_sql(ROWS, f"SELECT *, {_STAMP} FROM ({_SPREAD})"),
)
def _(t):
    return _tables(t)["model_error_distribution"]


@check(
    "evaluation_sample",
    f"zone s, target_datetime t, actual_demand_mw d, predicted_demand_mw d, error_mw d, error_pct d, {_STAMPED}",
    with_sql(
        ROWS,
        f"""SELECT zone, target_datetime, y AS actual_demand_mw, p AS predicted_demand_mw, p - y AS error_mw,
               (p - y) / nullif(y, 0) * 100 AS error_pct, {_STAMP} FROM ok
            ORDER BY md5('42|' || zone || '|' || strftime(target_datetime, '%Y-%m-%d %H:%M:%S') || '|' || forecast_horizon_hours),
                     zone, target_datetime, forecast_horizon_hours LIMIT 1000""",
    ),
)
def _(t):
    return _tables(t)["model_predictions_sample"]
