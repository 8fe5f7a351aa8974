"""Checks of models, scoring and backtests. One-input linear models have an exact SQL form."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from panelcast.catalog.base import P_DAY, P_FORECAST, P_HOUR, check, with_sql
from panelcast.catalog.evaluations import METRICS, metrics_sql
from panelcast.catalog.features import SCORING_CTES, SCORING_SELECT
from panelcast.catalog.tables import scratch
from panelcast.functions.scalars import horizon_features
from panelcast.functions.timecols import cyclic
from panelcast.operators import modelling as ml
from panelcast.operators import recursive
from panelcast.operators import splits as sp
from panelcast.operators.trees import Forest, Split
from panelcast.operators.windows import lag_exact
from panelcast.plans import panels as pn
from panelcast.plans.scoring import direct_run, scoring_features
from panelcast.plans.training import backtest_report, train
from panelcast.schemas import WEATHER_MEASURES

Y, P = "target_demand_mw", "prediction_mw"
CUT = datetime(2024, 1, 20)
CUT_SQL = "TIMESTAMP '2024-01-20'"


def _naive(t):
    """Forecast rows whose naive prediction serves as the only model input."""
    rows = pn.forecast_panel(t.events).dropna(subset=[P, Y])
    return rows.withColumnRenamed(P, "lag_24_mw")


@check(
    "linear_forecast",
    "zone s, issue_datetime t, forecast_horizon_hours i, prediction_mw d",
    with_sql(
        P_FORECAST,
        f""", fit AS (SELECT regr_slope({Y}, {P}) AS b, regr_intercept({Y}, {P}) AS a FROM p_forecast
                     WHERE {P} IS NOT NULL AND target_datetime < {CUT_SQL})
           SELECT zone, issue_datetime, forecast_horizon_hours, a + b * {P} AS prediction_mw FROM p_forecast, fit
           WHERE {P} IS NOT NULL AND target_datetime >= {CUT_SQL}""",
    ),
)
def _(t):
    rows = _naive(t)
    model = ml.fit_point(rows.filter(F.col("target_datetime") < F.lit(CUT)), ["lag_24_mw"], Y, "linear", regParam=0.0)
    return ml.predict(model, rows.filter(F.col("target_datetime") >= F.lit(CUT)))


def _wide_rows(t):
    rows = _naive(t).withColumns(horizon_features())
    return rows.withColumns(cyclic(F.hour("target_datetime"), 24, "target_hour"))


INPUTS = ["zone", "lag_24_mw", "lag_168_mw", "target_hour_sin", "target_hour_cos", "forecast_horizon_sqrt"]


def _trees(t):
    rows = _wide_rows(t)
    typed = ml.prepare_types(rows, INPUTS, Y)
    past = typed.filter(F.col("target_datetime") < F.lit(CUT))
    return ml.fit_point(past, INPUTS, Y, "gbt"), typed


@check("boosted_forecast", "zone s, issue_datetime t, forecast_horizon_hours i, prediction_mw d")
def _(t):
    model, rows = _trees(t)
    return ml.predict(model, rows.filter(F.col("target_datetime") >= F.lit(CUT)))


@check("feature_importance", "feature s, gain d, gain_pct d, cumulative_gain_pct d")
def _(t):
    model, rows = _trees(t)
    return ml.feature_importance(model, rows)


@check(
    "model_reload",
    "rows i, max_difference d",
    with_sql(P_FORECAST, f"SELECT count(*) AS rows, CAST(0 AS DOUBLE) AS max_difference FROM p_forecast WHERE {P} IS NOT NULL AND {Y} IS NOT NULL"),
)
def _(t):
    rows = _naive(t)
    model = ml.fit_point(rows, ["lag_24_mw"], Y, "linear")
    return ml.check_reload(model, rows, scratch(t, "model"))


@check(
    "quantile_bands",
    "zone s, issue_datetime t, forecast_horizon_hours i, p10_mw d, p50_mw d, p90_mw d",
    with_sql(
        P_FORECAST,
        f""", r AS (SELECT zone, forecast_horizon_hours, {', '.join(
            f"quantile_cont({Y} - {P}, CAST({q / 100} AS DOUBLE)) AS r{q}" for q in (10, 50, 90))}
            FROM p_forecast WHERE {P} IS NOT NULL AND target_datetime < {CUT_SQL} GROUP BY 1, 2)
           SELECT f.zone, issue_datetime, f.forecast_horizon_hours, {P} + r10 AS p10_mw, {P} + r50 AS p50_mw, {P} + r90 AS p90_mw
           FROM p_forecast f LEFT JOIN r USING (zone, forecast_horizon_hours)
           WHERE {P} IS NOT NULL AND target_datetime >= {CUT_SQL}""",
    ),
)
def _(t):
    rows = pn.forecast_panel(t.events).dropna(subset=[P])
    before, after = (rows.filter(F.col("target_datetime") < F.lit(CUT)), rows.filter(F.col("target_datetime") >= F.lit(CUT)))
    return ml.quantile_bands(before, after, Y, P)


def _daily_pairs(t):
    days = lag_exact(pn.daily_panel(t.orders), "zone", "date", "y", [7], stem="lag", step=24 * 3600)
    pairs = days.filter(F.col("lag_7h").isNotNull()).withColumnRenamed("date", "issue_datetime")
    return pairs.withColumn("target_datetime", F.timestamp_add("DAY", F.lit(1), F.col("issue_datetime")))


@check(
    "backtest",
    "zone s, issue_datetime t, fold i, prediction_mw d2",
    with_sql(
        P_DAY,
        """, pairs AS (SELECT a.zone, a.date AS issue, a.date + INTERVAL 1 DAY AS target, a.y, b.y AS x FROM p_day a
                       JOIN p_day b ON b.zone = a.zone AND b.date = a.date - INTERVAL 7 DAY),
           last AS (SELECT max(issue) AS m FROM pairs),
           tagged AS (SELECT pairs.*, greatest(5 - CAST(ceil(date_diff('day', issue, m) / 30) AS INTEGER) + 1, 0) AS fold
                      FROM pairs, last WHERE issue < m),
           starts AS (SELECT fold, min(issue) AS s FROM tagged WHERE fold > 0 GROUP BY fold),
           fits AS (SELECT s.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM starts s
                    JOIN tagged r ON r.fold < s.fold AND r.target < s.s GROUP BY s.fold)
           SELECT zone, issue AS issue_datetime, tagged.fold, a + b * x AS prediction_mw FROM tagged JOIN fits USING (fold)""",
    ),
)
def _(t):
    rows = _daily_pairs(t)
    return ml.backtest(rows, lambda df: ml.fit_point(df, ["lag_7h"], "y", "linear", settled=True, regParam=0.0))


REF = datetime(2024, 1, 25, 8, 0)
R = "TIMESTAMP '2024-01-25 08:00:00'"


@check(
    "score_direct",
    "zone s, target_datetime t, forecast_horizon_hours i, predicted_demand_mw d",
    with_sql(
        P_HOUR,
        f""", fit AS (SELECT regr_slope(demand_mw, wind_speed_kmh) AS b, regr_intercept(demand_mw, wind_speed_kmh) AS a
                     FROM p_hour WHERE datetime <= {R}),
           z AS (SELECT zone, avg(wind_speed_kmh) AS x FROM p_hour WHERE datetime <= {R} GROUP BY zone)
           SELECT p.zone, p.datetime AS target_datetime, date_diff('hour', {R}, p.datetime) AS forecast_horizon_hours,
                  a + b * x AS predicted_demand_mw FROM p_hour p JOIN z ON z.zone = p.zone, fit
           WHERE date_diff('hour', {R}, p.datetime) BETWEEN 1 AND 168""",
    ),
)
def _(t):
    panel = pn.hourly_panel(t.events)
    known = panel.filter(F.col("datetime") <= F.lit(REF))
    model = ml.fit_point(known, ["wind_speed_kmh"], "demand_mw", "linear", regParam=0.0)
    features = known.groupBy("zone").agg(F.avg("wind_speed_kmh").alias("wind_speed_kmh"))
    targets = panel.select("zone", F.col("datetime").alias("target_datetime"))
    return ml.score_direct(model, targets, features, REF)


COEFFICIENTS = {"demand_lag_1h": 0.5, "demand_change_1h": 0.3, "demand_lag_24h": 0.2, "temperature": 1.5}


def _recursive_sql(formula: str) -> str:
    """24 steps of a formula of v1 (the last hour), v2 (the one before), l24 (a day before that) and tc."""
    return f"""WITH RECURSIVE {P_HOUR}, hist AS (
          SELECT zone, datetime, demand_mw AS y FROM p_hour WHERE datetime BETWEEN {R} - INTERVAL 388 HOUR AND {R}),
        grid AS (SELECT zone, unnest(generate_series(min(datetime), {R}, INTERVAL 1 HOUR)) AS datetime FROM hist GROUP BY zone),
        regular AS (SELECT g.zone, g.datetime, y, CASE WHEN y IS NOT NULL THEN g.datetime END AS known
                    FROM grid g LEFT JOIN hist h ON h.zone = g.zone AND h.datetime = g.datetime),
        edges AS (SELECT *, last_value(y IGNORE NULLS) OVER b AS py, last_value(known IGNORE NULLS) OVER b AS pt,
                         first_value(y IGNORE NULLS) OVER a AS ny, first_value(known IGNORE NULLS) OVER a AS nt FROM regular
                  WINDOW b AS (PARTITION BY zone ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                         a AS (PARTITION BY zone ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        s AS (SELECT zone, datetime, CASE WHEN y IS NOT NULL THEN y
                WHEN py IS NOT NULL AND ny IS NOT NULL AND epoch(datetime) - epoch(pt) <= 7200
                THEN py + (ny - py) * (epoch(datetime) - epoch(pt)) / (epoch(nt) - epoch(pt)) END AS v FROM edges),
        zones AS (SELECT DISTINCT zone FROM hist),
        hours AS (SELECT z.zone, n, {R} + to_hours(n) AS hr, {R} + to_hours(n - 25) AS day_before
                  FROM zones z, (SELECT unnest(range(1, 25)) AS n)),
        inputs AS (SELECT h.zone, n, hr, coalesce(s.v, 0) AS l24, coalesce(p.temperature_c, 0) AS tc, p.temperature_c AS raw, p.zone IS NOT NULL AS wanted
                   FROM hours h LEFT JOIN s ON s.zone = h.zone AND s.datetime = day_before
                   LEFT JOIN p_hour p ON p.zone = h.zone AND p.datetime = h.hr),
        steps AS (
          SELECT z.zone, CAST(0 AS BIGINT) AS n,
                 (SELECT v FROM s WHERE s.zone = z.zone AND s.datetime = {R}) AS v1,
                 (SELECT v FROM s WHERE s.zone = z.zone AND s.datetime = {R} - INTERVAL 1 HOUR) AS v2 FROM zones z
          UNION ALL
          SELECT i.zone, i.n,
                 CASE WHEN wanted THEN {formula} END AS v1, v1 AS v2
          FROM steps JOIN inputs i ON i.zone = steps.zone AND i.n = steps.n + 1)
        SELECT steps.zone, {R} + to_hours(n) AS target_datetime, v1 AS predicted_demand_mw FROM steps
        WHERE n > 0 AND v1 IS NOT NULL"""


def _hours_to_score(t):
    panel = pn.hourly_panel(t.events)
    return panel, panel.select("zone", F.col("datetime").alias("target_datetime"), F.col("temperature_c").alias("temperature"))


@check(
    "score_recursive",
    "zone s, target_datetime t, predicted_demand_mw d",
    _recursive_sql(
        """10 + CAST(0.5 AS DOUBLE) * coalesce(v2, 0) + CAST(0.3 AS DOUBLE) * coalesce(v1 - v2, 0)
           + CAST(0.2 AS DOUBLE) * l24 + CAST(1.5 AS DOUBLE) * tc"""
    ),
)
def _(t):
    return recursive.score_recursive(COEFFICIENTS, 10.0, *_hours_to_score(t), REF)


# Three small trees on the demand of an hour and of a day before, its change and the temperature.
FOREST = Forest(
    [
        (1.0, Split("demand_lag_1h", Split("temperature", 110.0, 140.0, at=8.0), Split("demand_lag_24h", 170.0, 215.0, at=180.0), at=150.0)),
        (0.5, Split("demand_change_1h", -12.0, Split("demand_lag_1h", 9.0, 21.0, at=200.0), at=0.0)),
        (0.25, Split("temperature", Split("demand_lag_24h", 4.0, 6.0, at=120.0), -8.0, at=20.0)),
    ],
    fill={"demand_lag_1h": 160.0, "temperature": 5.0},
)


@check(
    "score_recursive_trees",
    "zone s, target_datetime t, predicted_demand_mw d",
    _recursive_sql(
        """CAST(CASE WHEN coalesce(v2, 160) <= 150 THEN CASE WHEN coalesce(raw, 5) <= 8 THEN 110 ELSE 140 END
                ELSE CASE WHEN l24 <= 180 THEN 170 ELSE 215 END END AS DOUBLE)
           + CAST(0.5 AS DOUBLE) * CASE WHEN coalesce(v1 - v2, 0) <= 0 THEN -12
                ELSE CASE WHEN coalesce(v2, 160) <= 200 THEN 9 ELSE 21 END END
           + CAST(0.25 AS DOUBLE) * CASE WHEN coalesce(raw, 5) <= 20 THEN CASE WHEN l24 <= 120 THEN 4 ELSE 6 END ELSE -8 END"""
    ),
)
def _(t):
    return recursive.score_recursive_trees(FOREST, *_hours_to_score(t), REF)


@check(
    "folds_by_row",
    "zone s, date t, fold i",
    with_sql(
        P_DAY,
        """, last AS (SELECT max(date) AS m FROM p_day)
           SELECT zone, date, CASE WHEN date < m
             THEN greatest(5 - CAST(ceil(date_diff('day', date, m) / 30) AS INTEGER) + 1, 0) END AS fold FROM p_day, last""",
    ),
)
def _(t):
    return sp.with_folds(pn.daily_panel(t.orders), issue="date")


# --- whole jobs ----------------------------------------------------------------------------------

_PARTS = f"""rows AS (SELECT zone, issue_datetime, target_datetime, forecast_horizon_hours, {Y} AS y, {P} AS x
                      FROM p_forecast WHERE {P} IS NOT NULL),
    e AS (SELECT max(issue_datetime) AS e FROM rows),
    parts AS (SELECT rows.*, CASE
        WHEN issue_datetime < e - INTERVAL 10 DAY AND target_datetime <= e - INTERVAL 10 DAY - INTERVAL 1 HOUR THEN 'train'
        WHEN issue_datetime >= e - INTERVAL 10 DAY AND issue_datetime < e - INTERVAL 5 DAY
             AND target_datetime <= e - INTERVAL 5 DAY - INTERVAL 1 HOUR THEN 'validation'
        WHEN issue_datetime >= e - INTERVAL 5 DAY AND issue_datetime < e THEN 'test' END AS part FROM rows, e),
    first AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM parts WHERE part = 'train'),
    final AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM parts WHERE part IN ('train', 'validation')),
    r AS (SELECT zone, forecast_horizon_hours, {', '.join(
        f'quantile_cont(y - (a + b * x), CAST({q / 100} AS DOUBLE)) AS r{q}' for q in (10, 50, 90))}
        FROM parts, first WHERE part = 'validation' GROUP BY 1, 2),
    ok AS MATERIALIZED (SELECT t.zone, t.issue_datetime, t.target_datetime, t.forecast_horizon_hours, y, a + b * x AS p,
        a + b * x + r10 AS p10, a + b * x + r50 AS p50, a + b * x + r90 AS p90
        FROM parts t CROSS JOIN final LEFT JOIN r ON r.zone = t.zone AND r.forecast_horizon_hours = t.forecast_horizon_hours
        WHERE part = 'test')"""
_RUN = with_sql(P_FORECAST, f", {_PARTS}")


def _run(t) -> dict:
    rows = _naive(t)
    return train(rows, lambda df: ml.fit_point(df, ["lag_24_mw"], Y, "linear", settled=True, regParam=0.0), Y, days=5)[1]


@check("training_split", "split s, rows i, first_issue t, last_issue t, last_target t", f"""{_RUN}
    SELECT part AS split, count(*) AS rows, min(issue_datetime) AS first_issue, max(issue_datetime) AS last_issue,
           max(target_datetime) AS last_target FROM parts WHERE part IS NOT NULL GROUP BY part""")
def _(t):
    return _run(t)["split"]


@check("training_metrics", f"zone s, forecast_horizon_hours i, {METRICS}", f"""{_RUN}
    SELECT zone, forecast_horizon_hours, {metrics_sql()} FROM ok GROUP BY 1, 2""")
def _(t):
    return _run(t)["metrics_by_zone_and_horizon"]


@check("training_bands", "pinball_p10_mw d, pinball_p50_mw d, pinball_p90_mw d, coverage_pct d, mean_width d", f"""{_RUN}
    SELECT {', '.join(
        f'avg(greatest(CAST({q / 100} AS DOUBLE) * (y - p{q}), (CAST({q / 100} AS DOUBLE) - 1) * (y - p{q}))) AS pinball_p{q}_mw'
        for q in (10, 50, 90))},
        avg(CASE WHEN y BETWEEN p10 AND p90 THEN 100.0 ELSE 0 END) AS coverage_pct, avg(p90 - p10) AS mean_width FROM ok""")
def _(t):
    tables = _run(t)
    return tables["pinball"].crossJoin(tables["coverage"])


@check(
    "backtest_report",
    f"fold i, test_start t, test_end t, train_rows i, test_rows i, {METRICS}, "
    "pinball_p10_mw d, pinball_p50_mw d, pinball_p90_mw d, coverage_pct d, mean_width d",
    with_sql(
        P_DAY,
        f""", pairs AS (SELECT a.zone, a.date AS issue, a.date + INTERVAL 1 DAY AS target, a.y, b.y AS x FROM p_day a
                       JOIN p_day b ON b.zone = a.zone AND b.date = a.date - INTERVAL 7 DAY),
           last AS (SELECT max(issue) AS m FROM pairs),
           tagged AS (SELECT pairs.*, greatest(5 - CAST(ceil(date_diff('day', issue, m) / 30) AS INTEGER) + 1, 0) AS fold
                      FROM pairs, last WHERE issue < m),
           starts AS (SELECT fold, min(issue) AS s FROM tagged WHERE fold > 0 GROUP BY fold),
           fits AS (SELECT s.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM starts s
                    JOIN tagged r ON r.fold < s.fold AND r.target < s.s GROUP BY s.fold),
           ok AS MATERIALIZED (SELECT zone, fold, y, a + b * x AS p FROM tagged JOIN fits USING (fold)),
           r AS (SELECT zone, {', '.join(f"quantile_cont(y - p, CAST({q / 100} AS DOUBLE)) AS r{q}" for q in (10, 50, 90))}
                 FROM ok WHERE fold < 5 GROUP BY zone),
           banded AS (SELECT ok.*, p + r10 AS p10, p + r50 AS p50, p + r90 AS p90 FROM ok JOIN r USING (zone) WHERE fold = 5),
           judged AS (SELECT 5 AS fold, {', '.join(
               f'avg(greatest(CAST({q / 100} AS DOUBLE) * (y - p{q}), (CAST({q / 100} AS DOUBLE) - 1) * (y - p{q}))) AS pinball_p{q}_mw'
               for q in (10, 50, 90))},
               avg(CASE WHEN y BETWEEN p10 AND p90 THEN 100.0 ELSE 0 END) AS coverage_pct, avg(p90 - p10) AS mean_width FROM banded),
           bounds AS (SELECT fold, m - to_days(30 * (6 - fold)) AS test_start, m - to_days(30 * (5 - fold)) AS test_end,
                             (SELECT count(*) FROM tagged t WHERE t.fold < n.fold) AS train_rows,
                             (SELECT count(*) FROM tagged t WHERE t.fold = n.fold) AS test_rows
                      FROM (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS fold) n, last)
           SELECT * FROM bounds JOIN (SELECT fold, {metrics_sql()} FROM ok GROUP BY fold) USING (fold) LEFT JOIN judged USING (fold)""",
    ),
)
def _(t):
    def fit(df):
        return ml.fit_point(df, ["lag_7h"], "y", "linear", settled=True, regParam=0.0)

    return backtest_report(_daily_pairs(t), fit, "y", by=["zone"])["folds"]


_SCORED_SQL = with_sql(
    P_HOUR,
    f""", past AS (SELECT a.demand_mw AS y, b.demand_mw AS x FROM p_hour a JOIN p_hour b ON b.zone = a.zone
                  AND b.datetime = a.datetime - INTERVAL 24 HOUR WHERE a.datetime <= {R}),
    fit AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM past),
    {SCORING_CTES}, inputs AS ({SCORING_SELECT}),
    scored AS (SELECT zone, target_datetime, forecast_horizon_hours, a + b * demand_lag_24h AS predicted_demand_mw
               FROM inputs, fit WHERE demand_lag_24h IS NOT NULL)""",
)


def _scoring_run(t) -> dict:
    panel = pn.hourly_panel(t.events)
    past = lag_exact(panel, "zone", "datetime", "demand_mw", [24], stem="demand_lag").where(F.col("datetime") <= F.lit(REF))
    known = past.dropna(subset=["demand_lag_24h"])
    model = ml.fit_point(known, ["demand_lag_24h"], "demand_mw", "linear", regParam=0.0)
    weather = {c: F.col(c).alias(f"weather_target_{c}") for c in WEATHER_MEASURES}
    forecast = panel.select("zone", F.col("datetime").alias("target_datetime"), *weather.values())
    features = scoring_features(panel, panel, forecast, REF, REF, datetime(2024, 1, 26, 9, 0), pn.EVENT_WEIGHTS, "Total")
    return direct_run(model, features, datetime(2024, 1, 25, 9, 0), scratch(t, "scored"))


@check(
    "scoring_run",
    "zone s, target_datetime t, forecast_horizon_hours i, predicted_demand_mw d, prediction_time t, target_date date",
    _SCORED_SQL + " SELECT *, TIMESTAMP '2024-01-25 09:00:00' AS prediction_time, CAST(target_datetime AS DATE) AS target_date FROM scored",
)
def _(t):
    return _scoring_run(t)["predictions"]


@check(
    "scoring_run_by_day",
    "forecast_day i, total_predictions i, first_target t, last_target t, min_horizon i, max_horizon i, avg_demand_mw d1, max_demand_mw d1",
    _SCORED_SQL
    + """ SELECT CAST(floor((forecast_horizon_hours - 1) / 24) AS INTEGER) + 1 AS forecast_day, count(*) AS total_predictions,
             min(target_datetime) AS first_target, max(target_datetime) AS last_target, min(forecast_horizon_hours) AS min_horizon,
             max(forecast_horizon_hours) AS max_horizon, round(avg(predicted_demand_mw), 1) AS avg_demand_mw,
             round(max(predicted_demand_mw), 1) AS max_demand_mw FROM scored GROUP BY 1""",
)
def _(t):
    return _scoring_run(t)["by_day"]
