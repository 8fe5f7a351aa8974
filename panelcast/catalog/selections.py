"""Checks of feature scores and of the number of features, over every candidate column of the day-ahead table."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from panelcast.catalog.base import P_STEADY, check
from panelcast.catalog.evaluations import METRICS, metrics_sql
from panelcast.catalog.features import gold_24h_sql
from panelcast.operators import calendar as cal
from panelcast.operators.aggregate import collinear_pairs, corr_with_target
from panelcast.operators.modelling import choose_features
from panelcast.operators.splits import purged_split
from panelcast.plans import gold
from panelcast.plans import panels as pn
from panelcast.plans import selection as se
from panelcast.session import settle

Y = "target_demand_mw"
# The candidate features as the selection names them.
CANDIDATES = [
    "issue_hour_sin", "issue_hour_cos", "target_day_of_week_sin", "target_day_of_week_cos",
    "target_month_sin", "target_month_cos", "target_day_of_year_sin", "target_day_of_year_cos",
    "issue_hour", "target_day_of_week", "target_day_of_year", "target_is_weekend",
    "target_time_morning", "target_time_afternoon", "target_time_evening", "target_time_night",
    "temperature_c", "dew_point_c", "relative_humidity_pct", "wind_speed_kmh", "precipitation_mm",
    "weather_target_hdd18", "weather_target_cdd18",
    "demand_lag_1h", "demand_lag_2h", "demand_lag_3h", "demand_lag_6h",
    "demand_lag_12h", "demand_lag_24h", "demand_lag_48h", "demand_lag_168h",
    "demand_rolling_mean_6h", "demand_rolling_mean_12h", "demand_rolling_mean_24h",
    "demand_rolling_mean_168h", "demand_rolling_std_24h", "demand_rolling_std_168h",
    "is_holiday", "is_day_before_holiday", "is_day_after_holiday",
]
# The mandatory features that a day-ahead table holds.
ALWAYS = [
    "zone", "forecast_horizon_hours", "target_hour_sin", "target_hour_cos", "target_day_of_week_sin",
    "target_day_of_week_cos", "target_day_of_year_sin", "target_day_of_year_cos", "target_is_weekend",
]
#: The order in which features join: demand history, weather, time of day, calendar.
RANKED = [
    "demand_lag_24h", "demand_lag_168h", "demand_rolling_mean_24h", "demand_lag_1h", "demand_lag_48h",
    "demand_rolling_mean_168h", "demand_lag_2h", "demand_rolling_std_24h", "demand_rolling_mean_6h", "demand_lag_3h",
    "temperature_c", "weather_target_hdd18", "dew_point_c", "relative_humidity_pct", "wind_speed_kmh",
    "issue_hour_sin", "issue_hour_cos", "target_day_of_week_sin", "target_day_of_week_cos", "target_is_weekend",
    "demand_lag_6h", "demand_lag_12h", "demand_rolling_mean_12h", "demand_rolling_std_168h", "precipitation_mm",
    "weather_target_cdd18", "issue_hour", "target_day_of_week", "target_day_of_year", "target_time_morning",
    "target_time_afternoon", "target_time_evening", "target_time_night", "target_month_sin", "target_month_cos",
    "target_day_of_year_sin", "target_day_of_year_cos", "is_holiday", "is_day_before_holiday", "is_day_after_holiday",
]
COUNTS = [1, 3, 5, 10, 20, 30]
DAYS = 5
GOLD = f"g AS ({gold_24h_sql(P_STEADY)})"


def _gold(t):
    return gold.features_24h(pn.steady_panel(t.events), years=cal.year_bounds(t.events, "ts"))


def _complete_sql() -> str:
    return f"WITH {GOLD}, c AS (SELECT * FROM g WHERE " + " AND ".join(f"{f} IS NOT NULL" for f in [*CANDIDATES, Y]) + ")"


def _corr(a: str, b: str) -> str:
    return f"abs(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)))"


def _known(value: str) -> str:
    return f"CASE WHEN isnan({value}) THEN NULL ELSE {value} END"


@check(
    "feature_correlations",
    "feature s, correlation d, is_low i",
    _complete_sql()
    + ", one AS (SELECT "
    + ", ".join(f"{_corr(f, Y)} AS {f}" for f in CANDIDATES)
    + " FROM c), long AS ("
    + " UNION ALL ".join(f"SELECT '{f}' AS feature, {_known(f)} AS correlation FROM one" for f in CANDIDATES)
    + ") SELECT feature, correlation, CASE WHEN correlation IS NOT NULL THEN CAST(correlation < 0.05 AS INTEGER) END AS is_low FROM long",
)
def _(t):
    return corr_with_target(_gold(t), CANDIDATES, Y)


@check(
    "collinear_features",
    "feature_1 s, feature_2 s, correlation d",
    _complete_sql()
    + ", one AS (SELECT "
    + ", ".join(f"{_corr(a, b)} AS p{i}" for i, (a, b) in enumerate(combinations(CANDIDATES, 2)))
    + " FROM c), long AS ("
    + " UNION ALL ".join(f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, p{i} AS correlation FROM one" for i, (a, b) in enumerate(combinations(CANDIDATES, 2)))
    + ") SELECT * FROM long WHERE NOT isnan(correlation) AND correlation > 0.9",
)
def _(t):
    return collinear_pairs(_gold(t).filter(F.col(Y).isNotNull()), CANDIDATES)


@check("feature_scores", "feature s, correlation d, importance d, corr_rank d, imp_rank d, avg_rank d")
def _(t):
    return se.score_features(_gold(t))


@check("selected_features", "feature s, feature_group s, correlation d, importance d, avg_rank d")
def _(t):
    return se.selected_features(_gold(t))


# --- the number of features ------------------------------------------------------------------


def _order() -> list[str]:
    return [*ALWAYS, *[f for f in RANKED if f not in ALWAYS]]


def _sizes() -> dict[int, int]:
    return {n: len(set(RANKED[:n]) | set(ALWAYS)) for n in [*COUNTS, len(RANKED)]}


def _steps_sql() -> str:
    """Each feature in turn is taken out of the later ones and of the target, by least squares on the training rows.

    What is then left of the target is the error of the model of the features so far.
    """
    order = _order()
    split = f"""b AS (SELECT max(issue_datetime) AS e FROM g),
    parts AS (SELECT g.*, CASE
        WHEN issue_datetime < e - INTERVAL {2 * DAYS} DAY AND target_datetime <= e - INTERVAL {2 * DAYS} DAY - INTERVAL 1 HOUR THEN 1
        WHEN issue_datetime >= e - INTERVAL {2 * DAYS} DAY AND issue_datetime < e - INTERVAL {DAYS} DAY
             AND target_datetime <= e - INTERVAL {DAYS} DAY - INTERVAL 1 HOUR THEN 0 END AS train
        FROM g, b),
    typed AS (SELECT train, {Y} AS y0, {Y} AS y, {', '.join(
        (f"CAST(dense_rank() OVER (ORDER BY {f}) - 1 AS DOUBLE) AS {f}" if f == 'zone' else f"CAST({f} AS DOUBLE) AS {f}") for f in order)}
        FROM parts WHERE train IS NOT NULL AND {Y} IS NOT NULL),
    m AS (SELECT avg(y) AS y, {', '.join(f'coalesce(avg({f}), 0) AS {f}' for f in order)} FROM typed WHERE train = 1),
    f0 AS MATERIALIZED (SELECT train, y0, t.y - m.y AS y, {', '.join(f'coalesce(t.{f} - m.{f}, 0) AS {f}' for f in order)} FROM typed t, m),
    v AS (SELECT {', '.join(f'sum({f} * {f}) AS {f}' for f in order)} FROM f0 WHERE train = 1)"""
    steps, errors = [split], {n: [] for n in _sizes()}
    for k, f in enumerate(order):
        later = order[k + 1 :]
        part = "SELECT sum({0} * {0}) AS own, sum(y * {0}) AS y{1} FROM f{2} WHERE train = 1".format(
            f, "".join(f", sum({x} * {f}) AS {x}" for x in later), k
        )
        share = f"CASE WHEN s.own > 1e-6 * v.{f} THEN f.{f} / s.own ELSE 0 END"
        steps.append(f"s{k} AS MATERIALIZED ({part})")
        rest = "".join(f", f.{x} - s.{x} * {share} AS {x}" for x in later)
        steps.append(f"f{k + 1} AS MATERIALIZED (SELECT train, y0, f.y - s.y * {share} AS y{rest} FROM f{k} f, s{k} s, v)")
    for n, size in _sizes().items():
        errors[n] = f"SELECT {n} AS requested_feature_count, {size} AS actual_feature_count, y0 AS y, y0 - y AS p FROM f{size} WHERE train = 0"
    return f"WITH {GOLD}, " + ", ".join(steps) + f""", scored AS ({' UNION ALL '.join(errors.values())}),
        results AS (SELECT requested_feature_count, actual_feature_count, {metrics_sql()} FROM scored GROUP BY 1, 2)"""


def _counted(t):
    split = settle(purged_split(_gold(t), days=DAYS))
    train, validation = (split.filter(F.col("split") == name) for name in ("train", "validation"))
    available = [c for c in gold.FEATURES_24H if c not in ("zone",)]
    return se.compare_feature_counts(train, validation, RANKED, COUNTS, Y, ["zone", "forecast_horizon_hours", *available])


@check(
    "feature_count_results",
    f"requested_feature_count i, actual_feature_count i, {METRICS}",
    _steps_sql() + " SELECT * FROM results",
)
def _(t):
    return _counted(t)


@check(
    "choose_features",
    f"requested_feature_count i, actual_feature_count i, {METRICS}",
    _steps_sql()
    + """ SELECT * FROM results WHERE wape <= (SELECT min(wape) FROM results) + CAST(0.05 AS DOUBLE)
        ORDER BY actual_feature_count, wape, mae LIMIT 1""",
)
def _(t):
    return choose_features(_counted(t))
