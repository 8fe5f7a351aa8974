"""Checks of dashboard queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from panelcast.catalog.base import P_PROD, P_TARGETS, check, with_sql
from panelcast.operators.modelling import contributions
from panelcast.plans import dashboards as db
from panelcast.plans import panels as pn


@check(
    "kpis",
    "total_output d2, total_capability d2, avg_utilization d",
    with_sql(
        P_PROD,
        """SELECT sum("OutputMW") AS total_output, sum("CapabilityMW") AS total_capability,
                  avg("UtilizationRate") AS avg_utilization FROM p_prod""",
    ),
)
def _(t):
    return db.kpis(pn.production_panel(t))


@check(
    "flow",
    "Zone s, FuelType s, output_mw d2",
    with_sql(P_PROD, 'SELECT "Zone", "FuelType", sum("OutputMW") AS output_mw FROM p_prod GROUP BY 1, 2'),
)
def _(t):
    return db.flow(pn.production_panel(t))


@check(
    "hourly_series",
    "hour t, output_mw d2, capability_mw d2",
    with_sql(
        P_PROD,
        """SELECT date_trunc('hour', datetime) AS hour, sum("OutputMW") AS output_mw, sum("CapabilityMW") AS capability_mw
           FROM p_prod WHERE datetime >= TIMESTAMP '1996-01-01' GROUP BY 1""",
    ),
)
def _(t):
    return db.hourly_series(pn.production_panel(t), start=datetime(1996, 1, 1))


@check(
    "heatmap",
    "Zone s, hour i, avg_utilization d",
    with_sql(
        P_PROD,
        'SELECT "Zone", hour(datetime) AS hour, avg("UtilizationRate") AS avg_utilization FROM p_prod GROUP BY 1, 2',
    ),
)
def _(t):
    return db.heatmap(pn.production_panel(t))


@check(
    "zone_lines",
    "Zone s, hour t, avg_output d, avg_utilization d",
    with_sql(
        P_PROD,
        """SELECT "Zone", date_trunc('hour', datetime) AS hour, avg("OutputMW") AS avg_output,
                  avg("UtilizationRate") AS avg_utilization FROM p_prod GROUP BY 1, 2""",
    ),
)
def _(t):
    return db.zone_lines(pn.production_panel(t))


@check(
    "detail_table",
    "Zone s, FuelType s, hour t, output_mw d2, capability_mw d2, avg_utilization d, generators i",
    with_sql(
        P_PROD,
        """SELECT "Zone", "FuelType", date_trunc('hour', datetime) AS hour, sum("OutputMW") AS output_mw,
                  sum("CapabilityMW") AS capability_mw, avg("UtilizationRate") AS avg_utilization,
                  sum("NumGenerators") AS generators FROM p_prod GROUP BY 1, 2, 3""",
    ),
)
def _(t):
    return db.detail(pn.production_panel(t))


_PICKED = {"Zone": ["ASIA", "EUROPE"], "FuelType": ["ECONOMY", "SMALL", "LARGE"]}


@check(
    "dashboard_filters",
    "Zone s, FuelType s, datetime t, OutputMW d2",
    with_sql(
        P_PROD,
        """SELECT "Zone", "FuelType", datetime, "OutputMW" FROM p_prod WHERE "Zone" IN ('ASIA', 'EUROPE')
             AND "FuelType" IN ('ECONOMY', 'SMALL', 'LARGE') AND datetime BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'""",
    ),
)
def _(t):
    return db.apply_filters(
        pn.production_panel(t), _PICKED, start=datetime(1996, 1, 1), end=datetime(1998, 12, 31)
    )


@check(
    "filter_counts",
    "Zone s, matching_rows i",
    with_sql(
        P_PROD,
        """SELECT "Zone", count(*) FILTER ("FuelType" IN ('ECONOMY', 'SMALL', 'LARGE')) AS matching_rows
           FROM p_prod GROUP BY 1""",
    ),
)
def _(t):
    return db.filter_counts(pn.production_panel(t), "Zone", _PICKED)


# a two-input linear model with fixed coefficients explains the naive forecast
COEFFICIENTS = {"prediction_mw": 0.6, "lag_168_mw": 0.3}
INTERCEPT = 12.5
CONTRIB = (
    P_TARGETS
    + """, one AS (SELECT zone, target_datetime, prediction_mw, lag_168_mw FROM p_targets),
means AS (SELECT avg(prediction_mw) AS m1, avg(lag_168_mw) AS m2 FROM one),
contrib AS (
  SELECT zone, target_datetime, 'prediction_mw' AS feature_name,
         CAST(0.6 AS DOUBLE) * (coalesce(prediction_mw, m1) - m1) AS shap_value,
         CAST(12.5 AS DOUBLE) + CAST(0.6 AS DOUBLE) * m1 + CAST(0.3 AS DOUBLE) * m2 AS base_value FROM one, means
  UNION ALL
  SELECT zone, target_datetime, 'lag_168_mw', CAST(0.3 AS DOUBLE) * (coalesce(lag_168_mw, m2) - m2),
         CAST(12.5 AS DOUBLE) + CAST(0.6 AS DOUBLE) * m1 + CAST(0.3 AS DOUBLE) * m2 FROM one, means),
predicted AS (SELECT zone, target_datetime, prediction_mw AS predicted_demand_mw FROM one)"""
)


def explained(t):
    one = pn.target_panel(t.events)
    forecast = one.select("zone", "target_datetime", F.col("prediction_mw").alias("predicted_demand_mw"))
    return forecast, contributions(one, COEFFICIENTS, INTERCEPT)


@check(
    "semantic_measures",
    "zone s, target_datetime t, predicted_demand_mw d, shap_value d, base_value d",
    with_sql(
        CONTRIB,
        """SELECT zone, target_datetime, predicted_demand_mw, shap_value, base_value FROM predicted
           LEFT JOIN (SELECT zone, target_datetime, sum(shap_value) AS shap_value, max(base_value) AS base_value
                      FROM contrib GROUP BY 1, 2) USING (zone, target_datetime)""",
    ),
)
def _(t):
    return db.semantic_measures(*explained(t))


@check(
    "combined_forecast",
    "zone s, target_datetime t, predicted_demand_mw d, feature_name s, shap_value d",
    with_sql(
        CONTRIB,
        """SELECT zone, target_datetime, predicted_demand_mw, NULL AS feature_name, NULL AS shap_value FROM predicted
           UNION ALL SELECT zone, target_datetime, NULL, feature_name, shap_value FROM contrib""",
    ),
)
def _(t):
    return db.combined_forecast(*explained(t))
