"""Checks of deduplication, validity flags and data-quality reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from panelcast.catalog.base import (
    P_DUP,
    P_FORECAST,
    P_HOUR,
    P_INTERVAL,
    P_TOTALS,
    P_WIDE,
    check,
    with_sql,
)
from panelcast.operators import quality as q
from panelcast.operators.blocks import HOUR
from panelcast.plans import panels as pn


@check(
    "dedup_first",
    "zone s, datetime t, demand_mw d, seq i",
    with_sql(
        P_DUP,
        """SELECT zone, datetime, demand_mw, seq FROM p_dup
           QUALIFY row_number() OVER (PARTITION BY zone, datetime ORDER BY seq) = 1""",
    ),
)
def _(t):
    return q.dedup_ordered(pn.repeated_panel(t.events), ["zone", "datetime"], ["seq"], "first")


@check(
    "dedup_last",
    "zone s, datetime t, demand_mw d, seq i",
    with_sql(
        P_DUP,
        """SELECT zone, datetime, demand_mw, seq FROM p_dup
           QUALIFY row_number() OVER (PARTITION BY zone, datetime ORDER BY seq DESC) = 1""",
    ),
)
def _(t):
    return q.dedup_ordered(pn.repeated_panel(t.events), ["zone", "datetime"], ["seq"], "last")


@check(
    "dedup_any",
    "zone s, datetime t, demand_mw d",
    with_sql(P_DUP, "SELECT zone, datetime, min(demand_mw) AS demand_mw FROM p_dup GROUP BY zone, datetime"),
)
def _(t):
    return q.dedup_any(pn.repeated_panel(t.events), ["zone", "datetime"])


@check(
    "coalesce_duplicates",
    "zone s, datetime t, demand_mw d, temperature_c d, seq i",
    with_sql(
        P_DUP,
        """SELECT zone, datetime, arg_min(d, seq) FILTER (d IS NOT NULL) AS demand_mw,
                  arg_min(temperature_c, seq) FILTER (temperature_c IS NOT NULL) AS temperature_c, min(seq) AS seq
           FROM (SELECT *, CASE WHEN seq = 1 AND hour(datetime) % 10 = 0 THEN NULL ELSE demand_mw END AS d FROM p_dup)
           GROUP BY zone, datetime""",
    ),
)
def _(t):
    hole = (F.col("seq") == 1) & (F.hour("datetime") % 10 == 0)
    rows = pn.repeated_panel(t.events).withColumn("demand_mw", F.when(~hole, F.col("demand_mw")))
    return q.coalesce_duplicates(rows, ["zone", "datetime"], "seq")


@check(
    "duplicate_keys",
    "zone s, datetime t, count i",
    with_sql(P_DUP, 'SELECT zone, datetime, count(*) AS "count" FROM p_dup GROUP BY 1, 2 HAVING count(*) > 1'),
)
def _(t):
    return q.duplicate_keys(pn.repeated_panel(t.events), ["zone", "datetime"])


@check(
    "gaps",
    "zone s, datetime t, hours_since_previous d, is_gap i",
    with_sql(
        P_HOUR,
        """SELECT zone, datetime, h AS hours_since_previous, CASE WHEN h <> 1 THEN 1 ELSE 0 END AS is_gap
           FROM (SELECT zone, datetime, date_diff('second', lag(datetime) OVER (PARTITION BY zone ORDER BY datetime),
                        datetime) / 3600 AS h FROM p_hour)""",
    ),
)
def _(t):
    return q.gaps(pn.hourly_panel(t.events), "zone", "datetime", HOUR)


@check(
    "gap_count",
    "zone s, rows i, gap_count i",
    with_sql(
        P_HOUR,
        """SELECT zone, count(*) AS rows, count(*) FILTER (h <> 1) AS gap_count
           FROM (SELECT zone, date_diff('second', lag(datetime) OVER (PARTITION BY zone ORDER BY datetime),
                        datetime) / 3600 AS h FROM p_hour) GROUP BY zone""",
    ),
)
def _(t):
    return q.gap_count(pn.hourly_panel(t.events), "zone", "datetime")


@check(
    "validity_flags",
    "zone s, issue_datetime t, forecast_horizon_hours i, has_valid_features i, has_valid_target i, is_training_row i",
    with_sql(
        P_FORECAST,
        """SELECT zone, issue_datetime, forecast_horizon_hours,
                  CAST(prediction_mw IS NOT NULL AND lag_168_mw IS NOT NULL AS INTEGER) AS has_valid_features,
                  CAST(target_demand_mw > 100 AS INTEGER) AS has_valid_target,
                  CAST(prediction_mw IS NOT NULL AND lag_168_mw IS NOT NULL AND target_demand_mw > 100 AS INTEGER)
                    AS is_training_row FROM p_forecast""",
    ),
)
def _(t):
    rows = pn.forecast_panel(t.events)
    rows = rows.withColumn("target_demand_mw", F.when(F.col("target_demand_mw") > 100, F.col("target_demand_mw")))
    return q.validity_flags(rows, ["prediction_mw", "lag_168_mw"], "target_demand_mw")


@check(
    "overlap_report",
    "zone s, left_rows i, left_first t, left_last t, right_rows i, right_first t, right_last t, is_shared i",
    """WITH a AS (SELECT event_type AS zone, count(*) AS n, min(ts) AS f, max(ts) AS l FROM events
                  WHERE event_type <> 'click' GROUP BY 1),
            b AS (SELECT event_type AS zone, count(*) AS n, min(ts) AS f, max(ts) AS l FROM events
                  WHERE event_type <> 'view' GROUP BY 1)
       SELECT coalesce(a.zone, b.zone) AS zone, a.n AS left_rows, a.f AS left_first, a.l AS left_last,
              b.n AS right_rows, b.f AS right_first, b.l AS right_last,
              CASE WHEN a.n IS NOT NULL AND b.n IS NOT NULL THEN 1 ELSE 0 END AS is_shared
       FROM a FULL JOIN b ON a.zone = b.zone""",
)
def _(t):
    rows = t.events.select(F.col("event_type").alias("zone"), "ts")
    return q.overlap_report(rows.filter("zone <> 'click'"), rows.filter("zone <> 'view'"), "zone", "ts")


@check(
    "zone_diff",
    "zone s, missing_from s",
    """SELECT zone, missing_from FROM (
         SELECT event_type AS zone, 'right' AS missing_from FROM events WHERE event_type <> 'view'
         EXCEPT SELECT event_type, 'right' FROM events WHERE event_type <> 'click')
       UNION ALL
       SELECT zone, missing_from FROM (
         SELECT event_type AS zone, 'left' AS missing_from FROM events WHERE event_type <> 'click'
         EXCEPT SELECT event_type, 'left' FROM events WHERE event_type <> 'view')""",
)
def _(t):
    rows = t.events.select(F.col("event_type").alias("zone"))
    return q.zone_diff(rows.filter("zone <> 'view'"), rows.filter("zone <> 'click'"))


@check(
    "history_depth",
    "zone s, row_count i, first_datetime t, last_datetime t, missing_demand i, available_hours d, is_short i",
    with_sql(
        P_HOUR,
        """SELECT zone, count(*) AS row_count, min(datetime) AS first_datetime, max(datetime) AS last_datetime,
                  count(*) FILTER (temperature_c IS NULL) AS missing_demand,
                  date_diff('second', min(datetime), max(datetime)) / 3600 + 1 AS available_hours,
                  CASE WHEN date_diff('second', min(datetime), max(datetime)) / 3600 + 1 < 720 THEN 1 ELSE 0 END AS is_short
           FROM p_hour GROUP BY zone""",
    ),
)
def _(t):
    return q.history_depth(pn.hourly_panel(t.events), "zone", "datetime", "temperature_c", need=720)


_COMPLETE = """, kept AS (SELECT * FROM p_totals WHERE prediction_mw IS NOT NULL),
span AS (SELECT issue_datetime, zone, count(DISTINCT forecast_horizon_hours) AS n,
                min(forecast_horizon_hours) AS lo, max(forecast_horizon_hours) AS hi FROM kept GROUP BY 1, 2)"""


@check(
    "complete_horizons",
    "zone s, issue_datetime t, forecast_horizon_hours i, target_demand_mw d",
    with_sql(
        P_TOTALS + _COMPLETE,
        """SELECT zone, issue_datetime, forecast_horizon_hours, target_demand_mw FROM kept
           WHERE (issue_datetime, zone) IN (SELECT (issue_datetime, zone) FROM span WHERE n = 168 AND lo = 1 AND hi = 168)""",
    ),
)
def _(t):
    return q.complete_horizons(pn.totals_with_zones(pn.forecast_panel(t.events)).dropna(subset=["prediction_mw"]), 1, 168)


@check(
    "coverage_rate",
    "issues i, complete_issues i, coverage_rate d",
    with_sql(
        P_TOTALS + _COMPLETE,
        """SELECT count(*) AS issues, sum(c) AS complete_issues, avg(c) AS coverage_rate
           FROM (SELECT CASE WHEN n = 168 AND lo = 1 AND hi = 168 THEN 1 ELSE 0 END AS c FROM span)""",
    ),
)
def _(t):
    return q.coverage_rate(pn.totals_with_zones(pn.forecast_panel(t.events)).dropna(subset=["prediction_mw"]), 1, 168)


_BOUNDS = {"temperature_c": (-10.0, 25.0), "relative_humidity_pct": (0.0, 70.0), "wind_speed_kmh": (0.0, 150.0)}


@check(
    "quality_report",
    "column_name s, missing_values i, outliers i, total_rows i, all_valid i",
    with_sql(
        P_HOUR,
        """, parts AS ("""
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing_values,
                count(*) FILTER ({c} < {lo} OR {c} > {hi}) AS outliers, count(*) AS total_rows FROM p_hour"""
            for c, (lo, hi) in _BOUNDS.items()
        )
        + """) SELECT *, (SELECT CASE WHEN sum(missing_values + outliers) = 0 THEN 1 ELSE 0 END FROM parts) AS all_valid
               FROM parts""",
    ),
)
def _(t):
    return q.quality_report(pn.hourly_panel(t.events), list(_BOUNDS), _BOUNDS)


@check(
    "check_bounds",
    "rows i, bad_hours i, bad_intervals i",
    with_sql(
        P_INTERVAL,
        """SELECT count(*) AS rows, count(*) FILTER (hour + 1 NOT BETWEEN 1 AND 24) AS bad_hours,
                  count(*) FILTER ("interval" NOT BETWEEN 1 AND 12) AS bad_intervals FROM p_interval""",
    ),
)
def _(t):
    shifted = pn.interval_panel(t.events).withColumn("hour", F.col("hour") + 1)
    return q.check_bounds(shifted)


@check(
    "feed_delay",
    "latest t, delay_minutes d, is_late i",
    """SELECT max(ts) AS latest, (epoch(TIMESTAMP '2024-01-31 02:00:00') - floor(epoch(max(ts)))) / 60 AS delay_minutes,
              CASE WHEN (epoch(TIMESTAMP '2024-01-31 02:00:00') - floor(epoch(max(ts)))) / 60 > 180 THEN 1 ELSE 0 END
                AS is_late FROM events""",
)
def _(t):
    return q.feed_delay(t.events, "ts", datetime(2024, 1, 31, 2, 0))


@check(
    "layer_summary",
    "total_rows i, zones i, min_issue_datetime t, max_issue_datetime t, min_target_datetime t, max_target_datetime t, sum_has_valid_target i, avg_target_demand_mw d",
    with_sql(
        P_FORECAST,
        """SELECT count(*) AS total_rows, count(DISTINCT zone) AS zones, min(issue_datetime) AS min_issue_datetime,
                  max(issue_datetime) AS max_issue_datetime, min(target_datetime) AS min_target_datetime,
                  max(target_datetime) AS max_target_datetime,
                  count(*) FILTER (prediction_mw IS NOT NULL) AS sum_has_valid_target,
                  avg(target_demand_mw) AS avg_target_demand_mw FROM p_forecast""",
    ),
)
def _(t):
    rows = pn.forecast_panel(t.events)
    rows = rows.withColumn("has_valid_target", F.col("prediction_mw").isNotNull().cast("int"))
    return q.layer_summary(
        rows, "zone", ["issue_datetime", "target_datetime"], ["has_valid_target"], ["target_demand_mw"]
    )


@check(
    "zone_summary",
    "zone s, observations i, first_obs t, last_obs t, avg_humidity d, missing_temperature_c_pct d",
    with_sql(
        P_HOUR,
        """SELECT zone, count(*) AS observations, min(datetime) AS first_obs, max(datetime) AS last_obs,
                  round(avg(relative_humidity_pct), 2) AS avg_humidity,
                  round(100 * avg(CASE WHEN temperature_c IS NULL THEN 1.0 ELSE 0.0 END), 3) AS missing_temperature_c_pct
           FROM p_hour GROUP BY zone""",
    ),
)
def _(t):
    return q.zone_summary(
        pn.hourly_panel(t.events),
        "zone",
        {"relative_humidity_pct": "avg_humidity"},
        ts="datetime",
        missing=["temperature_c"],
    )


@check(
    "horizon_coverage",
    "forecast_horizon_hours i, rows i, rows_with_target i, mean_target d",
    with_sql(
        P_FORECAST,
        """SELECT forecast_horizon_hours, count(*) AS rows, count(prediction_mw) AS rows_with_target,
                  avg(prediction_mw) AS mean_target FROM p_forecast GROUP BY 1""",
    ),
)
def _(t):
    return q.horizon_coverage(pn.forecast_panel(t.events), "prediction_mw")


@check(
    "feature_coverage",
    "feature s, known_rows i",
    with_sql(
        P_WIDE,
        """SELECT feature, known_rows FROM (
             SELECT 'click' AS feature, count(click) AS known_rows FROM p_wide
             UNION ALL SELECT 'view', count("view") FROM p_wide)""",
    ),
)
def _(t):
    wide = pn.wide_panel(t.events)
    have = q.feature_coverage(wide.columns, ["click", "view", "absent"])["present"]
    return wide.agg(*[F.count(c).alias(c) for c in have]).unpivot([], have, "feature", "known_rows")
