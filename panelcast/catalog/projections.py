"""Checks of projections, filters, reshaping and time scalars."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from panelcast.catalog.base import P_FORECAST, P_HOUR, P_INTERVAL, P_WIDE, ZONE_NAMES, check, with_sql
from panelcast.functions import timecols as tc
from panelcast.operators import projection as pr
from panelcast.plans import panels as pn

NOW = datetime(2024, 1, 20, 0, 0)
NOW_SQL = "TIMESTAMP '2024-01-20 00:00:00'"


@check(
    "coerce_numeric",
    "o_orderkey i, as_number d, from_text d",
    """SELECT o_orderkey, TRY_CAST(regexp_replace(o_orderpriority, '-.*', '') AS DOUBLE) AS as_number,
              TRY_CAST(o_orderpriority AS DOUBLE) AS from_text FROM orders""",
)
def _(t):
    rows = t.orders.select(
        "o_orderkey",
        F.regexp_replace("o_orderpriority", "-.*", "").alias("as_number"),
        F.col("o_orderpriority").alias("from_text"),
    )
    return pr.coerce_numeric(rows, ["as_number", "from_text"])


@check(
    "require_non_null",
    "zone s, datetime t, temperature_c d",
    with_sql(P_HOUR, "SELECT zone, datetime, temperature_c FROM p_hour WHERE temperature_c IS NOT NULL"),
)
def _(t):
    return pr.require_non_null(pn.hourly_panel(t.events), ["zone", "datetime", "temperature_c"])


@check(
    "exclude_aggregates",
    "zone s, rows i",
    with_sql(
        P_WIDE,
        """SELECT zone, count(*) AS rows FROM (
             UNPIVOT (SELECT * FROM p_wide) ON COLUMNS(* EXCLUDE datetime) INTO NAME zone VALUE demand_mw)
           WHERE NOT regexp_matches(zone, '^(diff|total|zone.?total|market)$', 'i') GROUP BY zone""",
    ),
)
def _(t):
    wide = pn.wide_panel(t.events)
    long = pr.unpivot_zones(wide, ["datetime"], [c for c in wide.columns if c != "datetime"])
    kept = pr.exclude_aggregates(long.dropna(subset=["demand_mw"]))
    return kept.groupBy("zone").agg(F.count(F.lit(1)).alias("rows"))


@check(
    "select_ordered",
    "datetime t, zone s, demand_mw d",
    with_sql(P_HOUR, "SELECT datetime, zone, demand_mw FROM p_hour"),
)
def _(t):
    return pr.select_ordered(pn.hourly_panel(t.events), ["datetime", "zone", "datetime", "demand_mw", "zone"])


@check(
    "unpivot_zones",
    "datetime t, zone s, demand_mw d",
    with_sql(
        P_WIDE,
        "UNPIVOT (SELECT datetime, "
        + ", ".join(f'"{n}"' for n in ZONE_NAMES)
        + " FROM p_wide) ON COLUMNS(* EXCLUDE datetime) INTO NAME zone VALUE demand_mw",
    ),
)
def _(t):
    wide = pn.wide_panel(t.events)
    return pr.unpivot_zones(wide, ["datetime"], ZONE_NAMES).dropna(subset=["demand_mw"])


@check(
    "map_labels",
    "zone s, datetime t, demand_mw d",
    with_sql(
        P_HOUR,
        """SELECT CASE trim(zone) WHEN 'click' THEN 'Toronto' WHEN 'view' THEN 'Ottawa' ELSE trim(zone) END AS zone,
                  datetime, demand_mw FROM p_hour""",
    ),
)
def _(t):
    padded = pn.hourly_panel(t.events).withColumn("zone", F.concat(F.lit(" "), "zone", F.lit("  ")))
    return pr.map_labels(padded, "zone", {"click": "Toronto", "view": "Ottawa"})


_LONG = (
    "UNPIVOT (SELECT datetime, "
    + ", ".join(f'"{n}"' for n in [*ZONE_NAMES, "Ontario Demand"])
    + " FROM p_wide) ON COLUMNS(* EXCLUDE datetime) INTO NAME zone VALUE demand_mw"
)


@check(
    "split_zonal_table",
    "datetime t, zone s, demand_mw d",
    with_sql(
        P_WIDE,
        f"SELECT datetime, CASE zone WHEN 'Ontario Demand' THEN 'Ontario' ELSE zone END AS zone, demand_mw FROM ({_LONG})",
    ),
)
def _(t):
    return pr.split_global_zonal(pn.wide_panel(t.events))[1]


@check(
    "split_total_table",
    "datetime t, market_demand d, ontario_demand d",
    with_sql(
        P_WIDE,
        'SELECT datetime, "Market Demand" AS market_demand, "Ontario Demand" AS ontario_demand FROM p_wide',
    ),
)
def _(t):
    return pr.split_global_zonal(pn.wide_panel(t.events))[0]


@check(
    "rename_columns",
    "zone s, weather_target_temperature_c d, weather_target_wind_speed_kmh d",
    with_sql(
        P_HOUR,
        """SELECT zone, temperature_c AS weather_target_temperature_c,
                  wind_speed_kmh AS weather_target_wind_speed_kmh FROM p_hour""",
    ),
)
def _(t):
    raw = pn.hourly_panel(t.events).select(
        "zone",
        F.col("temperature_c").alias("weather_target_temperature_2m"),
        F.col("wind_speed_kmh").alias("weather_target_wind_speed_10m"),
    )
    return pr.rename(raw, pr.FORECAST_NAMES)


@check(
    "recent_rows",
    "zone s, datetime t, demand_mw d",
    with_sql(P_HOUR, "SELECT zone, datetime, demand_mw FROM p_hour WHERE datetime >= DATE '2024-01-30' - 7"),
)
def _(t):
    from datetime import date

    return pr.recent(pn.hourly_panel(t.events), "datetime", 7, date(2024, 1, 30))


@check(
    "in_window",
    "zone s, datetime t, demand_mw d",
    with_sql(
        P_HOUR,
        f"""SELECT zone, datetime, demand_mw FROM p_hour
            WHERE datetime >= {NOW_SQL} AND datetime < {NOW_SQL} + INTERVAL 25 HOUR""",
    ),
)
def _(t):
    return pr.in_window(pn.hourly_panel(t.events), "datetime", NOW, datetime(2024, 1, 21, 1, 0))


@check(
    "incremental_window",
    "zone s, datetime t, demand_mw d",
    with_sql(
        P_HOUR,
        f"""SELECT zone, datetime, demand_mw FROM p_hour
            WHERE datetime BETWEEN {NOW_SQL} - INTERVAL 7 DAY AND {NOW_SQL}""",
    ),
)
def _(t):
    return pr.incremental_window(pn.hourly_panel(t.events), "datetime", NOW)


@check(
    "backfill_window",
    "zone s, datetime t, demand_mw d",
    with_sql(P_HOUR, f"SELECT zone, datetime, demand_mw FROM p_hour WHERE datetime <= {NOW_SQL}"),
)
def _(t):
    return pr.incremental_window(pn.hourly_panel(t.events), "datetime", NOW, backfill=True)


@check(
    "stitch_history_forecast",
    "zone s, datetime t, demand_mw d, origin s",
    with_sql(
        P_HOUR,
        f"""SELECT zone, datetime, demand_mw, 'archive' AS origin FROM p_hour
            WHERE datetime >= TIMESTAMP '2024-01-05' AND datetime < {NOW_SQL}
            UNION ALL
            SELECT zone, datetime, demand_mw * 2, 'forecast' FROM p_hour
            WHERE datetime >= {NOW_SQL} AND datetime <= TIMESTAMP '2024-01-28'""",
    ),
)
def _(t):
    panel = pn.hourly_panel(t.events).select("zone", "datetime", "demand_mw")
    history = panel.withColumn("origin", F.lit("archive"))
    ahead = panel.withColumns({"demand_mw": F.col("demand_mw") * 2, "origin": F.lit("forecast")})
    return pr.stitch_history_forecast(
        history, ahead, "datetime", NOW, datetime(2024, 1, 5), datetime(2024, 1, 28)
    )


@check(
    "valid_horizon",
    "zone s, issue_datetime t, target_datetime t, forecast_horizon_hours i",
    with_sql(
        P_FORECAST,
        """SELECT zone, issue_datetime, target_datetime, stated AS forecast_horizon_hours FROM (
             SELECT *, CASE WHEN hour(target_datetime) % 7 = 0 THEN forecast_horizon_hours + 1
                            ELSE forecast_horizon_hours END AS stated FROM p_forecast)
           WHERE stated BETWEEN 1 AND 24
             AND date_diff('second', issue_datetime, target_datetime) = stated * 3600""",
    ),
)
def _(t):
    bent = F.when(F.hour("target_datetime") % 7 == 0, F.col("forecast_horizon_hours") + 1)
    rows = pn.forecast_panel(t.events).withColumn(
        "forecast_horizon_hours", F.coalesce(bent, F.col("forecast_horizon_hours"))
    )
    return pr.valid_horizon(rows, 1, 24)


@check(
    "freshness_gate",
    "last_ingestion t, age_hours d, is_fresh i",
    """SELECT max(ts) AS last_ingestion,
              (epoch(TIMESTAMP '2024-01-31 01:00:00') - floor(epoch(max(ts)))) / 3600 AS age_hours,
              CASE WHEN (epoch(TIMESTAMP '2024-01-31 01:00:00') - floor(epoch(max(ts)))) / 3600 < 4
                   THEN 1 ELSE 0 END AS is_fresh FROM events""",
)
def _(t):
    return pr.is_fresh(t.events, "ts", datetime(2024, 1, 31, 1, 0))


@check(
    "training_view",
    "zone s, issue_datetime t, forecast_horizon_hours i",
    with_sql(
        P_FORECAST,
        "SELECT zone, issue_datetime, forecast_horizon_hours FROM p_forecast WHERE prediction_mw IS NOT NULL",
    ),
)
def _(t):
    rows = pn.forecast_panel(t.events)
    return pr.training_view(rows.withColumn("is_training_row", F.col("prediction_mw").isNotNull().cast("int")))


@check(
    "hour_and_interval_times",
    "zone s, hour i, interval i, timestamp_hour t, timestamp_5min t",
    with_sql(
        P_INTERVAL,
        """SELECT zone, hour, "interval", CAST(date AS TIMESTAMP) + to_hours(CAST(hour - 1 AS BIGINT)) AS timestamp_hour,
                  CAST(date AS TIMESTAMP) + to_hours(CAST(hour - 1 AS BIGINT))
                    + to_minutes(CAST(5 * "interval" AS BIGINT)) AS timestamp_5min
           FROM p_interval""",
    ),
)
def _(t):
    rows = pn.interval_panel(t.events).withColumn("timestamp_hour", tc.hour_start("date", "hour"))
    return rows.withColumn("timestamp_5min", tc.interval_end("timestamp_hour", "interval"))


# Toronto changes its clock on 10 March 2024 at 07:00 UTC and on 3 November 2024 at 06:00 UTC
_MOVED = """moved AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-03-10 00:00:00' ELSE TIMESTAMP '2024-11-03 00:00:00' END
       + (ts - date_trunc('day', ts)) AS utc, minute(ts) AS m FROM events)"""


@check(
    "local_and_utc_times",
    "event_id i, local t, back t, back_early t, skipped t",
    f"""WITH {_MOVED}
        SELECT event_id,
               utc - CASE WHEN utc < TIMESTAMP '2024-03-10 07:00:00' OR utc >= TIMESTAMP '2024-11-03 06:00:00'
                          THEN INTERVAL 5 HOUR ELSE INTERVAL 4 HOUR END AS local,
               CASE WHEN utc >= TIMESTAMP '2024-11-03 05:00:00' AND utc < TIMESTAMP '2024-11-03 06:00:00'
                    THEN utc + INTERVAL 1 HOUR ELSE utc END AS back,
               CASE WHEN utc >= TIMESTAMP '2024-11-03 06:00:00' AND utc < TIMESTAMP '2024-11-03 07:00:00'
                    THEN utc - INTERVAL 1 HOUR ELSE utc END AS back_early,
               TIMESTAMP '2024-03-10 07:00:00' AS skipped FROM moved""",
)
def _(t):
    # the events of a month, moved to the two days on which the clock changes
    zone, day = "America/Toronto", 24 * 3600 * 1_000_000
    start = F.when(F.col("event_id") % 2 == 0, F.lit(datetime(2024, 3, 10))).otherwise(F.lit(datetime(2024, 11, 3)))
    moved = F.timestamp_micros(F.unix_micros(start) + F.pmod(F.unix_micros("ts"), F.lit(day)))
    utc = t.events.withColumn("ts", F.col("ts").cast("timestamp")).select("event_id", moved.alias("utc"), F.minute("ts").alias("m"))
    local = utc.withColumn("local", tc.to_local("utc", zone))
    gap = F.timestamp_add("MINUTE", F.col("m"), F.lit(datetime(2024, 3, 10, 2)))
    return local.select(
        "event_id",
        "local",
        tc.to_utc("local", zone).alias("back"),
        tc.to_utc("local", zone, "daylight").alias("back_early"),
        tc.to_utc(gap, zone).alias("skipped"),
    )


@check(
    "date_parts",
    "o_orderkey i, date date, year i, month i, day i, hour i, day_of_week i, day_of_year i, is_weekend i, week_of_year i",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, year(o_orderdate) AS year, month(o_orderdate) AS month,
              day(o_orderdate) AS day, hour(o_orderdate) AS hour, isodow(o_orderdate) - 1 AS day_of_week,
              dayofyear(o_orderdate) AS day_of_year,
              CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS is_weekend,
              weekofyear(o_orderdate) AS week_of_year FROM orders""",
)
def _(t):
    return t.orders.select("o_orderkey", "o_orderdate").withColumns(tc.date_parts("o_orderdate", week=True))


@check(
    "sunday_week_and_business_hours",
    "event_id i, dow i, weekend i, business i",
    """SELECT event_id, dayofweek(ts) AS dow, CASE WHEN dayofweek(ts) >= 5 THEN 1 ELSE 0 END AS weekend,
              CASE WHEN hour(ts) BETWEEN 8 AND 18 THEN 1 ELSE 0 END AS business FROM events""",
)
def _(t):
    return t.events.select(
        "event_id",
        tc.dow_sunday0("ts").alias("dow"),
        tc.weekend_flag(tc.dow_sunday0("ts")).alias("weekend"),
        tc.is_business_hours("ts").alias("business"),
    )


@check(
    "day_parts",
    "event_id i, time_morning i, time_afternoon i, time_evening i, time_night i",
    """SELECT event_id, CASE WHEN h BETWEEN 6 AND 11 THEN 1 ELSE 0 END AS time_morning,
              CASE WHEN h BETWEEN 12 AND 17 THEN 1 ELSE 0 END AS time_afternoon,
              CASE WHEN h BETWEEN 18 AND 21 THEN 1 ELSE 0 END AS time_evening,
              CASE WHEN h < 6 OR h >= 22 THEN 1 ELSE 0 END AS time_night
       FROM (SELECT event_id, hour(ts) AS h FROM events)""",
)
def _(t):
    return t.events.select("event_id", "ts").withColumns(tc.day_parts(F.hour("ts")))


def _cycle(expr: str, period: str, name: str) -> str:
    angle = f"2 * pi() * ({expr}) / CAST({period} AS DOUBLE)"
    return f"sin({angle}) AS {name}_sin, cos({angle}) AS {name}_cos"


@check(
    "cyclic_encoding",
    "event_id i, hour_sin d, hour_cos d, dow_sin d, dow_cos d, month_sin d, month_cos d, doy_sin d, doy_cos d",
    "SELECT event_id, "
    + ", ".join(
        [
            _cycle("hour(ts)", "24", "hour"),
            _cycle("isodow(ts) - 1", "7", "dow"),
            _cycle("month(ts) - 1", "12", "month"),
            _cycle("dayofyear(ts) - 1", "365.25", "doy"),
        ]
    )
    + " FROM events",
)
def _(t):
    return t.events.select("event_id", "ts").withColumns(
        {
            **tc.cyclic(F.hour("ts"), 24, "hour"),
            **tc.cyclic(tc.dow_monday0("ts"), 7, "dow"),
            **tc.cyclic(F.month("ts"), 12, "month", offset=1),
            **tc.cyclic(F.dayofyear("ts"), 365.25, "doy", offset=1),
        }
    )


@check(
    "cyclic_encoding_unshifted",
    "o_orderkey i, month_sin d, month_cos d, doy_sin d, doy_cos d",
    "SELECT o_orderkey, "
    + _cycle("month(o_orderdate)", "12", "month")
    + ", "
    + _cycle("dayofyear(o_orderdate)", "365.25", "doy")
    + " FROM orders",
)
def _(t):
    return t.orders.select("o_orderkey", "o_orderdate").withColumns(
        {
            **tc.cyclic(F.month("o_orderdate"), 12, "month"),
            **tc.cyclic(F.dayofyear("o_orderdate"), 365.25, "doy"),
        }
    )


@check(
    "target_time_and_horizon",
    "event_id i, target t, horizon i, age d",
    """SELECT event_id, ts + to_hours(CAST(1 + event_id % 168 AS BIGINT)) AS target, 1 + event_id % 168 AS horizon,
              (epoch(TIMESTAMP '2024-02-01') - floor(epoch(ts))) / 60 AS age FROM events""",
)
def _(t):
    rows = t.events.select("event_id", "ts", (F.col("event_id") % 168 + 1).cast("int").alias("h"))
    rows = rows.withColumn("target", tc.add_hours("ts", "h"))
    return rows.withColumns(
        {
            "horizon": tc.horizon_hours("ts", "target"),
            "age": tc.age_minutes("ts", F.lit(datetime(2024, 2, 1))),
        }
    )


@check(
    "forecast_anchor",
    "event_id i, prediction_start t, prediction_end t",
    """SELECT event_id, date_trunc('day', ts - INTERVAL 8 HOUR) + INTERVAL 8 HOUR AS prediction_start,
              date_trunc('day', ts - INTERVAL 8 HOUR) + INTERVAL 33 HOUR AS prediction_end FROM events""",
)
def _(t):
    return t.events.select("event_id", "ts").withColumns(tc.forecast_window(F.col("ts")))


@check(
    "hour_truncation",
    "event_id i, hour_ts t, hour i",
    "SELECT event_id, date_trunc('hour', ts) AS hour_ts, hour(ts) AS hour FROM events",
)
def _(t):
    return t.events.select("event_id", F.date_trunc("HOUR", "ts").alias("hour_ts"), F.hour("ts").alias("hour"))


_MEANS = ["relative_humidity_pct", "wind_speed_kmh", "precipitation_mm"]


@check(
    "numeric_features",
    "feature s, mean d",
    with_sql(
        P_HOUR,
        " UNION ALL ".join(f"SELECT '{c}' AS feature, avg({c}) AS mean FROM p_hour" for c in _MEANS),
    ),
)
def _(t):
    panel = pn.hourly_panel(t.events)
    names = pr.numeric_features(panel, exclude=["demand_mw", "temperature_c", "dew_point_c"])
    return panel.agg(*[F.avg(n).alias(n) for n in names]).unpivot([], names, "feature", "mean")
