"""Checks of joins, set operations, aggregates, sources and sinks."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from panelcast.catalog.base import (
    P_FORECAST,
    P_HOUR,
    P_DENSE,
    P_INTERVAL,
    P_WIDE,
    ZONE_NAMES,
    check,
    with_sql,
)
from panelcast.catalog.reports import CONTRIB, explained
from panelcast.functions.timecols import hour_start
from panelcast.operators import aggregate as ag
from panelcast.operators import joins as jn
from panelcast.plans import panels as pn
from panelcast.session import shared_folder
from panelcast.sources import readers as rd
from panelcast.sources import sinks as sk
from panelcast.streaming.hourly import stream_hourly
from panelcast.streaming.upserts import stream_upsert


def scratch(t, name: str) -> str:
    """A fresh folder for a round trip: under the shared folder where the cluster names one."""
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


# --- joins and sets ----------------------------------------------------------------------------


@check(
    "join_panel",
    "zone s, datetime t, demand_mw d, temperature_c d",
    with_sql(
        P_HOUR,
        """SELECT d.zone, d.datetime, d.demand_mw, w.temperature_c FROM p_hour d
           LEFT JOIN (SELECT * FROM p_hour WHERE hour(datetime) % 4 <> 0) w USING (zone, datetime)""",
    ),
)
def _(t):
    panel = pn.hourly_panel(t.events)
    weather = panel.filter(F.hour("datetime") % 4 != 0).select("zone", "datetime", "temperature_c")
    return jn.join_panel(panel.select("zone", "datetime", "demand_mw"), weather)


@check(
    "unmatched_rows",
    "rows i, unmatched i",
    """SELECT count(*) AS rows, count(*) FILTER (o_orderkey IS NULL) AS unmatched
       FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW') ON l_orderkey = o_orderkey""",
)
def _(t):
    orders = t.orders.filter("o_orderpriority <> '5-LOW'").select(F.col("o_orderkey").alias("k"), "o_custkey")
    lines = t.lineitem.select(F.col("l_orderkey").alias("k"))
    return jn.unmatched_count(jn.join_panel(lines, orders, ["k"]), "o_custkey")


@check(
    "expand_horizons",
    "zone s, datetime t, forecast_horizon_hours i, target_datetime t",
    with_sql(
        P_HOUR,
        """SELECT zone, datetime, h AS forecast_horizon_hours, datetime + to_hours(h) AS target_datetime
           FROM p_hour, (SELECT unnest(range(1, 169)) AS h)""",
    ),
)
def _(t):
    return jn.expand_horizons(pn.hourly_panel(t.events).select("zone", "datetime"), "datetime", 1, 168)


@check(
    "join_target",
    "zone s, datetime t, forecast_horizon_hours i, target_demand_mw d, weather_target_temperature_c d",
    with_sql(
        P_HOUR,
        """, e AS (SELECT zone, datetime, h, datetime + to_hours(h) AS at FROM p_hour, (SELECT unnest(range(1, 169)) AS h))
           SELECT e.zone, e.datetime, h AS forecast_horizon_hours, x.demand_mw AS target_demand_mw,
                  x.temperature_c AS weather_target_temperature_c
           FROM e LEFT JOIN p_hour x ON x.zone = e.zone AND x.datetime = e.at""",
    ),
)
def _(t):
    panel = pn.hourly_panel(t.events)
    expanded = jn.expand_horizons(panel.select("zone", "datetime"), "datetime", 1, 168)
    names = {"demand_mw": "target_demand_mw", "temperature_c": "weather_target_temperature_c"}
    return jn.join_target(expanded, panel, names)


@check(
    "keep_matching",
    "l_orderkey i, l_linenumber i",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')",
)
def _(t):
    done = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return jn.keep_matching(t.lineitem.select("l_orderkey", "l_linenumber"), done, "l_orderkey")


@check(
    "join_aggregates",
    "o_custkey i, n_orders i, total d2",
    """SELECT o_custkey, n_orders, total FROM (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1)
       JOIN (SELECT o_custkey, sum(o_totalprice) AS total FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) USING (o_custkey)""",
)
def _(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    open_ = t.orders.filter("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    return jn.join_aggregates(counts, open_, "o_custkey")


@check(
    "forecast_with_contributions",
    "zone s, target_datetime t, predicted_demand_mw d, feature_name s, shap_value d, base_value d",
    with_sql(
        CONTRIB,
        """SELECT zone, target_datetime, predicted_demand_mw, feature_name, shap_value, base_value
           FROM predicted LEFT JOIN contrib USING (zone, target_datetime)""",
    ),
)
def _(t):
    return jn.forecast_with_contributions(*explained(t))


@check(
    "contributions",
    "zone s, target_datetime t, feature_name s, shap_value d, base_value d",
    with_sql(CONTRIB, "SELECT * FROM contrib"),
)
def _(t):
    return explained(t)[1]


@check(
    "top_contributions",
    "feature_name s, avg_abs_shap d, avg_shap d",
    with_sql(
        CONTRIB,
        """SELECT feature_name, round(avg(abs(shap_value)), 4) AS avg_abs_shap, round(avg(shap_value), 4) AS avg_shap
           FROM contrib GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    ),
)
def _(t):
    return ag.top_contributions(explained(t)[1])


@check(
    "union_padded",
    "zone s, datetime t, demand_mw d, temperature_c d",
    with_sql(
        P_HOUR,
        """SELECT zone, datetime, demand_mw, NULL AS temperature_c FROM p_hour
           UNION ALL SELECT zone, datetime, NULL, temperature_c FROM p_hour""",
    ),
)
def _(t):
    panel = pn.hourly_panel(t.events)
    return jn.union_padded(panel.select("zone", "datetime", "demand_mw"), panel.select("zone", "datetime", "temperature_c"))


@check(
    "shared_keys",
    "k i",
    "SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def _(t):
    buyers = t.orders.select(F.col("o_custkey").alias("k"))
    return jn.shared_keys(buyers, t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k")), "k")


@check("missing_keys", "k i", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def _(t):
    buyers = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k"))
    return jn.missing_keys(t.customer.select(F.col("c_custkey").alias("k")), buyers, "k")


# --- aggregates --------------------------------------------------------------------------------

WEIGHTS = ", ".join(f"('{z}', {w})" for z, w in pn.EVENT_WEIGHTS.items())
WEIGHTED = P_HOUR + f", w(zone, weight) AS (SELECT zone, CAST(weight AS DOUBLE) FROM (VALUES {WEIGHTS}) v(zone, weight))"


@check(
    "mean_zone",
    "zone s, datetime t, temperature_c d, wind_speed_kmh d, datetime_local t",
    with_sql(
        P_HOUR,
        """SELECT zone, datetime, temperature_c, wind_speed_kmh, datetime AS datetime_local FROM p_hour
           UNION ALL SELECT 'Total', datetime, avg(temperature_c), avg(wind_speed_kmh), min(datetime) FROM p_hour GROUP BY datetime""",
    ),
)
def _(t):
    panel = pn.hourly_panel(t.events).select("zone", "datetime", "temperature_c", "wind_speed_kmh")
    local = panel.withColumn("datetime_local", F.col("datetime"))
    return ag.mean_zone(local, "datetime", ["temperature_c", "wind_speed_kmh"], "Total", first=["datetime_local"])


@check(
    "weighted_zone",
    "zone s, datetime t, temperature_c d, relative_humidity_pct d, hour i",
    with_sql(
        WEIGHTED,
        """SELECT 'Total' AS zone, datetime,
                  sum(weight * temperature_c) / nullif(sum(CASE WHEN temperature_c IS NOT NULL THEN weight END), 0) AS temperature_c,
                  sum(weight * relative_humidity_pct) / sum(weight) AS relative_humidity_pct, min(hour(datetime)) AS hour
           FROM p_hour JOIN w USING (zone) GROUP BY datetime""",
    ),
)
def _(t):
    panel = pn.hourly_panel(t.events).withColumn("hour", F.hour("datetime"))
    columns = ["temperature_c", "relative_humidity_pct"]
    return ag.weighted_zone(panel, "datetime", columns, pn.EVENT_WEIGHTS, "Total", passthrough=["hour"])


@check(
    "weighted_sum",
    "datetime t, weighted_temperature_c d, weighted_wind_speed_kmh d",
    with_sql(
        WEIGHTED,
        """SELECT datetime, CASE WHEN count(*) = count(temperature_c) THEN sum(weight * temperature_c) END AS weighted_temperature_c,
                  sum(weight * wind_speed_kmh) AS weighted_wind_speed_kmh FROM p_hour JOIN w USING (zone) GROUP BY datetime""",
    ),
)
def _(t):
    return ag.weighted_sum(
        pn.hourly_panel(t.events), "datetime", ["temperature_c", "wind_speed_kmh"], pn.EVENT_WEIGHTS
    )


@check(
    "check_weights",
    "total_weight d, is_valid i, latitude d, longitude d",
    """WITH z AS (SELECT c_nationkey, count(*) AS n, avg(c_acctbal) AS lat, avg(c_custkey) AS lon FROM customer GROUP BY 1),
            w AS (SELECT *, n / (SELECT sum(n) FROM z) AS weight FROM z)
       SELECT sum(weight) AS total_weight, CASE WHEN abs(sum(weight) - 1) < 0.01 THEN 1 ELSE 0 END AS is_valid,
              sum(lat * weight) AS latitude, sum(lon * weight) AS longitude FROM w""",
)
def _(t):
    zones = t.customer.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.avg("c_acctbal").alias("latitude"), F.avg("c_custkey").alias("longitude")
    )
    total = zones.agg(F.sum("n").alias("total"))
    return ag.check_weights(jn.attach_one_row(zones, total).withColumn("weight", F.col("n") / F.col("total")))


_DRAWN = "md5('42|' || l_orderkey || '|' || l_linenumber)"


@check(
    "bernoulli_sample",
    "l_orderkey i, l_linenumber i",
    f"SELECT l_orderkey, l_linenumber FROM lineitem WHERE substr({_DRAWN}, 1, 8) < '33333333'",
)
def _(t):
    return ag.sample(t.lineitem, 0.2, ["l_orderkey", "l_linenumber"])


@check(
    "fixed_size_sample",
    "l_orderkey i, l_linenumber i",
    f"SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY {_DRAWN}, l_orderkey, l_linenumber LIMIT 1000",
)
def _(t):
    return ag.sample_n(t.lineitem.select("l_orderkey", "l_linenumber"), 1000, ["l_orderkey", "l_linenumber"])


_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@check(
    "corr_with_target",
    "feature s, correlation d, is_low i",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, abs(corr({f}, price)) AS correlation, CASE WHEN abs(corr({f}, price)) < 0.05 THEN 1 ELSE 0 END AS is_low"
        " FROM (SELECT *, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS price FROM lineitem)"
        for f in _FEATS
    ),
)
def _(t):
    price = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return ag.corr_with_target(t.lineitem.withColumn("price", price), _FEATS, "price")


@check(
    "collinear_pairs",
    "feature_1 s, feature_2 s, correlation d",
    """WITH r AS (SELECT l_quantity AS a, l_extendedprice AS b, l_extendedprice * (1 - l_discount) AS c,
                        l_quantity * 2 + l_tax AS d FROM lineitem),
            p AS (SELECT 'a' AS feature_1, 'b' AS feature_2, abs(corr(a, b)) AS correlation FROM r UNION ALL
                  SELECT 'a', 'c', abs(corr(a, c)) FROM r UNION ALL SELECT 'a', 'd', abs(corr(a, d)) FROM r UNION ALL
                  SELECT 'b', 'c', abs(corr(b, c)) FROM r UNION ALL SELECT 'b', 'd', abs(corr(b, d)) FROM r UNION ALL
                  SELECT 'c', 'd', abs(corr(c, d)) FROM r)
       SELECT * FROM p WHERE correlation > 0.9""",
)
def _(t):
    rows = t.lineitem.select(
        F.col("l_quantity").alias("a"),
        F.col("l_extendedprice").alias("b"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("c"),
        (F.col("l_quantity") * 2 + F.col("l_tax")).alias("d"),
    )
    return ag.collinear_pairs(rows, ["a", "b", "c", "d"])


def _scores(t):
    price = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    rows = t.lineitem.withColumn("price", price)
    one = ag.corr_with_target(rows, _FEATS, "price")
    two = ag.corr_with_target(rows, _FEATS, "l_linenumber").select(
        "feature", F.col("correlation").alias("importance")
    )
    return one.join(two, "feature")


_SCORES = (
    "WITH s AS ("
    + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, abs(corr({f}, price)) AS correlation, abs(corr({f}, l_linenumber)) AS importance"
        " FROM (SELECT *, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS price FROM lineitem)"
        for f in _FEATS
    )
    + """), ranked AS (SELECT *, rank() OVER (ORDER BY correlation DESC) AS corr_rank,
           rank() OVER (ORDER BY importance DESC) AS imp_rank FROM s)"""
)


@check(
    "combined_rank",
    "feature s, corr_rank d, imp_rank d, avg_rank d",
    _SCORES + " SELECT *, (corr_rank + imp_rank) / 2 AS avg_rank FROM ranked",
)
def _(t):
    return ag.combined_rank(_scores(t))


_GROUPS = {"lag": ["l_quantity"], "price": ["l_extendedprice", "l_discount", "l_tax"]}


@check(
    "select_features",
    "feature s, feature_group s, avg_rank d",
    _SCORES
    + """, g AS (SELECT feature, CASE feature WHEN 'l_quantity' THEN 'lag' ELSE 'price' END AS feature_group,
                 (corr_rank + imp_rank) / 2 AS avg_rank FROM ranked)
       SELECT feature, feature_group, avg_rank FROM (
         SELECT *, row_number() OVER (PARTITION BY feature_group ORDER BY avg_rank, feature) AS r FROM g)
       WHERE r <= CASE feature_group WHEN 'lag' THEN 5 ELSE 2 END""",
)
def _(t):
    return ag.select_features(ag.combined_rank(_scores(t)), _GROUPS)


@check(
    "prediction_stats",
    "zone s, total_predictions i, avg_demand_mw d, std_demand_mw d, min_demand_mw d, max_demand_mw d, first_target t, last_target t, min_horizon i, max_horizon i",
    with_sql(
        P_FORECAST,
        """SELECT zone, count(*) AS total_predictions, round(avg(prediction_mw) + 1e-7, 1) AS avg_demand_mw,
                  round(stddev_samp(prediction_mw), 1) AS std_demand_mw, round(min(prediction_mw) + 1e-7, 1) AS min_demand_mw,
                  round(max(prediction_mw) + 1e-7, 1) AS max_demand_mw, min(target_datetime) AS first_target,
                  max(target_datetime) AS last_target, min(forecast_horizon_hours) AS min_horizon,
                  max(forecast_horizon_hours) AS max_horizon FROM p_forecast GROUP BY zone""",
    ),
)
def _(t):
    return ag.prediction_stats(pn.forecast_panel(t.events), "zone", "prediction_mw", horizon="forecast_horizon_hours")


@check(
    "distinct_counts",
    "o_orderpriority s, distinct_o_custkey i, distinct_o_orderstatus i",
    """SELECT o_orderpriority, count(DISTINCT o_custkey) AS distinct_o_custkey,
              count(DISTINCT o_orderstatus) AS distinct_o_orderstatus FROM orders GROUP BY 1""",
)
def _(t):
    return ag.distinct_counts(t.orders, ["o_custkey", "o_orderstatus"], "o_orderpriority")


# --- sources -----------------------------------------------------------------------------------


@check(
    "catalog_table_scan",
    "o_orderkey i, o_totalprice d2",
    "SELECT o_orderkey, o_totalprice FROM orders",
)
def _(t):
    return rd.read_table(t.spark, f"{t.folder}/orders.parquet").select("o_orderkey", "o_totalprice")


def _report_lines(t, path: str) -> None:
    """The wide panel as a report file a day: metadata lines, a header line, one line per hour.

    Files of the second half of the month have their columns in another order and lack the last one.
    """
    wide = pn.wide_panel(t.events)
    measures = [c for c in wide.columns if c != "datetime"]
    texts = {"Date": F.date_format("datetime", "yyyy-MM-dd"), "Hour": (F.hour("datetime") + 1).cast("string")}
    texts |= {c: F.coalesce(F.col(c).cast("string"), F.lit("n/a")) for c in measures}
    late = F.col("datetime") >= F.lit(datetime(2024, 1, 16))
    for part, names in ((~late, ["Date", "Hour", *measures]), (late, [*measures[-2::-1], "Hour", "Date"])):
        head = ["\\\\ Hourly demand report", "\\\\ Created 2024-02-01", "\\\\ All values in MW", ",".join(names)]
        rows = wide.where(part).select(F.to_date("datetime").alias("day"), F.concat_ws(",", *[texts[n] for n in names]).alias("value"))
        _file_a_day(rows, head, path)


def _file_a_day(rows, head: list[str], path: str) -> None:
    """Rows (day, value) as a file for each day below the path, metadata and header lines first."""
    lines = F.posexplode(F.array(*[F.lit(line) for line in head])).alias("place", "value")
    heads = rows.select("day").distinct().select("day", lines)
    placed = heads.unionByName(rows.withColumn("place", F.lit(len(head))))
    filed = placed.repartition("day").sortWithinPartitions("day", "place").select("day", "value")
    filed.write.mode("append").partitionBy("day").text(path)


@check(
    "report_csv_scan",
    "Date date, Hour i, " + ", ".join(f"{n} d" for n in ZONE_NAMES),
    with_sql(
        P_WIDE,
        "SELECT CAST(datetime AS DATE) AS \"Date\", hour(datetime) + 1 AS \"Hour\", "
        + ", ".join(f'"{n}"' for n in ZONE_NAMES)
        + " FROM p_wide WHERE datetime >= TIMESTAMP '2024-01-03' AND datetime < TIMESTAMP '2024-01-29'",
    ),
)
def _(t):
    path = scratch(t, "report")
    _report_lines(t, path)
    start, end = datetime(2024, 1, 3).date(), datetime(2024, 1, 28).date()
    return rd.read_report_csv(t.spark, path, start=start, end=end)


@check(
    "interval_feed_scan",
    "Date date, Hour i, Interval i, zone s, demand_mw d",
    with_sql(
        P_INTERVAL,
        'SELECT date AS "Date", hour AS "Hour", "interval" AS "Interval", zone, demand_mw FROM p_interval',
    ),
)
def _(t):
    path = scratch(t, "feed")
    sums = [F.max(F.when(F.col("zone") == n, F.col("demand_mw"))).alias(n) for n in ZONE_NAMES]
    wide = pn.interval_panel(t.events).groupBy("date", "hour", "interval").agg(*sums)
    texts = {c.title(): F.col(c).cast("string") for c in ("date", "hour", "interval")}
    texts |= {n: F.coalesce(F.col(n).cast("string"), F.lit("")) for n in ZONE_NAMES}
    for even, names in ((0, list(texts)), (1, list(texts)[::-1])):
        of_day = wide.where(F.dayofmonth("date") % 2 == even)
        rows = of_day.select(F.to_date("date").alias("day"), F.concat_ws(",", *[texts[n] for n in names]).alias("value"))
        _file_a_day(rows, ["Real-time five-minute feed", "Created at 2024-02-01", " , ".join(names)], path)
    feed = rd.read_interval_feed(t.spark, path, required=["Date", "Hour", "Interval", *ZONE_NAMES])
    return feed.unpivot(["Date", "Hour", "Interval"], ZONE_NAMES, "zone", "demand_mw").dropna(subset=["demand_mw"])


@check(
    "geojson_scan",
    "ZONE s, UTC_DATE t, TEMP d, RELATIVE_HUMIDITY d, WIND_SPEED d",
    with_sql(
        P_HOUR,
        """SELECT 'All' AS "ZONE", datetime AS "UTC_DATE", temperature_c AS "TEMP",
                  relative_humidity_pct AS "RELATIVE_HUMIDITY", wind_speed_kmh AS "WIND_SPEED" FROM p_hour""",
    ),
)
def _(t):
    path = scratch(t, "pages")
    properties = F.struct(
        F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("UTC_DATE"),
        F.col("temperature_c").alias("TEMP"),
        F.col("relative_humidity_pct").alias("RELATIVE_HUMIDITY"),
        F.col("wind_speed_kmh").alias("WIND_SPEED"),
    )
    # a page is one zone and day, at most 24 features
    pages = pn.hourly_panel(t.events).groupBy("zone", F.to_date("datetime").alias("day")).agg(
        F.collect_list(F.struct(properties.alias("properties"))).alias("features")
    )
    pages.select(F.to_json(F.struct("features")).alias("value")).write.mode("append").text(path)
    return rd.read_geojson_features(t.spark, path, zone="All", multiline=False)


@check(
    "columnar_json_scan",
    "zone s, time t, temperature_2m d, wind_speed_10m d, cloud_cover d",
    with_sql(
        P_HOUR,
        """SELECT zone, datetime AS time, temperature_c AS temperature_2m, wind_speed_kmh AS wind_speed_10m,
                  NULL AS cloud_cover FROM p_hour""",
    ),
)
def _(t):
    path = scratch(t, "arrays")
    points = F.struct("datetime", "temperature_c", "wind_speed_kmh")
    days = pn.hourly_panel(t.events).groupBy("zone", F.to_date("datetime").alias("day")).agg(
        F.sort_array(F.collect_list(points)).alias("p")
    )
    hourly = F.struct(
        F.transform("p", lambda x: F.date_format(x["datetime"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
        F.col("p.temperature_c").alias("temperature_2m"),
        F.col("p.wind_speed_kmh").alias("wind_speed_10m"),
    )
    payload = F.to_json(F.struct("zone", hourly.alias("hourly")), {"ignoreNullFields": "false"})
    days.select(payload.alias("value")).write.mode("append").text(path)
    names = ["temperature_2m", "wind_speed_10m", "cloud_cover"]
    return rd.read_columnar_json(t.spark, path, names, extra="zone string", multiline=False)


@check(
    "first_available_archive",
    "zone s, datetime t, demand_mw d",
    with_sql(P_HOUR, "SELECT zone, datetime, demand_mw FROM p_hour WHERE datetime >= TIMESTAMP '2024-01-10'"),
)
def _(t):
    base = scratch(t, "archive")
    pn.hourly_panel(t.events).select("zone", "datetime", "demand_mw").write.parquet(f"{base}/b.parquet")
    candidates = [f"{base}/a.parquet", f"{base}/b.parquet", f"{base}/c.csv"]
    return rd.read_first_available(t.spark, candidates, "datetime", start=datetime(2024, 1, 10))


# --- sinks -------------------------------------------------------------------------------------


@check(
    "partitioned_overwrite",
    "zone s, datetime t, demand_mw d",
    with_sql(P_HOUR, "SELECT zone, datetime, demand_mw FROM p_hour"),
)
def _(t):
    path = scratch(t, "partitioned")
    panel = pn.hourly_panel(t.events).select("zone", "datetime", "demand_mw", F.month("datetime").alias("month"))
    for _ in range(2):  # a rerun leaves the same table
        sk.write_partitioned(panel, path, ["month", "zone"])
    return t.spark.read.parquet(path)


@check(
    "evolving_append",
    "zone s, datetime t, demand_mw d, temperature_c d",
    with_sql(
        P_HOUR,
        """SELECT zone, datetime, demand_mw, NULL AS temperature_c FROM p_hour WHERE hour(datetime) < 12
           UNION ALL SELECT zone, datetime, demand_mw, temperature_c FROM p_hour WHERE hour(datetime) >= 12""",
    ),
)
def _(t):
    path = scratch(t, "evolving")
    panel = pn.hourly_panel(t.events)
    sk.append_evolving(panel.filter(F.hour("datetime") < 12).select("zone", "datetime", "demand_mw"), path)
    sk.append_evolving(panel.filter(F.hour("datetime") >= 12).select("zone", "datetime", "demand_mw", "temperature_c"), path)
    return sk.read_evolving(t.spark, path)


_MERGED = """SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(t.o_custkey, s.o_custkey) AS o_custkey,
  coalesce(s.p, t.o_totalprice) AS o_totalprice
  FROM (SELECT * FROM orders WHERE o_orderkey % 3 <> 0) t
  FULL JOIN (SELECT *, o_totalprice + 10 AS p FROM orders WHERE o_orderkey % 2 = 0) s ON t.o_orderkey = s.o_orderkey"""


@check("upsert_rows", "o_orderkey i, o_custkey i, o_totalprice d2", _MERGED)
def _(t):
    target, source = pn.upsert_sides(t.orders)
    return sk.merge_rows(target, source, "o_orderkey", ["o_totalprice"])


@check("upsert_table", "o_orderkey i, o_custkey i, o_totalprice d2", _MERGED)
def _(t):
    path = scratch(t, "upsert")
    target, source = pn.upsert_sides(t.orders)
    part = {"year": F.year("o_orderdate")}
    for rows in (target, source, source):  # the second load of the source changes nothing
        sk.upsert(t.spark, path, rows, "o_orderkey", ["o_totalprice"], part)
    return t.spark.read.parquet(path)


@check(
    "metric_export",
    "o_orderpriority s, orders i, total d2",
    "SELECT o_orderpriority, count(*) AS orders, sum(o_totalprice) AS total FROM orders GROUP BY 1",
)
def _(t):
    path = scratch(t, "export")
    table = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("total"))
    sk.export_metrics(table, path, "csv")
    return t.spark.read.csv(path, header=True, schema="o_orderpriority string, orders bigint, total double")


# --- streams -----------------------------------------------------------------------------------


@check(
    "stream_hourly_rollup",
    "zone s, datetime t, demand_mw d, interval_count i, demand_min_mw d, demand_max_mw d, last_interval i",
    with_sql(
        P_DENSE,
        """, h AS (SELECT zone, CAST(date AS TIMESTAMP) + to_hours(CAST(hour - 1 AS BIGINT)) AS datetime, * EXCLUDE (zone) FROM p_interval),
           r AS (SELECT zone, datetime, avg(demand_mw) AS demand_mw, count(DISTINCT "interval") AS interval_count,
                        min(demand_mw) AS demand_min_mw, max(demand_mw) AS demand_max_mw, max("interval") AS last_interval
                 FROM h GROUP BY 1, 2 HAVING count(DISTINCT "interval") >= 12)
           SELECT * FROM r WHERE datetime + INTERVAL 1 HOUR <= (SELECT max(datetime) FROM h) - INTERVAL 2 HOUR""",
    ),
)
def _(t):
    base = scratch(t, "stream")
    rows = pn.dense_interval_panel(t.events).withColumn("timestamp", hour_start("date", "hour"))
    rows.write.parquet(f"{base}/in")
    feed = t.spark.readStream.schema(t.spark.read.parquet(f"{base}/in").schema).parquet(f"{base}/in")
    query = (
        stream_hourly(feed)
        .writeStream.outputMode("append")
        .option("checkpointLocation", f"{base}/state")
        .trigger(availableNow=True)
        .format("parquet")
        .start(f"{base}/out")
    )
    query.awaitTermination()
    return t.spark.read.parquet(f"{base}/out")


@check("stream_upsert", "o_orderkey i, o_custkey i, o_totalprice d2", _MERGED)
def _(t):
    base = scratch(t, "stream-upsert")
    target, source = pn.upsert_sides(t.orders)
    target.withColumn("seq", F.lit(0)).unionByName(source.withColumn("seq", F.lit(1))).write.partitionBy("seq").parquet(f"{base}/in")
    for seq in (0, 1):
        feed = t.spark.readStream.schema(target.schema).parquet(f"{base}/in/seq={seq}")
        part = {"year": F.year("o_orderdate")}
        writer = stream_upsert(
            feed, f"{base}/table", "o_orderkey", ["o_totalprice"], f"{base}/state{seq}", part
        )
        writer.trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{base}/table")
