"""Panels derived from the shared test tables, at whatever size those tables have."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators.series import interpolate_linear, regularize
from panelcast.operators.windows import lag_exact

# Weights and made-up coordinates of the five event zones.
EVENT_ZONES = [
    ("click", 43.70, -79.42, 0.30, "A"),
    ("error", 45.42, -75.69, 0.25, "B"),
    ("purchase", 43.45, -80.49, 0.20, "C"),
    ("signup", 42.98, -81.23, 0.15, "D"),
    ("view", 44.23, -76.49, 0.10, "E"),
]
EVENT_WEIGHTS = {name: weight for name, _, _, weight, _ in EVENT_ZONES}


class Tables:
    """Parquet tables of one scale folder, read lazily by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def hourly_panel(events: DataFrame) -> DataFrame:
    """Zone-hour panel: summed event values with stand-in weather from the event fields."""
    k = F.get_json_object("props", "$.k").cast("int")
    rows = events.select(
        F.col("event_type").alias("zone"),
        F.date_trunc("hour", "ts").alias("datetime"),
        "value",
        k.alias("k"),
        F.col("user_id"),
    )
    measured = rows.groupBy("zone", "datetime").agg(
        F.sum("value").alias("demand_mw"),
        (F.avg("k") * 0.5 - 15).alias("_t"),
        (F.avg(F.col("user_id") % 80) + 20).alias("relative_humidity_pct"),
        F.avg(F.col("k") % 40).alias("wind_speed_kmh"),
        (F.greatest(F.min("k") - 50, F.lit(0)) / 10).alias("precipitation_mm"),
    )
    temperature = F.when(F.hour("datetime") % 11 != 0, F.col("_t"))
    dew = F.col("temperature_c") - (F.lit(100) - F.col("relative_humidity_pct")) / 5
    weather = measured.withColumn("temperature_c", temperature).withColumn("dew_point_c", dew)
    return weather.select(
        "zone", "datetime", "demand_mw", "temperature_c", "dew_point_c",
        "relative_humidity_pct", "wind_speed_kmh", "precipitation_mm",
    )


def interval_panel(events: DataFrame) -> DataFrame:
    """Five-minute report rows: zone, date, hour 1..24, interval 1..12, mean value."""
    return (
        events.select(
            F.col("event_type").alias("zone"),
            F.to_date("ts").alias("date"),
            (F.hour("ts") + 1).alias("hour"),
            (F.floor(F.minute("ts") / 5) + 1).cast("int").alias("interval"),
            "value",
        )
        .groupBy("zone", "date", "hour", "interval")
        .agg(F.avg("value").alias("demand_mw"))
    )


def dense_interval_panel(events: DataFrame) -> DataFrame:
    """The five-minute report with all days of a month folded onto its first, so that hours are complete."""
    return interval_panel(events.withColumn("ts", F.to_timestamp_ntz(F.concat_ws(" ", F.date_format("ts", "yyyy-MM-01"), F.date_format("ts", "HH:mm:ss")))))


def wide_panel(events: DataFrame) -> DataFrame:
    """One column per zone plus the total and the difference to it, as the reports have them."""
    names = [zone for zone, *_ in EVENT_ZONES]
    sums = [F.sum(F.when(F.col("zone") == n, F.col("demand_mw"))).alias(n) for n in names]
    panel = hourly_panel(events)
    return panel.groupBy("datetime").agg(
        *sums,
        F.sum("demand_mw").alias("Ontario Demand"),
        (F.sum("demand_mw") * 1.02).alias("Market Demand"),
        F.sum("demand_mw").alias("Zone Total"),
        F.lit(0.0).alias("Diff"),
    )


def daily_panel(orders: DataFrame) -> DataFrame:
    """Zone-day panel of order values."""
    return orders.groupBy(
        F.col("o_orderpriority").alias("zone"), F.col("o_orderdate").alias("date")
    ).agg(F.sum("o_totalprice").alias("y"), F.count(F.lit(1)).alias("n_orders"))


def repeated_panel(events: DataFrame) -> DataFrame:
    """The hourly panel with a second, changed row for every fifth hour."""
    first = hourly_panel(events).withColumn("seq", F.lit(1))
    again = first.filter(F.hour("datetime") % 5 == 0).withColumns(
        {"demand_mw": F.col("demand_mw") + 1, "seq": F.lit(2)}
    )
    return first.unionByName(again)


def steady_panel(events: DataFrame) -> DataFrame:
    """The hourly panel with the first two hours of every gap of demand filled linearly, so that windows have no holes."""
    grid = regularize(hourly_panel(events), "zone", "datetime")
    return interpolate_linear(grid, "zone", "datetime", "demand_mw")


def forecast_panel(events: DataFrame, hi: int = 168) -> DataFrame:
    """Issues times horizons with actuals and a seasonal-naive prediction.

    The prediction is the last value of the target's hour of day that is known when the forecast is issued: its
    exact lag of 24 hours up to horizon 24, of 48 up to 48, and so on.
    """
    days = -(-hi // 24)
    panel = hourly_panel(events).select("zone", "datetime", "demand_mw")
    lagged = lag_exact(panel, "zone", "datetime", "demand_mw", sorted({*range(24, 24 * days + 1, 24), 168}), stem="demand_lag")
    targets = lagged.select(
        "zone",
        F.col("datetime").alias("target_datetime"),
        F.col("demand_mw").alias("target_demand_mw"),
        F.array(*[F.col(f"demand_lag_{24 * d}h") for d in range(1, days + 1)]).alias("_known"),
        F.col("demand_lag_168h").alias("lag_168_mw"),
    )
    # every target serves hi issues, so the issues come from the target side without a join
    horizon = F.explode(F.sequence(F.lit(1), F.lit(hi)))
    expanded = targets.withColumn("forecast_horizon_hours", horizon)
    issue = F.timestamp_add("HOUR", -F.col("forecast_horizon_hours"), F.col("target_datetime"))
    known = F.get("_known", F.floor((F.col("forecast_horizon_hours") - 1) / 24).cast("int"))
    return expanded.withColumns({"issue_datetime": issue, "prediction_mw": known}).drop("_known")


def target_panel(events: DataFrame) -> DataFrame:
    """One row per target: the actual value and the exact lags of a day and a week."""
    panel = hourly_panel(events).select("zone", "datetime", "demand_mw")
    lagged = lag_exact(panel, "zone", "datetime", "demand_mw", [24, 168], stem="demand_lag")
    return lagged.select(
        "zone",
        F.col("datetime").alias("target_datetime"),
        F.col("demand_mw").alias("target_demand_mw"),
        F.col("demand_lag_24h").alias("prediction_mw"),
        F.col("demand_lag_168h").alias("lag_168_mw"),
    )


def production_panel(t: Tables) -> DataFrame:
    """Production by zone, fuel and day: output, capability, utilisation, generators."""
    joined = (
        t.lineitem.select("l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
        .join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation.select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    sums = joined.groupBy(
        F.col("r_name").alias("Zone"), F.col("p_type").alias("FuelType"), F.col("l_shipdate").alias("datetime")
    ).agg(
        F.sum("l_quantity").alias("OutputMW"),
        (F.count(F.lit(1)) * 50.0).alias("CapabilityMW"),
        F.count_distinct("l_suppkey").alias("NumGenerators"),
    )
    return sums.withColumn("UtilizationRate", F.col("OutputMW") / F.col("CapabilityMW"))


def upsert_sides(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Target and source of an upsert: two overlapping parts of the orders."""
    slim = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    target = slim.filter("o_orderkey % 3 <> 0")
    source = slim.filter("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 10)
    return target, source


def totals_with_zones(panel: DataFrame, label: str = "Total") -> DataFrame:
    """Forecast rows of the zones plus rows of a directly forecast total."""
    total = panel.groupBy("issue_datetime", "target_datetime", "forecast_horizon_hours").agg(
        F.sum("target_demand_mw").alias("target_demand_mw"),
        (F.sum("prediction_mw") * 1.01).alias("prediction_mw"),
    )
    columns = ["zone", "issue_datetime", "target_datetime", "forecast_horizon_hours", "target_demand_mw", "prediction_mw"]
    return panel.select(*columns).unionByName(total.withColumn("zone", F.lit(label)))


__all__ = [
    "EVENT_WEIGHTS", "EVENT_ZONES", "Tables", "daily_panel", "dense_interval_panel", "forecast_panel", "hourly_panel",
    "interval_panel", "production_panel", "repeated_panel", "steady_panel", "target_panel", "totals_with_zones", "upsert_sides", "wide_panel",
]
