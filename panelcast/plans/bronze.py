"""Landed reports to bronze tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.timecols import hour_start, to_local, to_utc
from panelcast.operators.aggregate import mean_zone
from panelcast.operators.projection import CLIMATE_NAMES, rename, split_global_zonal
from panelcast.operators.quality import dedup_ordered
from panelcast.schemas import WEATHER_MEASURES
from panelcast.sources.sinks import upsert

LOCAL_ZONE = "America/Toronto"


def demand_tables(report: DataFrame, now: datetime, tz: str = LOCAL_ZONE) -> tuple[DataFrame, DataFrame]:
    """A parsed yearly report as the table of totals and the zonal table, times in UTC."""
    stamped = report.withColumn("datetime", to_utc(hour_start("Date", "Hour"), tz))
    totals, zonal = split_global_zonal(stamped)
    loaded = F.lit(now).cast("timestamp")
    return (
        totals.withColumn("ingestion_time", loaded),
        zonal.select("datetime", "zone", "demand_mw").withColumn("ingestion_time", loaded),
    )


def load_demand(
    spark: SparkSession, report: DataFrame, now: datetime, totals_path: str, zonal_path: str
) -> None:
    """Upsert both demand tables; reloading a window of days leaves one row per key."""
    totals, zonal = demand_tables(report, now)
    day = {"load_date": F.to_date("datetime")}
    upsert(
        spark, totals_path, totals, ["datetime"],
        ["market_demand", "ontario_demand", "ingestion_time"], day,
    )
    upsert(
        spark, zonal_path, zonal, ["datetime", "zone"], ["demand_mw", "ingestion_time"],
        {"load_month": F.date_trunc("month", "datetime").cast("date")},
    )


def weather_table(pages: DataFrame, now: datetime, total_label: str = "Ontario", tz: str = LOCAL_ZONE) -> DataFrame:
    """Climate rows of all zones, first row per zone and hour, plus the mean zone."""
    named = rename(pages, {**CLIMATE_NAMES, "UTC_DATE": "datetime", "ZONE": "zone"})
    kept = named.select("zone", "datetime", *WEATHER_MEASURES).dropna(subset=["datetime"])
    unique = dedup_ordered(kept, ["zone", "datetime"], WEATHER_MEASURES, keep="first")
    local = unique.withColumn("datetime_local", to_local("datetime", tz))
    both = mean_zone(local, "datetime", WEATHER_MEASURES, total_label, first=["datetime_local"])
    return both.withColumn("ingestion_time", F.lit(now).cast("timestamp"))
