"""The interval-to-hour rollup on an unbounded feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.blocks import as_keys
from panelcast.operators.series import interval_bits


def stream_hourly(
    feed: DataFrame,
    key="zone",
    ts: str = "timestamp",
    interval: str = "interval",
    y: str = "demand_mw",
    watermark: str = "2 hours",
    need: int = 12,
) -> DataFrame:
    """Complete hours per zone from five-minute rows, for an append-mode query.

    ``ts`` is any time inside the hour. An hour is emitted once the watermark has passed it;
    the state per open hour is a few numbers and a bit mask of the intervals seen.
    """
    keys = as_keys(key)
    hourly = (
        feed.withWatermark(ts, watermark)
        .groupBy(*keys, F.window(ts, "1 hour").alias("_hour"))
        .agg(
            F.avg(y).alias("demand_mw"),
            F.bit_count(interval_bits(interval)).alias("interval_count"),
            F.min(y).alias("demand_min_mw"),
            F.max(y).alias("demand_max_mw"),
            F.max(interval).alias("last_interval"),
        )
    )
    complete = hourly.filter(F.col("interval_count") >= need)
    measures = ["demand_mw", "interval_count", "demand_min_mw", "demand_max_mw", "last_interval"]
    return complete.select(*keys, F.col("_hour.start").alias("datetime"), *measures)
