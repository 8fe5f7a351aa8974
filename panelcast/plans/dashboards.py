"""Dashboard queries over production, forecast and contribution tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.joins import union_padded


def kpis(df: DataFrame) -> DataFrame:
    return df.agg(
        F.sum("OutputMW").alias("total_output"),
        F.sum("CapabilityMW").alias("total_capability"),
        F.avg("UtilizationRate").alias("avg_utilization"),
    )


def flow(df: DataFrame) -> DataFrame:
    """Output from zone to fuel."""
    return df.groupBy("Zone", "FuelType").agg(F.sum("OutputMW").alias("output_mw"))


def _between(df: DataFrame, ts: str, start: datetime | None, end: datetime | None) -> DataFrame:
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(ts) <= F.lit(end))
    return df


def hourly_series(df: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Output and capability per hour, either end of the range optional."""
    scope = _between(df, "datetime", start, end)
    return scope.groupBy(F.date_trunc("HOUR", "datetime").alias("hour")).agg(
        F.sum("OutputMW").alias("output_mw"), F.sum("CapabilityMW").alias("capability_mw")
    )


def heatmap(df: DataFrame) -> DataFrame:
    """Mean utilisation by zone and hour of day."""
    return df.groupBy("Zone", F.hour("datetime").alias("hour")).agg(
        F.avg("UtilizationRate").alias("avg_utilization")
    )


def zone_lines(df: DataFrame) -> DataFrame:
    return df.groupBy("Zone", F.date_trunc("HOUR", "datetime").alias("hour")).agg(
        F.avg("OutputMW").alias("avg_output"), F.avg("UtilizationRate").alias("avg_utilization")
    )


def detail(df: DataFrame) -> DataFrame:
    return df.groupBy("Zone", "FuelType", F.date_trunc("HOUR", "datetime").alias("hour")).agg(
        F.sum("OutputMW").alias("output_mw"),
        F.sum("CapabilityMW").alias("capability_mw"),
        F.avg("UtilizationRate").alias("avg_utilization"),
        F.sum("NumGenerators").alias("generators"),
    )


def apply_filters(
    df: DataFrame, selected: dict[str, list], ts: str = "datetime", start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Multi-select filters; an empty selection of a column lets every value through."""
    for column, values in selected.items():
        if values:
            df = df.filter(F.col(column).isin(list(values)))
    return _between(df, ts, start, end)


def filter_counts(df: DataFrame, column: str, selected: dict[str, list]) -> DataFrame:
    """Every value of a filter with the rows it keeps under the other filters."""
    passes = F.lit(True)
    for other, values in selected.items():
        if other != column and values:
            passes = passes & F.col(other).isin(list(values))
    return df.groupBy(column).agg(F.count_if(passes).alias("matching_rows"))


def combined_forecast(forecast: DataFrame, contributions: DataFrame) -> DataFrame:
    """Predictions and contributions stacked, each with nulls for what only the other has."""
    left = forecast.select("zone", "target_datetime", "predicted_demand_mw")
    right = contributions.select("zone", "target_datetime", "feature_name", "shap_value")
    return union_padded(left, right)


def semantic_measures(forecast: DataFrame, contributions: DataFrame) -> DataFrame:
    """Mean prediction, summed contribution and base value by zone and target hour.

    Each side is aggregated before the join, so contributions do not multiply predictions.
    """
    keys = ["zone", "target_datetime"]
    predicted = forecast.groupBy(*keys).agg(F.avg("predicted_demand_mw").alias("predicted_demand_mw"))
    explained = contributions.groupBy(*keys).agg(
        F.sum("shap_value").alias("shap_value"), F.max("base_value").alias("base_value")
    )
    return predicted.join(explained, keys, "left")
