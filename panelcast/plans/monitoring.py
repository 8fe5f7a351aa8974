"""The seven evaluation tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.aggregate import sample_n
from panelcast.operators.evaluation import (
    error_distribution,
    metrics_by_horizon,
    metrics_by_time,
    metrics_full,
    row_errors,
)
from panelcast.operators.joins import attach_one_row
from panelcast.session import settle
from panelcast.sources.sinks import append_evolving

SAMPLE_ROWS = 1000


def evaluation_tables(
    predictions: DataFrame,
    model_type: str,
    run_id: str,
    now: datetime,
    y: str = "target_demand_mw",
    yhat: str = "prediction_mw",
    importance: DataFrame | None = None,
    sample_horizon: int | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> dict[str, DataFrame]:
    """Evaluation tables of one model by table name, every row stamped with time, model and run.

    The predictions are settled once and read by every table. The sample holds at most ``sample_rows`` rows, of all
    horizons or of ``sample_horizon`` alone, as for a week-ahead model whose samples are compared over time.
    """
    horizon = [c for c in ("forecast_horizon_hours",) if c in predictions.columns]
    predictions = settle(predictions.select("zone", "target_datetime", *horizon, y, yhat))
    period = predictions.agg(
        F.min("target_datetime").alias("test_period_start"), F.max("target_datetime").alias("test_period_end")
    )
    has_horizon = bool(horizon)
    pool = predictions
    if sample_horizon is not None:
        pool = predictions.where(F.col("forecast_horizon_hours") == sample_horizon)
    errors = row_errors(pool, y, yhat).select(
        "zone",
        "target_datetime",
        *horizon,
        F.col(y).alias("actual_demand_mw"),
        F.col(yhat).alias("predicted_demand_mw"),
        "error_mw",
        (F.try_divide(F.col("error_mw"), F.col(y)) * 100.0).alias("error_pct"),
    )
    tables = {
        "model_performance_global": attach_one_row(metrics_full(predictions, y, yhat), period),
        "model_performance_by_zone": metrics_full(predictions, y, yhat, "zone"),
        "model_performance_by_time": metrics_by_time(predictions, y, yhat),
        "model_error_distribution": error_distribution(predictions, y, yhat),
        "model_predictions_sample": sample_n(errors, sample_rows, ["zone", "target_datetime", *horizon]).drop(*horizon),
    }
    if has_horizon:
        tables["model_performance_by_horizon"] = metrics_by_horizon(predictions, y, yhat)
    if importance is not None:
        tables["model_feature_importance"] = importance.selectExpr("feature AS feature_name", "gain AS importance")
    stamp = {
        "evaluation_time": F.lit(now).cast("timestamp"),
        "model_type": F.lit(model_type),
        "model_run_id": F.lit(run_id),
    }
    return {name: table.withColumns(stamp) for name, table in tables.items()}


def append_evaluation(tables: dict[str, DataFrame], folder: str) -> None:
    for name, table in tables.items():
        append_evolving(table, f"{folder}/{name}")
