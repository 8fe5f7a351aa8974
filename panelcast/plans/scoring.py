"""Scoring inputs: target-hour weather and calendar with point-in-time history features."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalars import holiday_interactions, target_weather, weather_interactions
from panelcast.functions.timecols import cyclic, date_parts, day_parts, horizon_hours
from panelcast.operators.aggregate import prediction_stats, top_contributions, weighted_zone
from panelcast.operators.calendar import with_calendar
from panelcast.operators.joins import attach, union_padded
from panelcast.operators.modelling import contributions, linear_parts, model_inputs, predict
from panelcast.operators.projection import in_window
from panelcast.operators.quality import feature_coverage
from panelcast.operators.recursive import score_recursive, score_recursive_trees
from panelcast.operators.series import continuous_history, demand_features_at, history_slice, weather_stats_at
from panelcast.operators.trees import forest_of, medians_of
from panelcast.schemas import WEATHER_MEASURES
from panelcast.session import settle
from panelcast.sources.sinks import write_partitioned


def target_hours(
    forecast: DataFrame, now: datetime, start: datetime, end: datetime, weights: dict[str, float], total_label: str,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Target-hour features of each zone and of the weighted total zone.

    ``forecast`` holds zone, target_datetime and the ``weather_target_`` measures. The calendar is
    the real one, and the day-of-year cycle counts from day 1 as the scoring side always had it.
    """
    measures = [f"weather_target_{c}" for c in WEATHER_MEASURES]
    window = in_window(forecast.select("zone", "target_datetime", *measures), "target_datetime", start, end)
    total = weighted_zone(window, "target_datetime", measures, weights, total_label)
    both = union_padded(window, total)
    parts = date_parts("target_datetime", "target_")
    issue = F.lit(now)
    timed = both.withColumns(
        {
            "forecast_horizon_hours": horizon_hours(issue, "target_datetime"),
            **parts,
            **cyclic(parts["target_hour"], 24, "target_hour"),
            **cyclic(parts["target_day_of_week"], 7, "target_day_of_week"),
            **cyclic(parts["target_month"], 12, "target_month"),
            **cyclic(parts["target_day_of_year"], 365.25, "target_day_of_year"),
            **day_parts(parts["target_hour"], "target_time_"),
            **cyclic(F.hour(issue), 24, "issue_hour"),
        }
    )
    dated = with_calendar(timed, "target_date", years).withColumns(target_weather())
    return dated.withColumns({**weather_interactions(), **holiday_interactions()})


def scoring_features(
    demand: DataFrame,
    weather: DataFrame,
    forecast: DataFrame,
    ref: datetime,
    start: datetime,
    end: datetime,
    weights: dict[str, float],
    total_label: str = "Ontario",
    lag_offset: int = 0,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """One row per zone and target hour with every model input.

    Demand history is made continuous up to ``ref`` first, so short holes do not cost lags.
    """
    history = history_slice(demand.select("zone", "datetime", "demand_mw"), "datetime", ref)
    repaired = continuous_history(history, "zone", "datetime", "demand_mw", ref)
    demand_now = demand_features_at(repaired, "zone", "datetime", "demand_mw", ref)
    measures = ["temperature_c", "relative_humidity_pct", "precipitation_mm"]
    past = history_slice(weather.select("zone", "datetime", *measures), "datetime", ref)
    past = union_padded(past, weighted_zone(past, "datetime", measures, weights, total_label))
    weather_now = weather_stats_at(past, "zone", "datetime", ref, lag_offset=lag_offset)
    targets = target_hours(forecast, ref, start, end, weights, total_label, years)
    return attach(attach(targets, demand_now, "zone"), weather_now, "zone")


def run_metadata(spark, ref: datetime, start: datetime, end: datetime, created: datetime) -> DataFrame:
    """The one-row record of a scoring run."""
    schema = "ref_time timestamp, prediction_start timestamp, prediction_end timestamp, created_at timestamp"
    return spark.createDataFrame([(ref, start, end, created)], schema)


def stamp_predictions(df: DataFrame, created: datetime) -> DataFrame:
    """Prediction or contribution rows with their run time and target date."""
    return df.withColumns(
        {"prediction_time": F.lit(created).cast("timestamp"), "target_date": F.to_date("target_datetime")}
    )


def write_predictions(predictions: DataFrame, created: datetime, path: str, contributions: DataFrame | None = None) -> dict[str, DataFrame]:
    """Write stamped predictions by target date, contributions beside them, and return the tables of the run.

    ``predictions`` holds zone, target_datetime and predicted_demand_mw, and forecast_horizon_hours for the statistics by
    forecast day. Every table is read back from what was written, so all tell of the same rows. The table holds the
    newest run; an earlier one is replaced.
    """
    spark = predictions.sparkSession
    write_partitioned(stamp_predictions(predictions, created), f"{path}/predictions", ["target_date"])
    written = spark.read.parquet(f"{path}/predictions")
    tables = {"predictions": written, "by_zone": prediction_stats(written, "zone", "predicted_demand_mw")}
    if "forecast_horizon_hours" in predictions.columns:
        day = (F.floor((F.col("forecast_horizon_hours") - 1) / 24) + 1).cast("int")
        tables["by_day"] = prediction_stats(written.withColumn("forecast_day", day), "forecast_day", "predicted_demand_mw", horizon="forecast_horizon_hours")
    if contributions is not None:
        write_partitioned(stamp_predictions(contributions, created), f"{path}/contributions", ["target_date"])
        tables["contributions"] = spark.read.parquet(f"{path}/contributions")
        tables["top_contributions"] = top_contributions(tables["contributions"])
    return tables


def direct_run(model: PipelineModel, features: DataFrame, created: datetime, path: str, explain: bool = True) -> dict[str, DataFrame]:
    """A week-ahead scoring job: predict every row of ``scoring_features``, explain a linear model, write, summarise.

    A model input that the features lack raises. Rows in which the model finds no demand history stay out.
    """
    inputs = model_inputs(model)
    missing = feature_coverage(features.columns, inputs)["missing"]
    if missing:
        raise ValueError("missing features: " + ", ".join(missing))
    rows = settle(features.dropna(subset=[c for c in inputs if c.startswith("demand_")]))
    scored = predict(model, rows).select(
        "zone", "target_datetime", "forecast_horizon_hours", F.col("prediction_mw").alias("predicted_demand_mw")
    )
    parts = None
    if explain and hasattr(model.stages[-1], "coefficients"):
        parts = contributions(rows, *linear_parts(model))
    return write_predictions(scored, created, path, parts)


def recursive_run(
    model: PipelineModel, history: DataFrame, targets: DataFrame, ref: datetime, created: datetime, path: str, hours: int = 24
) -> dict[str, DataFrame]:
    """A day-ahead scoring job: hour by hour in one expression for linear models and trees, write, summarise."""
    if hasattr(model.stages[-1], "coefficients"):
        fill = {c: float(v) for c, v in medians_of(model).items()}
        scored = score_recursive(*linear_parts(model), history, targets, ref, hours, fill)
    else:
        scored = score_recursive_trees(forest_of(model), history, targets, ref, hours)
    return write_predictions(scored, created, path)
