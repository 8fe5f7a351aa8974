"""Forecast models on pyspark.ml, scoring, contributions, quantile bands and backtests."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalars import horizon_features
from panelcast.functions.timecols import horizon_hours
from panelcast.operators.evaluation import metrics
from panelcast.operators.joins import attach, attach_one_row
from panelcast.operators.quality import feature_coverage
from panelcast.operators.ranking import cumulative_share, percentiles
from panelcast.operators.splits import with_folds
from panelcast.schemas import require_columns
from panelcast.session import settle

# Inputs that feature selection always keeps.
MANDATORY_FEATURES = [
    "zone", "forecast_horizon_hours", "forecast_day", "forecast_hour_in_day",
    "forecast_horizon_sqrt", "forecast_horizon_log1p",
    "forecast_horizon_sin_24h", "forecast_horizon_cos_24h",
    "forecast_horizon_sin_168h", "forecast_horizon_cos_168h",
    "target_hour_sin", "target_hour_cos",
    "target_day_of_week_sin", "target_day_of_week_cos",
    "target_day_of_year_sin", "target_day_of_year_cos",
    "target_is_weekend",
]
# Columns that would leak the target or only identify the row.
NOT_CANDIDATES = {
    "target_demand_mw", "target_24h_ahead", "datetime", "issue_datetime", "target_datetime",
    "issue_date", "target_date", "date", "processed_time",
    "has_valid_features", "has_valid_target", "is_training_row", "demand_mw",
}


def candidate_features(columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c not in NOT_CANDIDATES]


def prepare_types(df: DataFrame, features: Iterable[str], y: str, key: str = "zone") -> DataFrame:
    """Inputs as doubles (flags included), the series as text, rows without key or target left out."""
    numbers = [f for f in features if f != key]
    kinds = dict(df.dtypes)

    def number(c):
        return F.col(c).cast("int").cast("double") if kinds[c] == "boolean" else F.col(c).try_cast("double")

    typed = df.withColumns({c: number(c) for c in [*numbers, y]}).withColumn(key, F.col(key).cast("string"))
    return typed.dropna(subset=[key, y])


def feature_stages(features: Iterable[str], key: str = "zone") -> list:
    """Index the series alphabetically, fill missing inputs with their median, assemble a vector."""
    features = list(features)
    numbers = [f for f in features if f != key]
    filled = [f"{f}__filled" for f in numbers]
    stages, inputs = [], list(filled)
    if key in features:
        indexer = StringIndexer(
            inputCol=key, outputCol=f"{key}__index", stringOrderType="alphabetAsc", handleInvalid="keep"
        )
        stages.append(indexer)
        inputs.append(f"{key}__index")
    # the approximate median is a mergeable sketch, one pass over the rows
    stages.append(Imputer(strategy="median", inputCols=numbers, outputCols=filled))
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return stages


def fit_point(
    df: DataFrame,
    features: Iterable[str],
    y: str,
    kind: str = "gbt",
    key: str = "zone",
    settled: bool = False,
    **params,
) -> PipelineModel:
    """Point forecast model; ``kind`` is ``gbt`` or ``linear``.

    Inputs that hold no value at all are left out, as no median exists for them. Fitting reads the
    rows several times, so they are settled first unless they already come from files.
    """
    features = list(features)
    df = df.select(*features, y)
    df = df if settled else settle(df)
    numbers = [f for f in features if f != key]
    known = df.agg(*[F.count(c).alias(c) for c in numbers]).first().asDict()
    features = [f for f in features if f == key or known[f] > 0]
    prepared = Pipeline(stages=feature_stages(features, key)).fit(df)
    if kind == "gbt":
        # trees need one bin per series level, the level for unknown series included
        levels = len(prepared.stages[0].labelsArray[0]) + 1 if key in features else 0
        settings = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "seed": 42, "maxBins": max(64, levels), **params}
        model = GBTRegressor(labelCol=y, featuresCol="features", predictionCol="prediction_mw", **settings)
    else:
        settings = {"regParam": 1e-6, "solver": "normal", **params}
        model = LinearRegression(labelCol=y, featuresCol="features", predictionCol="prediction_mw", **settings)
    fitted = model.fit(prepared.transform(df).select("features", y))
    return PipelineModel([*prepared.stages, fitted])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predictions beside the original columns."""
    return model.transform(df).select(*df.columns, "prediction_mw")


def model_inputs(model: PipelineModel) -> list[str]:
    return [c.removesuffix("__filled").removesuffix("__index") for c in model.stages[-2].getInputCols()]


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Gain per input with its share and running share, one row per input."""
    last = model.stages[-1]
    weights = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    rows = [(name, float(abs(v))) for name, v in zip(model_inputs(model), weights.toArray())]
    gains = df.sparkSession.createDataFrame(rows, "feature string, gain double")
    return cumulative_share(gains, "gain", ties=["feature"])


def choose_features(results: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """The candidate with the fewest features whose WAPE is within ``tolerance`` of the best."""
    best = results.agg(F.min("wape").alias("_best"))
    close = attach_one_row(results, best).filter(F.col("wape") <= F.col("_best") + tolerance)
    return close.drop("_best").orderBy("actual_feature_count", "wape", "mae").limit(1)


def keep_mandatory(ranked: list[str], count: int, available: Iterable[str]) -> list[str]:
    """The best ``count`` features plus the mandatory ones the data holds."""
    available = set(available)
    extra = [f for f in MANDATORY_FEATURES if f in available]
    return list(dict.fromkeys([*ranked[:count], *extra]))


def residual_quantiles(
    df: DataFrame, y: str, yhat: str, by=("zone", "forecast_horizon_hours"), qs=(0.1, 0.5, 0.9)
) -> DataFrame:
    """Residual quantiles per group from a calibration set."""
    errors = df.withColumn("_residual", F.col(y) - F.col(yhat))
    return percentiles(errors, "_residual", {f"r{int(q * 100)}": q for q in qs}, list(by))


def quantile_bands(
    calibration: DataFrame, df: DataFrame, y: str, yhat: str, by=("zone", "forecast_horizon_hours"), qs=(0.1, 0.5, 0.9)
) -> DataFrame:
    """Prediction plus residual quantiles of its group: p10, p50, p90 by default."""
    found = residual_quantiles(calibration, y, yhat, by, qs)
    out = attach(df, found, list(by))
    names = {f"p{int(q * 100)}_mw": F.col(yhat) + F.col(f"r{int(q * 100)}") for q in qs}
    return out.withColumns(names).drop(*[f"r{int(q * 100)}" for q in qs])


def linear_parts(model: PipelineModel) -> tuple[dict[str, float], float]:
    """Coefficients by input name and intercept of a fitted linear model."""
    linear = model.stages[-1]
    return dict(zip(model_inputs(model), (float(v) for v in linear.coefficients))), float(linear.intercept)


def contributions(
    df: DataFrame, coefficients: dict[str, float], intercept: float, means: DataFrame | None = None, ids=("zone", "target_datetime")
) -> DataFrame:
    """Additive contributions of a linear model, one row per prediction and feature.

    A feature contributes its coefficient times its distance from the mean; the base value is the
    prediction at the means, so contributions and base add up to the prediction. A missing input
    sits at the mean.
    """
    names = list(coefficients)
    require_columns(df, [*ids, *names])
    means = means if means is not None else df.agg(*[F.avg(c).alias(c) for c in names])
    mean_row = means.select(*[F.col(c).alias(f"_mean_{c}") for c in names])
    base = reduce(lambda acc, c: acc + F.lit(coefficients[c]) * F.col(f"_mean_{c}"), names, F.lit(intercept))
    parts = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature_name"),
                (
                    F.lit(coefficients[c])
                    * (F.coalesce(F.col(c).cast("double"), F.col(f"_mean_{c}")) - F.col(f"_mean_{c}"))
                ).alias("shap_value"),
            )
            for c in names
        ]
    )
    rows = attach_one_row(df.select(*ids, *names), mean_row)
    return rows.select(*ids, base.alias("base_value"), F.inline(parts))


def score_direct(
    model: PipelineModel,
    targets: DataFrame,
    features: DataFrame,
    ref: datetime,
    lo: int = 1,
    hi: int = 168,
    key: str = "zone",
) -> DataFrame:
    """One prediction per zone and horizon; demand features stay fixed at the reference time.

    Columns of ``features`` replace those of the same name among the targets. A model input that
    neither side holds raises.
    """
    fresh = [c for c in features.columns if c != key]
    horizon = horizon_hours(F.lit(ref), "target_datetime")
    scope = targets.drop(*fresh).withColumn("forecast_horizon_hours", horizon)
    scope = scope.filter(F.col("forecast_horizon_hours").between(lo, hi)).withColumns(horizon_features())
    rows = attach(scope, features, key)
    missing = feature_coverage(rows.columns, model_inputs(model))["missing"]
    if missing:
        raise ValueError("missing features: " + ", ".join(missing))
    return model.transform(rows).select(
        key, "target_datetime", "forecast_horizon_hours", F.col("prediction_mw").alias("predicted_demand_mw")
    )


def backtest(
    df: DataFrame,
    fit: Callable[[DataFrame], PipelineModel],
    k: int = 5,
    days: int = 30,
    purge: bool = True,
    issue: str = "issue_datetime",
    target: str = "target_datetime",
) -> DataFrame:
    """Refit before each fold, predict the fold, stack the predictions with the fold number.

    The loop runs over k models; each fit and each prediction is a distributed job. ``purge``
    drops training rows whose target reaches into the fold.
    """
    folded = settle(with_folds(df, k, days, issue))
    starts = {
        row.fold: row.start
        for row in folded.filter("fold > 0").groupBy("fold").agg(F.min(issue).alias("start")).collect()
    }
    parts = []
    for fold in sorted(starts):
        before = folded.filter(F.col("fold") < fold)
        if purge:
            before = before.filter(F.col(target) < F.lit(starts[fold]))
        if before.isEmpty():
            continue
        test = folded.filter(F.col("fold") == fold)
        parts.append(predict(fit(before.drop("fold")), test))
    if not parts:
        raise ValueError("no fold has rows before it")
    return reduce(DataFrame.unionByName, parts)


def backtest_metrics(predictions: DataFrame, y: str) -> DataFrame:
    return metrics(predictions, y, "prediction_mw", "fold")


def check_reload(model: PipelineModel, df: DataFrame, path: str) -> DataFrame:
    """Save, load, predict again: largest absolute difference between the two predictions."""
    model.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(model.transform(df).withColumnRenamed("prediction_mw", "_first").select(*df.columns, "_first"))
    gap = F.abs(F.col("_first") - F.col("prediction_mw"))
    return again.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.max(gap), F.lit(0.0)).alias("max_difference"))
