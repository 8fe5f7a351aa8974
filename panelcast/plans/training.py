"""A whole training run: rows, split, fit, bands, metrics and backtest as one job."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.evaluation import fold_summary, interval_coverage, metrics, pinball
from panelcast.operators.modelling import backtest, predict, quantile_bands
from panelcast.operators.projection import training_view
from panelcast.operators.splits import downsample_issues, purged_split, require_no_leak, split_report, walk_forward_folds
from panelcast.session import settle

# Fewest issue times of a walk-forward run, and the quantiles of its bands.
LEAST_ISSUES = 100
QUANTILES = (0.1, 0.5, 0.9)
GROUP = ("zone", "forecast_horizon_hours")
Fit = Callable[[DataFrame], PipelineModel]


def _bands(qs: Iterable[float]) -> dict[str, float]:
    return {f"p{int(q * 100)}_mw": q for q in qs}


def require_issues(rows: DataFrame, least: int = LEAST_ISSUES, issue: str = "issue_datetime") -> DataFrame:
    """Raise if the rows have too few issue times for folds; at most ``least`` of them are counted."""
    found = rows.select(issue).where(F.col(issue).isNotNull()).distinct().limit(least).count()
    if found < least:
        raise ValueError(f"{found} issue times; a walk-forward run needs {least}")
    return rows


def training_rows(gold: DataFrame, y: str = "target_demand_mw", stride: int | None = None, origin: str = "2020-01-01") -> DataFrame:
    """Rows of a gold table fit for training, of all issues or of the first one of a day every ``stride`` days."""
    rows = training_view(gold).dropna(subset=["zone", "issue_datetime", "target_datetime", "forecast_horizon_hours", y])
    return downsample_issues(rows, stride, origin) if stride else rows


def train(
    rows: DataFrame,
    fit: Fit,
    y: str = "target_demand_mw",
    days: int = 30,
    qs: Iterable[float] = QUANTILES,
    by: Iterable[str] = GROUP,
    least_issues: int = LEAST_ISSUES,
) -> tuple[PipelineModel, dict[str, DataFrame]]:
    """The model of a run, and its tables by name.

    The last ``days`` are the test set, those before them validation; a purge keeps targets out of later sets. A model
    of the training rows gives the residuals of validation, whose quantiles per group of ``by`` are the bands; the
    model that is returned is then fitted on both sets and judged on the test set. All tables rest on one split,
    which is written once.
    """
    by, qs = list(by), list(qs)
    split = settle(purged_split(require_issues(rows, least_issues), days=days))
    require_no_leak(split)
    sets = {name: split.filter(F.col("split") == name).drop("split") for name in ("train", "validation", "test")}
    calibration = predict(fit(sets["train"]), sets["validation"])
    model = fit(sets["train"].unionByName(sets["validation"]))
    scored = settle(quantile_bands(calibration, predict(model, sets["test"]), y, "prediction_mw", by, qs))
    bands = _bands(qs)
    low, high = min(bands, key=bands.get), max(bands, key=bands.get)
    return model, {
        "split": split_report(split),
        "predictions": scored,
        "metrics": metrics(scored, y, "prediction_mw"),
        "metrics_by_zone": metrics(scored, y, "prediction_mw", "zone"),
        "metrics_by_horizon": metrics(scored, y, "prediction_mw", "forecast_horizon_hours"),
        "metrics_by_zone_and_horizon": metrics(scored, y, "prediction_mw", ["zone", "forecast_horizon_hours"]),
        "pinball": pinball(scored, y, bands),
        "coverage": interval_coverage(scored, y, low, high),
    }


def backtest_report(
    rows: DataFrame,
    fit: Fit,
    y: str = "target_demand_mw",
    k: int = 5,
    days: int = 30,
    qs: Iterable[float] = QUANTILES,
    by: Iterable[str] = GROUP,
    least_issues: int = LEAST_ISSUES,
    purge: bool = True,
) -> dict[str, DataFrame]:
    """``folds``: bounds, rows and metrics of each fold; ``predictions`` of all; ``summary`` over the folds.

    The last fold has bands besides, from the residuals of the folds before it, with their pinball losses and coverage
    in its row; without folds before it these are null.
    """
    by, bands = list(by), _bands(qs)
    predictions = settle(backtest(require_issues(rows, least_issues), fit, k, days, purge))
    last = predictions.agg(F.max("fold")).first()[0]
    earlier, newest = predictions.filter(F.col("fold") < last), predictions.filter(F.col("fold") == last)
    banded = settle(quantile_bands(earlier, newest, y, "prediction_mw", by, qs))
    low, high = min(bands, key=bands.get), max(bands, key=bands.get)
    in_band = interval_coverage(banded.dropna(subset=[low, high]), y, low, high)
    judged = pinball(banded, y, bands).crossJoin(in_band).withColumn("fold", F.lit(last))  # one row each
    folds = walk_forward_folds(rows, k, days)
    found = folds.join(metrics(predictions, y, "prediction_mw", "fold"), "fold").join(judged, "fold", "left")
    return {
        "predictions": earlier.unionByName(banded, allowMissingColumns=True),
        "folds": found,
        "summary": fold_summary(metrics(predictions, y, "prediction_mw", "fold")),
    }
