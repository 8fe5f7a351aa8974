"""Forecast quality: metrics, distributions, comparisons, reconciliation.

Metrics are sums and counts under one partial aggregate, so a zone or horizon that holds most of
the rows is reduced before any shuffle. A percentage error needs ``|actual| > 1e-6``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators.blocks import as_keys
from panelcast.operators.joins import attach_one_row
from panelcast.operators.ranking import percentiles
from panelcast.session import settle

TINY = 1e-6
CHECKPOINTS = [1, 6, 12, 24, 48, 72, 96, 120, 144, 168]
# Fixed values: (excellent below, acceptable below) in MAPE percent per model.
MAPE_TARGETS = {"24h": (2.0, 2.5), "7d": (3.5, 4.0)}
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def finite_pairs(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Rows where actual and prediction are both finite numbers."""
    return df.filter(_finite(y) & _finite(yhat))


def _finite(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < F.lit(float("inf")))


def _pct_error(y: Column, yhat: Column) -> Column:
    return F.when(F.abs(y) > TINY, F.abs(y - yhat) / F.abs(y) * 100.0)


def _r2(y: Column, yhat: Column) -> Column:
    total = F.var_pop(y) * F.count(y)
    residual = F.sum((y - yhat) * (y - yhat))
    flat = F.when(residual == 0, 1.0).otherwise(0.0)
    return F.when(F.count(y) >= 2, F.when(total == 0, flat).otherwise(1.0 - residual / total))


def metric_columns(y: str, yhat: str, prefix: str = "") -> list[Column]:
    a, p = F.col(y), F.col(yhat)
    error, scale = F.abs(a - p), F.abs(a) + F.abs(p)
    total = F.sum(F.abs(a))
    return [
        value.alias(prefix + name)
        for name, value in {
            "observations": F.count(a),
            "mae": F.avg(error),
            "rmse": F.sqrt(F.avg(error * error)),
            "r2": _r2(a, p),
            "mape": F.avg(_pct_error(a, p)),
            "smape": F.avg(F.when(scale > TINY, 2.0 * error / scale * 100.0)),
            "wape": F.when(total > TINY, F.sum(error) / total * 100.0),
            "bias": F.avg(p - a),
        }.items()
    ]


def metrics(df: DataFrame, y: str, yhat: str, by=()) -> DataFrame:
    """MAE, RMSE, R2, MAPE, sMAPE, WAPE and bias, overall or per group."""
    pairs = finite_pairs(df, y, yhat)
    return pairs.groupBy(*as_keys(by)).agg(*metric_columns(y, yhat))


ERROR_SHARES = {f"error_q{p}": p / 100.0 for p in (25, 50, 75, 90, 95, 99)}


def metrics_full(df: DataFrame, y: str, yhat: str, by=()) -> DataFrame:
    """The monitoring metric set: errors, bias, coverage bands, error percentiles, moments."""
    keys = as_keys(by)
    pairs = settle(finite_pairs(df, y, yhat).select(*keys, y, yhat))
    a, p = F.col(y), F.col(yhat)
    off = F.abs(F.try_divide(p - a, a)) * 100.0
    bands = [
        (F.avg(F.when(off <= band, 1.0).otherwise(0.0)) * 100.0).alias(f"coverage_{band}pct")
        for band in (1, 2, 5, 10)
    ]
    core = pairs.groupBy(*keys).agg(
        F.avg(F.abs(p - a)).alias("mae"),
        F.sqrt(F.avg((p - a) * (p - a))).alias("rmse"),
        F.avg(_pct_error(a, p)).alias("mape"),
        _r2(a, p).alias("r2"),
        F.avg(p - a).alias("bias_mw"),
        (F.try_divide(F.avg(p - a), F.avg(a)) * 100.0).alias("bias_pct"),
        *bands,
        F.count(F.lit(1)).alias("n_samples"),
        F.avg(a).alias("mean_actual"),
        F.stddev_samp(a).alias("std_actual"),
        F.avg(p).alias("mean_pred"),
        F.stddev_samp(p).alias("std_pred"),
    )
    spread = percentiles(pairs.withColumn("_error", F.abs(p - a)), "_error", ERROR_SHARES, keys, stable=True)
    return core.join(spread, keys, "left") if keys else attach_one_row(core, spread)


def metrics_by_time(df: DataFrame, y: str, yhat: str, ts: str = "target_datetime") -> DataFrame:
    """Metrics by hour, by weekday and by day type, stacked under a dimension tag.

    Grouping sets read the rows once. Relative bias is given by hour only.
    """
    a, p = F.col(y), F.col(yhat)
    weekday = F.weekday(ts)
    parts = finite_pairs(df, y, yhat).select(
        y,
        yhat,
        F.hour(ts).alias("hour"),
        weekday.alias("day_of_week"),
        F.when(weekday >= 5, "Weekend").otherwise("Weekday").alias("day_type"),
    )
    dimensions = ["hour", "day_of_week", "day_type"]
    stacked = parts.groupingSets([[F.col(d)] for d in dimensions], *dimensions).agg(
        # one bit per dimension that a row is not grouped by
        F.grouping_id(*dimensions).alias("_set"),
        F.avg(_pct_error(a, p)).alias("mape"),
        F.avg(F.abs(p - a)).alias("mae"),
        F.sqrt(F.avg((p - a) * (p - a))).alias("rmse"),
        F.avg(a).alias("avg_demand"),
        F.count(F.lit(1)).alias("n_samples"),
        (F.try_divide(F.avg(p - a), F.avg(a)) * 100.0).alias("_bias"),
    )
    names = F.array(*[F.lit(n) for n in WEEKDAYS])
    dimension = F.when(F.col("_set") == 3, "hour").when(F.col("_set") == 5, "day_of_week").otherwise("day_type")
    return (
        stacked.withColumns(
            {
                "time_dimension": dimension,
                "day_name": F.when(F.col("day_of_week").isNotNull(), names[F.col("day_of_week")]),
                "bias_pct": F.when(F.col("_set") == 3, F.col("_bias")),
            }
        )
        .drop("_set", "_bias")
    )


def metrics_by_horizon(
    df: DataFrame, y: str, yhat: str, points: Iterable[int] = CHECKPOINTS, horizon: str = "forecast_horizon_hours"
) -> DataFrame:
    """Metrics at the checkpoint horizons that occur."""
    at = finite_pairs(df.filter(F.col(horizon).isin(list(points))), y, yhat)
    a, p = F.col(y), F.col(yhat)
    out = at.groupBy(F.col(horizon).alias("horizon_hours")).agg(
        F.avg(_pct_error(a, p)).alias("mape"),
        F.avg(F.abs(p - a)).alias("mae"),
        F.sqrt(F.avg((p - a) * (p - a))).alias("rmse"),
        (F.try_divide(F.avg(p - a), F.avg(a)) * 100.0).alias("bias_pct"),
        _r2(a, p).alias("r2"),
        F.avg(a).alias("avg_demand"),
        F.count(F.lit(1)).alias("n_samples"),
    )
    return out.withColumn("horizon_label", F.concat(F.lit("H+"), F.col("horizon_hours").cast("string")))


def degradation(df: DataFrame, x: str, m: str) -> DataFrame:
    """How a metric grows along x: first and last value, difference, linear trend and its fit."""
    ends = df.agg(
        F.min_by(m, x).alias("first_value"),
        F.max_by(m, x).alias("last_value"),
        F.regr_slope(m, x).alias("slope"),
        F.regr_r2(m, x).alias("trend_r2"),
    )
    change = F.col("last_value") - F.col("first_value")
    return ends.withColumns(
        {
            "degradation": change,
            "degradation_pct": F.try_divide(change, F.col("first_value")) * 100.0,
        }
    )


DISTRIBUTION_SHARES = {f"error_q{p:02d}": p / 100.0 for p in (1, 5, 10, 25, 50, 75, 90, 95, 99)}


def error_distribution(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Moments and percentiles of signed, absolute and relative errors."""
    a, p = F.col(y), F.col(yhat)
    settled = settle(finite_pairs(df, y, yhat).select(y, yhat))
    pairs = settled.withColumns({"_error": p - a, "_abs": F.abs(p - a)})
    relative = F.try_divide(F.col("_error"), a) * 100.0
    core = pairs.agg(
        F.avg("_error").alias("error_mean"),
        F.stddev_samp("_error").alias("error_std"),
        F.avg("_abs").alias("error_abs_mean"),
        F.avg(relative).alias("error_pct_mean"),
        F.stddev_samp(relative).alias("error_pct_std"),
    )
    signed = percentiles(pairs, "_error", {"error_median": 0.5}, stable=True)
    absolute = percentiles(pairs, "_abs", {**DISTRIBUTION_SHARES, "error_abs_median": 0.5}, stable=True)
    return attach_one_row(attach_one_row(core, signed), absolute)


def row_errors(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Signed, absolute and percentage error of each row."""
    a, p = F.col(y), F.col(yhat)
    return df.withColumns(
        {
            "error_mw": p - a,
            "absolute_error_mw": F.abs(p - a),
            "absolute_percentage_error": _pct_error(a, p),
        }
    )


def pinball(df: DataFrame, y: str, quantiles: dict[str, float], by=()) -> DataFrame:
    """Mean pinball loss of each quantile column."""
    losses = []
    for column, q in quantiles.items():
        d = F.col(y) - F.col(column)
        loss = F.when(d.isNotNull(), F.greatest(q * d, (q - 1.0) * d))
        losses.append(F.avg(loss).alias(f"pinball_{column}"))
    return df.groupBy(*as_keys(by)).agg(*losses)


def interval_coverage(df: DataFrame, y: str, lo: str, hi: str, by=()) -> DataFrame:
    """Share of actuals inside the band and the mean width of the band."""
    inside = F.when(F.col(y).between(F.col(lo), F.col(hi)), 1.0).otherwise(0.0)
    return df.groupBy(*as_keys(by)).agg(
        (F.avg(inside) * 100.0).alias("coverage_pct"), F.avg(F.col(hi) - F.col(lo)).alias("mean_width")
    )


def compare_baselines(df: DataFrame, y: str, models: Iterable[str]) -> DataFrame:
    """Metrics of several prediction columns side by side, best WAPE first."""
    models = list(models)
    long = df.select(y, *models).unpivot([y], models, "model", "_prediction")
    return metrics(long, y, "_prediction", "model").orderBy("wape", "model")


def reconcile_bottom_up(
    df: DataFrame,
    y: str,
    yhat: str,
    total_label: str,
    key="zone",
    bands: tuple[str, str] | None = None,
    at=("issue_datetime", "target_datetime"),
) -> DataFrame:
    """Zone sums beside the directly forecast total, one row per issue and target that has both.

    Both sides come from one conditional aggregate, so there is no join.
    """
    is_total = F.col(key) == total_label
    zonal = {y: "bottomup_actual_mw", yhat: "bottomup_predicted_mw"}
    if bands:
        zonal |= {bands[0]: "bottomup_lo_mw", bands[1]: "bottomup_hi_mw"}
    direct = {y: "direct_actual_mw", yhat: "direct_predicted_mw"}
    both = df.groupBy(*at).agg(
        *[F.sum(F.when(~is_total, F.col(c))).alias(name) for c, name in zonal.items()],
        *[F.min(F.when(is_total, F.col(c))).alias(name) for c, name in direct.items()],
        F.count_if(is_total).alias("_totals"),
        F.count_if(~is_total).alias("_zones"),
    )
    return both.filter("_totals > 0 AND _zones > 0").drop("_totals", "_zones")


def coherence(reconciled: DataFrame) -> DataFrame:
    """Mean gap between zone sums and direct total, with the metrics of both."""
    gap = F.abs(F.col("bottomup_actual_mw") - F.col("direct_actual_mw"))
    head = [F.avg(gap).alias("coherence_gap_mw")]
    if "bottomup_lo_mw" in reconciled.columns:
        inside = F.col("bottomup_actual_mw").between(F.col("bottomup_lo_mw"), F.col("bottomup_hi_mw"))
        head.append((F.avg(F.when(inside, 1.0).otherwise(0.0)) * 100.0).alias("bottomup_coverage_pct"))
    pairs, named = reconciled, []
    for side in ("bottomup", "direct"):
        # a side without both numbers takes no part in its metrics, but stays for the other side
        y, yhat = f"{side}_actual_mw", f"{side}_predicted_mw"
        whole = _finite(y) & _finite(yhat)
        pairs = pairs.withColumns({f"_{side}_y": F.when(whole, F.col(y)), f"_{side}_p": F.when(whole, F.col(yhat))})
        named += metric_columns(f"_{side}_y", f"_{side}_p", prefix=f"{side}_")
    return pairs.agg(*head, *named)


def verdict(df: DataFrame, targets: dict[str, tuple[float, float]] = MAPE_TARGETS, model: str = "model_type") -> DataFrame:
    """Rating of each model's MAPE against its targets and class of its relative bias."""
    rating = F.lit(None).cast("string")
    for name, (good, fair) in targets.items():
        graded = F.when(F.col("mape") < good, "excellent").when(F.col("mape") < fair, "acceptable")
        rating = F.when(F.col(model) == name, graded.otherwise("insufficient")).otherwise(rating)
    size = F.abs(F.col("bias_pct"))
    bias = F.when(size < 0.5, "negligible").when(size < 1.0, "slight").otherwise("significant")
    return df.withColumns({"verdict": rating, "bias_class": bias})


def day_stats(df: DataFrame, m: str = "mape", target: float = 3.5) -> DataFrame:
    """Mean, median, deviation and coefficient of variation over days, and days under target."""
    core = df.agg(
        F.avg(m).alias("mean"),
        F.stddev_samp(m).alias("std"),
        F.count_if(F.col(m) < target).alias("days_under_target"),
        F.count(F.lit(1)).alias("days"),
    ).withColumn("variation_pct", F.try_divide(F.col("std"), F.col("mean")) * 100.0)
    return attach_one_row(core, percentiles(df, m, {"median": 0.5}))


def fold_summary(df: DataFrame, names: Iterable[str] = ("wape", "mae", "rmse", "mape")) -> DataFrame:
    """Mean and deviation of metrics across backtest folds."""
    parts = [F.count(F.lit(1)).alias("folds")]
    for m in names:
        parts += [F.avg(m).alias(f"{m}_mean"), F.stddev_samp(m).alias(f"{m}_std")]
    return df.agg(*parts)


def latest_issue_profile(
    df: DataFrame, y: str, yhat: str, issue: str = "issue_datetime", target: str = "target_datetime"
) -> DataFrame:
    """Total actual and predicted value per target hour of the newest issue."""
    last = df.agg(F.max(issue).alias("_last"))
    newest = attach_one_row(df, last).filter(F.col(issue) == F.col("_last"))
    return newest.groupBy(target).agg(
        F.sum(y).alias("actual_demand_mw"), F.sum(yhat).alias("predicted_demand_mw")
    )


def minmax(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Columns rescaled to 0..1 over their range, as ``name_norm``."""
    columns = list(columns)
    ends = df.agg(
        *[F.min(c).alias(f"_min_{c}") for c in columns], *[F.max(c).alias(f"_max_{c}") for c in columns]
    )
    scaled = {
        f"{c}_norm": F.try_divide(F.col(c) - F.col(f"_min_{c}"), F.col(f"_max_{c}") - F.col(f"_min_{c}"))
        for c in columns
    }
    return attach_one_row(df, ends).withColumns(scaled).drop(*ends.columns)
