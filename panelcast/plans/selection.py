"""Feature selection: correlation, importance, collinearity, quotas per group, number of features."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.aggregate import combined_rank, corr_with_target, sample, select_features, target_correlations
from panelcast.operators.evaluation import metrics
from panelcast.operators.gram import gram, nested_fits
from panelcast.operators.modelling import MANDATORY_FEATURES, feature_importance, fit_point, keep_mandatory, predict
from panelcast.session import settle

# The candidate features by group.
FEATURE_GROUPS = {
    "temporal_cyclic": [
        "issue_hour_sin", "issue_hour_cos", "target_day_of_week_sin", "target_day_of_week_cos",
        "target_month_sin", "target_month_cos", "target_day_of_year_sin", "target_day_of_year_cos",
    ],
    "temporal_categorical": [
        "issue_hour", "target_day_of_week", "target_day_of_year", "target_is_weekend",
        "target_time_morning", "target_time_afternoon", "target_time_evening", "target_time_night",
    ],
    "weather": [
        "temperature_c", "dew_point_c", "relative_humidity_pct", "wind_speed_kmh", "precipitation_mm",
        "weather_target_hdd18", "weather_target_cdd18",
    ],
    "lag": [
        "demand_lag_1h", "demand_lag_2h", "demand_lag_3h", "demand_lag_6h",
        "demand_lag_12h", "demand_lag_24h", "demand_lag_48h", "demand_lag_168h",
    ],
    "rolling": [
        "demand_rolling_mean_6h", "demand_rolling_mean_12h", "demand_rolling_mean_24h",
        "demand_rolling_mean_168h", "demand_rolling_std_24h", "demand_rolling_std_168h",
    ],
    "calendar": ["is_holiday", "is_day_before_holiday", "is_day_after_holiday"],
}
ALL_FEATURES = [f for members in FEATURE_GROUPS.values() for f in members]


def score_features(gold: DataFrame, features=None, fraction: float | None = None, y: str = "target_demand_mw") -> DataFrame:
    """Correlation and model gain of each feature, with their combined rank.

    All rows take part unless a sampling ``fraction`` is asked for.
    """
    features = list(features or ALL_FEATURES)
    rows = gold.filter(gold[y].isNotNull()).select("zone", "issue_datetime", *features, y)
    if fraction:
        rows = sample(rows, fraction, ["zone", "issue_datetime"])
    complete = settle(rows.dropna(subset=[*features, y]))
    correlation = corr_with_target(complete, features, y)
    if complete.isEmpty():  # nothing to learn from: every feature scores alike
        gains = complete.sparkSession.createDataFrame([], "feature string, importance double")
    else:
        found = feature_importance(fit_point(complete, features, y, settled=True), complete)
        gains = found.selectExpr("feature", "gain AS importance")
    scores = correlation.join(gains, "feature", "left")
    return combined_rank(scores)


def selected_features(gold: DataFrame, groups=None, **options) -> DataFrame:
    groups = groups or FEATURE_GROUPS
    members = [f for g in groups.values() for f in g]
    return select_features(score_features(gold, members, **options), groups)


def by_correlation(train: DataFrame, features: Iterable[str], y: str = "target_demand_mw") -> list[str]:
    """Features by their absolute correlation with the target, the greatest first; constants are left out."""
    features = list(features)
    known = train.filter(train[y].isNotNull())
    found = target_correlations(gram(known, [*features, y]), features, y)
    return sorted((f for f in features if found[f] is not None), key=lambda f: (-round(found[f], 9), f))


def feature_sets(ranked: list[str], counts: Iterable[int], available: Iterable[str]) -> dict[int, list[str]]:
    """Per number of features: the best so many and the mandatory ones. Numbers beyond the ranked are left out."""
    tried = sorted({n for n in counts if n <= len(ranked)} | {len(ranked)})
    return {n: keep_mandatory(ranked, n, available) for n in tried}


def compare_feature_counts(
    train: DataFrame,
    validation: DataFrame,
    ranked: Iterable[str],
    counts: Iterable[int],
    y: str = "target_demand_mw",
    available: Iterable[str] | None = None,
    key: str = "zone",
) -> DataFrame:
    """Validation metrics of a linear model per number of features, one row for each number.

    A number n stands for the best n features of ``ranked`` and the mandatory ones of ``available`` (all columns of the
    training rows by default); all ranked features together are always tried. The training rows are read for one set of
    products, from which every model is solved; the validation rows are read once for all models. Missing inputs are
    filled by their mean in training, the series counts by its alphabetical number. ``choose_features`` picks from the
    result.
    """
    ranked, available = list(ranked), list(available or train.columns)
    sets = feature_sets(ranked, counts, available)
    # the mandatory features come first, so that every set is the beginning of one order
    always = [f for f in MANDATORY_FEATURES if f in set(available)]
    order = [*always, *[f for f in ranked if f not in always]]
    known = train.filter(train[y].isNotNull())
    if key in order and dict(train.dtypes)[key] == "string":
        indexer = StringIndexer(inputCol=key, outputCol="_key", stringOrderType="alphabetAsc", handleInvalid="keep").fit(known)
        known, validation = (indexer.transform(rows).drop(key).withColumnRenamed("_key", key) for rows in (known, validation))
    sizes = {n: len(features) for n, features in sets.items()}
    fits = nested_fits(gram(known, [*order, y]), y, order, set(sizes.values()))
    tries = [
        F.struct(
            F.lit(n).alias("requested_feature_count"),
            F.lit(size).alias("actual_feature_count"),
            fits[size].prediction().alias("prediction_mw"),
        )
        for n, size in sizes.items()
    ]
    scored = validation.select(F.col(y).alias("_y"), F.inline(F.array(*tries)))
    return metrics(scored, "_y", "prediction_mw", ["requested_feature_count", "actual_feature_count"])


def compare_fitted_counts(
    train: DataFrame,
    validation: DataFrame,
    ranked: Iterable[str],
    counts: Iterable[int],
    fit: Callable[[DataFrame, list[str]], PipelineModel],
    y: str = "target_demand_mw",
    available: Iterable[str] | None = None,
) -> DataFrame:
    """The same for any model: ``fit`` is called once per number of features, on settled training rows."""
    sets = feature_sets(list(ranked), counts, list(available or train.columns))
    train, validation = settle(train), settle(validation)
    results = []
    for n, features in sets.items():
        scored = predict(fit(train, features), validation)
        sizes = {"requested_feature_count": F.lit(n), "actual_feature_count": F.lit(len(features))}
        results.append(metrics(scored, y, "prediction_mw").withColumns(sizes))
    return reduce(DataFrame.unionByName, results)
