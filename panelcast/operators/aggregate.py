"""Weighted zones, samples, correlations and summary statistics."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators.blocks import as_keys
from panelcast.operators.gram import Gram, gram
from panelcast.operators.ranking import rank_average, top_n_per_group
from panelcast.session import settle

# Reference weather zones (name, latitude, longitude, weight, city).
WEATHER_ZONES = [
    ("toronto", 43.70, -79.42, 0.25, "Toronto"),
    ("ottawa", 45.42, -75.69, 0.15, "Ottawa"),
    ("west", 43.45, -80.49, 0.15, "Kitchener-Waterloo"),
    ("southwest", 42.98, -81.23, 0.10, "London"),
    ("east", 44.23, -76.49, 0.08, "Kingston"),
    ("niagara", 43.09, -79.07, 0.10, "Niagara Falls"),
    ("northeast", 46.49, -80.99, 0.07, "Sudbury"),
    ("northwest", 48.38, -89.25, 0.05, "Thunder Bay"),
    ("bruce", 44.33, -81.60, 0.03, "Bruce Peninsula"),
    ("essa", 44.27, -79.78, 0.02, "Barrie"),
]
ZONE_SCHEMA = "name string, latitude double, longitude double, weight double, city string"


def zone_dimension(spark, zones=WEATHER_ZONES) -> DataFrame:
    return spark.createDataFrame(zones, ZONE_SCHEMA)


def mean_zone(df: DataFrame, ts: str, columns: Iterable[str], label: str, key: str = "zone", first: Iterable[str] = ()) -> DataFrame:
    """The panel plus a synthetic zone: the plain mean over zones per time.

    ``first`` columns take the value of the alphabetically first zone that has one.
    """
    picks = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(key))).alias(c) for c in first]
    total = df.groupBy(ts).agg(*[F.avg(c).alias(c) for c in columns], *picks)
    return df.unionByName(total.withColumn(key, F.lit(label)), allowMissingColumns=True)


def _weights_column(weights: dict[str, float], key: str):
    pairs = [F.lit(x) for pair in weights.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.col(key))


def weighted_zone(
    df: DataFrame,
    group,
    columns: Iterable[str],
    weights: dict[str, float],
    label: str,
    key: str = "zone",
    passthrough: Iterable[str] = (),
) -> DataFrame:
    """Synthetic zone: weighted mean per group, weights renormalised over the values present.

    The weights are a literal map, so there is no join. Zones without a weight do not take part.
    """
    known = df.withColumn("_w", _weights_column(weights, key)).filter(F.col("_w").isNotNull())
    means = []
    for c in columns:
        present = F.when(F.col(c).isNotNull(), F.col("_w"))
        means.append(F.try_divide(F.sum(F.col("_w") * F.col(c)), F.sum(present)).alias(c))
    picks = [F.min_by(c, key).alias(c) for c in passthrough]
    return known.groupBy(*as_keys(group)).agg(*means, *picks).withColumn(key, F.lit(label))


def weighted_sum(df: DataFrame, group, columns: Iterable[str], weights: dict[str, float], key: str = "zone") -> DataFrame:
    """Weighted sum per group without renormalising; one missing value makes the sum missing."""
    known = df.withColumn("_w", _weights_column(weights, key)).filter(F.col("_w").isNotNull())
    sums = [
        F.when(F.count_if(F.col(c).isNull()) == 0, F.sum(F.col("_w") * F.col(c))).alias(f"weighted_{c}")
        for c in columns
    ]
    return known.groupBy(*as_keys(group)).agg(*sums)


def check_weights(zones: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Sum of the weights, whether it is close to one, and the weighted centroid."""
    w = F.col("weight")
    return zones.agg(
        F.sum(w).alias("total_weight"),
        (F.abs(F.sum(w) - 1.0) < tolerance).cast("int").alias("is_valid"),
        F.sum(F.col("latitude") * w).alias("latitude"),
        F.sum(F.col("longitude") * w).alias("longitude"),
    )


def _drawn(key, seed: int) -> Column:
    """Hexadecimal digits that any engine computes alike from the seed and the texts of the key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in as_keys(key)]).cast("binary"))


def sample(df: DataFrame, fraction: float, key, seed: int = 42) -> DataFrame:
    """Bernoulli sample that a rerun, here or in another engine, repeats exactly: membership is the MD5 of the key.

    A row is drawn where the first 32 bits lie below the ``fraction`` of their range.
    """
    if fraction >= 1:
        return df
    bound = f"{int(max(fraction, 0.0) * 2**32):08x}"
    return df.filter(F.substring(_drawn(key, seed), 1, 8) < bound)


def sample_n(df: DataFrame, n: int, key, seed: int = 42) -> DataFrame:
    """n rows in the order of the MD5 of the key; each task keeps n rows, no full sort.

    A sample repeats only where the key tells all rows apart.
    """
    return df.orderBy(_drawn(key, seed), *as_keys(key)).limit(n)


def complete_gram(df: DataFrame, columns: Iterable[str]) -> Gram:
    """Means and products over the rows in which every column has a value."""
    columns = list(dict.fromkeys(columns))
    return gram(df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna(), columns)


def target_correlations(g: Gram, features: Iterable[str], y: str) -> dict[str, float | None]:
    """Absolute correlation of each feature with the target; none for a constant."""
    found = np.abs(g.correlations()[g.names.index(y)])
    return {f: None if np.isnan(found[k]) else float(found[k]) for f, k in zip(features, g.at(features))}


def corr_with_target(df: DataFrame, features: Iterable[str], y: str, threshold: float = 0.05) -> DataFrame:
    """Absolute correlation of each feature with the target on complete rows."""
    features = list(features)
    found = target_correlations(complete_gram(df, [*features, y]), features, y)
    long = df.sparkSession.createDataFrame(list(found.items()), "feature string, correlation double")
    return long.withColumn("is_low", (F.col("correlation") < threshold).cast("int"))


def collinear_pairs(df: DataFrame, features: Iterable[str], threshold: float = 0.9) -> DataFrame:
    """Feature pairs whose absolute correlation on complete rows exceeds the threshold.

    One cell per pair of features reaches the driver, however many rows there are.
    """
    g = complete_gram(df, features)
    found = np.abs(g.correlations())
    pairs = [(a, b, float(found[i, j])) for (i, a), (j, b) in combinations(enumerate(g.names), 2) if found[i, j] > threshold]
    return df.sparkSession.createDataFrame(pairs, "feature_1 string, feature_2 string, correlation double")


def combined_rank(scores: DataFrame, a: str = "correlation", b: str = "importance") -> DataFrame:
    """Mean of two descending average ranks; a missing score ranks as zero."""
    filled = settle(scores.fillna(0.0, [a, b]))
    ranked = rank_average(rank_average(filled, a, "corr_rank", stable=True), b, "imp_rank", stable=True)
    return ranked.withColumn("avg_rank", (F.col("corr_rank") + F.col("imp_rank")) / 2.0)


def quotas(groups: dict[str, list[str]]) -> dict[str, int]:
    """How many features each group may keep."""
    # Quotas by group; every other group keeps half, at least two.
    fixed = {"lag": 5, "rolling": 4, "temporal_cyclic": 6}
    out = {}
    for name, members in groups.items():
        out[name] = len(members) if name == "weather" else fixed.get(name, max(2, len(members) // 2))
    return out


def select_features(scores: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Best-ranked features of each group up to the group's quota."""
    group_of = {f: g for g, members in groups.items() for f in members}
    pairs = [F.lit(x) for pair in group_of.items() for x in pair]
    tagged = scores.withColumn("feature_group", F.try_element_at(F.create_map(*pairs), F.col("feature")))
    return top_n_per_group(
        tagged.filter(F.col("feature_group").isNotNull()),
        "feature_group",
        [F.col("avg_rank").asc(), F.col("feature").asc()],
        quotas(groups),
    )


def prediction_stats(df: DataFrame, by, y: str = "predicted_demand_mw", ts: str = "target_datetime", horizon: str | None = None) -> DataFrame:
    """Rounded statistics of predictions per zone or forecast day."""
    parts = [
        F.count(F.lit(1)).alias("total_predictions"),
        F.round(F.avg(y), 1).alias("avg_demand_mw"),
        F.round(F.stddev_samp(y), 1).alias("std_demand_mw"),
        F.round(F.min(y), 1).alias("min_demand_mw"),
        F.round(F.max(y), 1).alias("max_demand_mw"),
        F.min(ts).alias("first_target"),
        F.max(ts).alias("last_target"),
    ]
    if horizon:
        parts += [F.min(horizon).alias("min_horizon"), F.max(horizon).alias("max_horizon")]
    return df.groupBy(*as_keys(by)).agg(*parts)


def top_contributions(df: DataFrame, n: int = 10, value: str = "shap_value", name: str = "feature_name") -> DataFrame:
    """Features with the largest mean absolute contribution."""
    return (
        df.groupBy(name)
        .agg(
            F.round(F.avg(F.abs(F.col(value))), 4).alias("avg_abs_shap"),
            F.round(F.avg(value), 4).alias("avg_shap"),
        )
        .orderBy(F.desc("avg_abs_shap"), name)
        .limit(n)
    )


def distinct_counts(df: DataFrame, columns: Iterable[str], by=()) -> DataFrame:
    parts = [F.count_distinct(c).alias(f"distinct_{c}") for c in columns]
    return df.groupBy(*as_keys(by)).agg(*parts) if by else df.agg(*parts)


