"""Recursive forecasts: each hour is predicted from features of the hours before it, predicted ones included.

The state of a series is one array: the demand of every hour from ``MEMORY`` hours before the reference time up to
the last hour known or predicted, null where none is. All features are expressions of that array. A linear model, and
a tree ensemble written as an expression, are folded over the hours inside one expression, so a series is one row from
start to end. Any other fitted model takes one distributed step per hour, over one row per series.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalars import pct_change, safe_ratio
from panelcast.operators.quality import dedup_any
from panelcast.operators.series import continuous_history, history_slice
from panelcast.operators.trees import Forest
from panelcast.session import settle

#: Hours before the reference time that features may look back on.
MEMORY = 388
# Hours of the demand features at scoring time.
LAGS = [1, 24, 48, 72, 144, 168, 336]
WINDOWS = [3, 6, 12, 24, 48, 72, 168]
CHANGES, RELATIVE_CHANGES, LEVELS = (1, 24, 168), (1, 24), (24, 168)


def _ago(state: Column, hours: int) -> Column:
    """Value ``hours`` before the end of the state."""
    return F.try_element_at(state, F.lit(-1 - hours))


def _statistics(state: Column, hours: int) -> dict[str, Column]:
    """Minimum, maximum, mean and sample deviation of the values in the last ``hours``."""
    held = F.filter(F.slice(state, -hours, hours), lambda v: v.isNotNull())
    n = F.size(held)

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)

    mean = F.when(n > 0, total(held) / n)
    squares = total(F.transform(held, lambda v: (v - mean) * (v - mean)))
    return {
        "min": F.array_min(held),
        "max": F.array_max(held),
        "mean": mean,
        "std": F.when(n > 1, F.sqrt(squares / (n - 1))),
    }


def state_features(state: Column) -> dict[str, Column]:
    """Demand features of the last hour of a state, by name; relative changes in percent."""
    now, day, week = _ago(state, 0), _ago(state, 24), _ago(state, 168)
    windows = {n: _statistics(state, n) for n in WINDOWS}
    named = {f"demand_lag_{n}h": _ago(state, n) for n in LAGS}
    named |= {f"demand_rolling_{kind}_{n}h": v for n, found in windows.items() for kind, v in found.items()}
    named |= {f"demand_change_{n}h": now - _ago(state, n) for n in CHANGES}
    named |= {f"demand_pct_change_{n}h": pct_change(now, _ago(state, n), scale=100.0, eps=1e-6) for n in RELATIVE_CHANGES}
    named |= {f"demand_vs_rolling_mean_{n}h": now - windows[n]["mean"] for n in LEVELS}
    named["demand_ratio_24h_168h"] = safe_ratio(day, week, eps=1e-6)
    return named


def start_states(history: DataFrame, ref: datetime, key: str, ts: str, y: str) -> DataFrame:
    """One row per series: its key and ``state``, gap-filled, of ``MEMORY + 1`` hours that end at ``ref``.

    A series without a value in that time has no row. The array is bounded whatever the history.
    """
    past = continuous_history(history_slice(history, ts, ref, MEMORY), key, ts, y, ref)
    back = F.timestamp_diff("HOUR", F.col(ts), F.lit(ref)).cast("int")
    known = past.where(F.col(y).isNotNull()).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(back.alias("b"), F.col(y).cast("double").alias("y")))).alias("m"))
    hours = F.sequence(F.lit(MEMORY), F.lit(0), F.lit(-1))
    return known.select(key, F.transform(hours, lambda b: F.try_element_at("m", b)).alias("state"))


def hours_ahead(targets: DataFrame, ref: datetime, hours: int, key: str, inputs: list[str]) -> DataFrame:
    """Targets in the ``hours`` after ``ref``, one per series and hour, with ``_step`` from 1."""
    scope = targets.where(
        (F.col("target_datetime") > F.lit(ref)) & (F.col("target_datetime") <= F.lit(ref + timedelta(hours=hours)))
    )
    step = F.timestamp_diff("HOUR", F.lit(ref), F.col("target_datetime")).cast("int")
    return dedup_any(scope.select(key, "target_datetime", step.alias("_step"), *inputs), [key, "_step"])


def _folded(
    predicted: Callable[[Callable[[str], Column]], Column],
    names: list[str],
    history: DataFrame,
    targets: DataFrame,
    ref: datetime,
    hours: int,
    key: str,
    ts: str,
    y: str,
) -> DataFrame:
    """Fold ``predicted`` over the hours; it is given a function from the name of an input to its value in that hour."""
    inputs = [c for c in names if c in targets.columns and c != key]
    ahead = hours_ahead(targets, ref, hours, key, inputs)
    given = F.struct("target_datetime", *[F.col(c).cast("double").alias(c) for c in inputs])
    planned = ahead.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_step", given.alias("t")))).alias("plan"))
    rows = start_states(history, ref, key, ts, y).join(planned, key)

    def following(state: Column, step: Column) -> Column:
        target = F.try_element_at(F.col("plan"), step)
        known = state_features(state)

        def at_hand(name: str) -> Column:
            return F.col(key) if name == key else known.get(name, target[name] if name in inputs else F.lit(None))

        # bound once an hour, however often the model asks for an input
        asked = F.struct(*[at_hand(n).alias(n) for n in names], F.lit(0).alias("_"))
        value = F.get(F.transform(F.array(asked), lambda x: predicted(lambda n: x[n])), 0)
        return F.array_append(state, F.when(target.isNotNull(), value))

    run = F.aggregate(F.sequence(F.lit(1), F.lit(hours)), F.col("state"), following)
    ends = rows.select(key, "plan", F.slice(run, -hours, hours).alias("predicted"))
    found = ends.select(key, "plan", F.posexplode("predicted").alias("_at", "predicted_demand_mw"))
    at = F.try_element_at(F.col("plan"), F.col("_at") + 1)["target_datetime"]
    return found.select(key, at.alias("target_datetime"), "predicted_demand_mw").where("target_datetime IS NOT NULL")


def score_recursive(
    coefficients: dict[str, float],
    intercept: float,
    history: DataFrame,
    targets: DataFrame,
    ref: datetime,
    hours: int = 24,
    fill: dict[str, float] | None = None,
    key: str = "zone",
    ts: str = "datetime",
    y: str = "demand_mw",
) -> DataFrame:
    """Hour-by-hour forecast of a linear model for the targets given.

    Inputs are demand features of the hour before, or else columns of ``targets``; a missing one takes its ``fill``,
    or 0. An hour without a target gets no prediction and stays unknown to the later ones.
    """
    fill = fill or {}

    def predicted(value: Callable[[str], Column]) -> Column:
        terms = [F.lit(weight) * F.coalesce(value(c).cast("double"), F.lit(fill.get(c, 0.0))) for c, weight in coefficients.items()]
        return reduce(lambda a, b: a + b, terms, F.lit(float(intercept)))

    return _folded(predicted, list(coefficients), history, targets, ref, hours, key, ts, y)


def score_recursive_trees(
    forest: Forest,
    history: DataFrame,
    targets: DataFrame,
    ref: datetime,
    hours: int = 24,
    key: str = "zone",
    ts: str = "datetime",
    y: str = "demand_mw",
) -> DataFrame:
    """The same for a tree ensemble, such as ``trees.forest_of`` a fitted one; a missing input takes its fill."""

    def predicted(value: Callable[[str], Column]) -> Column:
        numbers = F.struct(*[forest.input(n, value(n)).alias(n) for n in forest.inputs()], F.lit(0).alias("_"))
        return F.get(F.transform(F.array(numbers), lambda x: forest.prediction(lambda n: x[n])), 0)

    return _folded(predicted, forest.inputs(), history, targets, ref, hours, key, ts, y)


def score_recursive_model(
    model: PipelineModel,
    inputs: list[str],
    history: DataFrame,
    targets: DataFrame,
    ref: datetime,
    hours: int = 24,
    key: str = "zone",
    ts: str = "datetime",
    y: str = "demand_mw",
    settle_every: int = 6,
) -> DataFrame:
    """The same for any fitted pipeline, such as boosted trees, with ``inputs`` as its input columns.

    Each hour is a step over one row per series: features of the states, the model, and the state one hour longer.
    The states are written every few steps, so plans stay short and a lost executor costs those steps only.
    """
    own = [c for c in inputs if c in targets.columns and c != key]
    ahead = settle(hours_ahead(targets, ref, hours, key, own))
    states = start_states(history, ref, key, ts, y).withColumn("predicted", F.array().cast("array<struct<target_datetime: timestamp, value: double>>"))
    for step in range(1, hours + 1):
        now = states.join(ahead.where(F.col("_step") == step).drop("_step"), key, "left")
        known = state_features(F.col("state"))
        ready = now.withColumns({c: known[c] for c in inputs if c in known and c not in own})
        value = F.when(F.col("target_datetime").isNotNull(), F.col("prediction_mw"))
        states = model.transform(ready).select(
            key,
            F.array_append("state", value).alias("state"),
            F.array_append("predicted", F.struct(F.col("target_datetime").cast("timestamp").alias("target_datetime"), value.alias("value"))).alias("predicted"),
        )
        if step % settle_every == 0 and step < hours:
            states = settle(states)
    kind = dict(targets.dtypes)["target_datetime"]
    found = states.select(key, F.inline("predicted")).where("target_datetime IS NOT NULL")
    return found.select(key, F.col("target_datetime").cast(kind).alias("target_datetime"), F.col("value").alias("predicted_demand_mw"))
