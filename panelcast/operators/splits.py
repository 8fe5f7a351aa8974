"""Thinning, walk-forward folds and purged splits for training sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.timecols import micros
from panelcast.operators.blocks import DAY, HOUR, MICRO, as_keys
from panelcast.operators.joins import attach_one_row, keep_matching

ORIGIN = "2020-01-01"


def downsample_issues(
    df: DataFrame, stride: int = 1, origin: str = ORIGIN, key="zone", issue: str = "issue_datetime"
) -> DataFrame:
    """First issue of each series and day, on one day in ``stride`` counted from ``origin``."""
    day = F.to_date(issue)
    chosen = df.filter(F.date_diff(day, F.lit(origin).cast("date")) % stride == 0)
    first = chosen.groupBy(*as_keys(key), day.alias("_day")).agg(F.min(issue).alias(issue))
    return keep_matching(chosen, first, [*as_keys(key), issue])


def fold_of(issue: str, last: str, k: int, days: int) -> Column:
    """Number 1..k of the test fold an issue falls in, 0 before the first and null at the end.

    Fold i covers ``[start, start + days)``; the folds end at the newest issue.
    """
    back = micros(last) - micros(issue)
    steps = F.ceil(back / F.lit(days * DAY * MICRO))
    return F.when(back > 0, F.greatest(F.lit(k) - steps + 1, F.lit(0)).cast("int"))


def with_folds(df: DataFrame, k: int = 5, days: int = 30, issue: str = "issue_datetime") -> DataFrame:
    """The fold number of each row; the only global value is the newest issue."""
    last = df.agg(F.max(issue).alias("_last"))
    return attach_one_row(df, last).withColumn("fold", fold_of(issue, "_last", k, days)).drop("_last")


def walk_forward_folds(df: DataFrame, k: int = 5, days: int = 30, issue: str = "issue_datetime") -> DataFrame:
    """Fold table: test bounds with the rows before (train) and inside (test) each fold."""
    counted = with_folds(df, k, days, issue).groupBy("fold").agg(F.count(F.lit(1)).alias("_n"))
    last = df.agg(F.max(issue).alias("_last"))
    numbers = last.select("_last", F.explode(F.sequence(F.lit(0), F.lit(k))).alias("fold"))
    # k + 1 rows: the rows before the first fold and one per fold
    table = numbers.join(F.broadcast(counted), "fold", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    earlier = Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    kind = dict(df.dtypes)[issue]

    def bound(steps: Column) -> Column:
        return F.timestamp_micros(micros("_last") - steps * F.lit(days * DAY * MICRO)).cast(kind)

    back = F.lit(k) - F.col("fold")
    return (
        table.select(
            "fold",
            bound(back + 1).alias("test_start"),
            bound(back).alias("test_end"),
            F.sum("_n").over(earlier).alias("train_rows"),
            F.col("_n").alias("test_rows"),
        )
        .filter(F.col("fold") > 0)
    )


def purged_split(
    df: DataFrame,
    k: int = 5,
    days: int = 30,
    issue: str = "issue_datetime",
    target: str = "target_datetime",
) -> DataFrame:
    """Rows labelled train, validation or test; rows a purge removes are left out.

    The last fold is the test set and the one before it validation. A training or validation row
    needs its target at least an hour before the next set starts.
    """
    last = df.agg(F.max(issue).alias("_last"))
    width = F.lit(days * DAY * MICRO)
    end = micros("_last")
    test_start, valid_start = end - width, end - width * 2
    at, aim = micros(issue), micros(target)
    hour = F.lit(HOUR * MICRO)
    label = (
        F.when((at < valid_start) & (aim <= valid_start - hour), "train")
        .when((at >= valid_start) & (at < test_start) & (aim <= test_start - hour), "validation")
        .when((at >= test_start) & (at < end), "test")
    )
    labelled = attach_one_row(df, last).withColumn("split", label)
    return labelled.filter(F.col("split").isNotNull()).drop("_last")


def split_report(split: DataFrame, issue: str = "issue_datetime", target: str = "target_datetime") -> DataFrame:
    """Rows and bounds of each set, the evidence for or against leakage."""
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(issue).alias("first_issue"),
        F.max(issue).alias("last_issue"),
        F.max(target).alias("last_target"),
    )


def require_no_leak(split: DataFrame, issue: str = "issue_datetime", target: str = "target_datetime") -> DataFrame:
    """Raise if a set is empty or a set's targets reach into the next one; reads three rows."""
    bounds = {row.split: row for row in split_report(split, issue, target).collect()}
    order = ["train", "validation", "test"]
    if any(name not in bounds for name in order):
        raise ValueError("a split is empty after the purge")
    for earlier, later in zip(order, order[1:]):
        if not bounds[earlier].last_target < bounds[later].first_issue:
            raise ValueError(f"targets of {earlier} reach into {later}")
    return split
