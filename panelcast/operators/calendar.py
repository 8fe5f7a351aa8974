"""Calendar operators: date spine, holiday features, school breaks, distances.

A spine covers whole years, so its row count follows from two year numbers. It is broadcast only
while those years are few; beyond the bound the same columns come from date arithmetic or from a
shuffled join.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.functions import holidays as H
from panelcast.operators.blocks import over_row_blocks
from panelcast.operators.joins import lookup

SPINE_YEARS = 400
FAR_AWAY = 365


def year_bounds(df: DataFrame, ts: str) -> tuple[int, int] | None:
    """First and last year of a time column: a one-row aggregate read on the driver."""
    row = df.agg(F.year(F.min(ts)).alias("lo"), F.year(F.max(ts)).alias("hi")).first()
    return None if row.lo is None else (row.lo, row.hi)


def date_spine(spark: SparkSession, first_year: int, last_year: int, pad: int = 1) -> DataFrame:
    """Every date of the years, padded by whole years on both sides."""
    start, end = date(first_year - pad, 1, 1), date(last_year + pad, 12, 31)
    days = F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))
    return spark.range(1, numPartitions=1).select(F.explode(days).alias("calendar_date"))


def holiday_calendar(spine: DataFrame, day: str = "calendar_date") -> DataFrame:
    return spine.withColumns(H.calendar_flags(day))


def with_calendar(
    df: DataFrame,
    date_col: str,
    years: tuple[int, int] | None = None,
    extra: Callable[[str], dict[str, Column]] | None = None,
) -> DataFrame:
    """Holiday flags of a date column, and whatever ``extra`` derives from the date.

    With known, few years both come from a date dimension, worked out once per day instead of once
    per row. The years are a promise: a date of another year (beyond the year of padding on both sides) raises. Without
    years every row computes them, which needs no join at all.
    """
    more = extra or (lambda _: {})
    if years and years[1] - years[0] < SPINE_YEARS:
        days = holiday_calendar(date_spine(df.sparkSession, *years))
        dimension = days.withColumns(more("calendar_date")) if extra else days
        added = [c for c in dimension.columns if c != "calendar_date"]
        dimension = dimension.withColumnRenamed("calendar_date", date_col)
        joined = lookup(df.drop(*added), dimension.withColumn("_known", F.lit(1)), date_col)
        beyond = F.col("_known").isNull() & F.col(date_col).isNotNull()
        refused = F.raise_error(F.concat(F.lit(f"outside the calendar of {years[0]} to {years[1]}: "), F.col(date_col).cast("string")))
        # on every column, as any one may be the only one that is asked for
        return joined.withColumns({c: F.when(beyond, refused).otherwise(F.col(c)) for c in added}).drop("_known")
    return df.withColumns({**H.calendar_flags(date_col), **more(date_col)})


def school_break_days(years: DataFrame, year: str = "year") -> DataFrame:
    """One row per day of a school break, from a frame of distinct years.

    Winter runs 23 December to 6 January, March break is the week of the second Monday, summer
    is July and August. Where ranges meet, the later listed one names the day.
    """
    y = F.col(year)

    def span(start, end, name, place):
        days = F.sequence(start, end, F.expr("INTERVAL 1 DAY"))
        return F.struct(days.alias("days"), F.lit(name).alias("school_break_name"), F.lit(place).alias("place"))

    def day(year_col, month, dom):
        return F.make_date(year_col, F.lit(month), F.lit(dom))

    march = H.nth_weekday(y, 3, 0, 2)
    spans = F.array(
        span(day(y - 1, 12, 23), day(y, 1, 6), "winter_break", 0),
        span(march, F.date_add(march, 6), "march_break", 1),
        span(day(y, 7, 1), day(y, 8, 31), "summer_break", 2),
        span(day(y, 12, 23), day(y + 1, 1, 6), "winter_break", 3),
    )
    return (
        years.select(year, F.inline(spans))
        .select(F.explode("days").alias("calendar_date"), "school_break_name", (y * 10 + F.col("place")).alias("_order"))
        .groupBy("calendar_date")
        .agg(F.max_by("school_break_name", "_order").alias("school_break_name"))
    )


def _years(spark: SparkSession, years: tuple[int, int]) -> DataFrame:
    span = F.sequence(F.lit(years[0]), F.lit(years[1]))
    return spark.range(1, numPartitions=1).select(F.explode(span).alias("year"))


def school_breaks(df: DataFrame, date_col: str, years: tuple[int, int]) -> DataFrame:
    """School-break flag and name of a date: the ranges are unrolled to days and equi-joined."""
    days = school_break_days(_years(df.sparkSession, years))
    joined = lookup(df, days.withColumnRenamed("calendar_date", date_col), date_col)
    return joined.withColumn("is_school_break", F.col("school_break_name").isNotNull().cast("int"))


def special_events(df: DataFrame, date_col: str) -> DataFrame:
    """Flag and name of the one special event, the first Sunday of February."""
    event = H.nth_weekday_flag(date_col, 2, 6, 1)
    return df.withColumns(
        {
            "is_special_event": F.when(event, 1).otherwise(0),
            "event_name": F.when(event, F.lit("super_bowl")),
        }
    )


def named_holidays(df: DataFrame, date_col: str) -> DataFrame:
    """Holiday name from the named list and its 0/1 flag."""
    named = df.withColumn("holiday_name", H.holiday_name(date_col))
    return named.withColumn("is_holiday", F.col("holiday_name").isNotNull().cast("int"))


def adjacent_holiday(df: DataFrame, date_col: str) -> DataFrame:
    """Whether the next or the previous calendar day is a holiday."""
    return df.withColumns(
        {
            "is_day_before_holiday": H.is_holiday(F.date_add(F.col(date_col), 1)),
            "is_day_after_holiday": H.is_holiday(F.date_sub(F.col(date_col), 1)),
        }
    )


def row_adjacent_holiday(df: DataFrame, key, ts: str, flag: str = "is_holiday") -> DataFrame:
    """Whether the next or previous row of the series, not day, is a holiday."""

    def build(w):
        return {
            "is_holiday_eve": F.coalesce(F.lead(flag, 1).over(w), F.lit(0)),
            "is_holiday_aftermath": F.coalesce(F.lag(flag, 1).over(w), F.lit(0)),
        }

    return over_row_blocks(df, key, ts, build, back=1, ahead=1)


def holiday_distances(spark: SparkSession, years: tuple[int, int], pad: int = 0) -> DataFrame:
    """Per date of the years the days to the next and since the last named holiday.

    Only holidays of the given years count (``pad`` widens them); without one the distance is 365.
    """
    wide = (years[0] - pad, years[1] + pad)
    spine = date_spine(spark, *years, pad=0)
    days = _years(spark, wide).select(F.explode(H.named_holiday_dates("year")).alias("calendar_date"))
    marked = days.distinct().withColumn("holiday", F.col("calendar_date"))
    timeline = (
        spine.withColumn("in_spine", F.lit(True))
        .join(marked, "calendar_date", "full")
    )
    order = Window.orderBy("calendar_date")
    following = F.min("holiday").over(order.rowsBetween(1, Window.unboundedFollowing))
    preceding = F.max("holiday").over(order.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.coalesce(F.date_diff(following, F.col("calendar_date")), F.lit(FAR_AWAY))
    behind = F.coalesce(F.date_diff(F.col("calendar_date"), preceding), F.lit(FAR_AWAY))
    return (
        timeline.select("calendar_date", "in_spine", ahead.alias("days_to_next_holiday"), behind.alias("days_since_last_holiday"))
        .filter(F.col("in_spine"))
        .drop("in_spine")
    )


def holiday_distance(df: DataFrame, date_col: str, years: tuple[int, int], pad: int = 0) -> DataFrame:
    """Holiday distances of a date column and the within-three-days flag."""
    distances = holiday_distances(df.sparkSession, years, pad).withColumnRenamed("calendar_date", date_col)
    joined = lookup(df, distances, date_col)
    near = (F.col("days_to_next_holiday") <= 3) | (F.col("days_since_last_holiday") <= 3)
    return joined.withColumn("near_holiday", F.when(near, 1).otherwise(0))


def add_holiday_features(df: DataFrame, holidays: DataFrame, ts: str = "datetime") -> DataFrame:
    """Join a (date, holiday_name) table on the day of ``ts``; distances stay zero placeholders."""
    named = holidays.select(F.col("date").cast("date").alias("_day"), "holiday_name")
    joined = lookup(df.withColumn("_day", F.to_date(ts)), named, "_day").drop("_day")
    return joined.withColumns(
        {
            "is_holiday": F.col("holiday_name").isNotNull().cast("int"),
            "days_to_holiday": F.lit(0),
            "days_from_holiday": F.lit(0),
        }
    )


def add_calendar_features(df: DataFrame, key, ts: str, years: tuple[int, int]) -> DataFrame:
    """The full calendar feature set of a time column, keyed on its day."""
    out = df.withColumn("_day", F.to_date(ts))
    out = named_holidays(out, "_day")
    out = special_events(school_breaks(out, "_day", years), "_day")
    out = holiday_distance(out, "_day", years).drop("_day")
    return row_adjacent_holiday(out, key, ts)


