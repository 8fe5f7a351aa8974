"""Known dates."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from panelcast.functions import holidays as hd
from panelcast.functions import timecols as tc
from panelcast.operators import calendar as cal

# Easter Sundays 2020 to 2027.
EASTER = ["2020-04-12", "2021-04-04", "2022-04-17", "2023-04-09", "2024-03-31", "2025-04-20", "2026-04-05", "2027-03-28"]


def days(spark, *texts):
    return spark.createDataFrame([(date.fromisoformat(t),) for t in texts], "day date")


def test_easter(spark):
    got = spark.range(2020, 2028).select(hd.easter_date("id").cast("string")).collect()
    assert [r[0] for r in got] == EASTER


def test_easter_extremes(spark):
    years = spark.createDataFrame([(1818,), (1943,), (1954,), (1981,), (2008,), (2285,)], "y int")
    got = [r[0] for r in years.select(hd.easter_date("y").cast("string")).collect()]
    assert got == ["1818-03-22", "1943-04-25", "1954-04-18", "1981-04-19", "2008-03-23", "2285-03-22"]


@pytest.mark.parametrize(
    "text, flag",
    [
        ("2024-01-01", "is_new_year"), ("2024-02-19", "is_family_day"), ("2024-03-29", "is_good_friday"),
        ("2024-04-01", "is_easter_monday"), ("2024-05-20", "is_victoria_day"), ("2024-07-01", "is_canada_day"),
        ("2024-08-05", "is_civic_holiday"), ("2024-09-02", "is_labour_day"), ("2024-10-14", "is_thanksgiving"),
        ("2024-12-25", "is_christmas"), ("2024-12-26", "is_boxing_day"),
    ],
)
def test_flagged_holidays(spark, text, flag):
    for years in ((2024, 2024), None):
        row = cal.with_calendar(days(spark, text), "day", years).first().asDict()
        assert row["is_holiday"] == 1
        assert [f for f in hd.HOLIDAY_FLAGS if row[f]] == [flag]


def test_both_ways_to_the_calendar_agree(spark):
    spine = cal.date_spine(spark, 2019, 2026).withColumnRenamed("calendar_date", "day")
    joined, computed = cal.with_calendar(spine, "day", (2019, 2026)), cal.with_calendar(spine, "day")
    assert joined.select(*computed.columns).exceptAll(computed).isEmpty()


def test_a_date_outside_the_promised_years_is_refused(spark):
    with pytest.raises(Exception, match="outside the calendar of 2024 to 2024: 2027-07-01"):
        cal.with_calendar(days(spark, "2027-07-01"), "day", (2024, 2024)).select("is_civic_holiday").collect()
    nothing = days(spark, "2024-07-01").select(F.lit(None).cast("date").alias("day"))
    assert cal.with_calendar(nothing, "day", (2024, 2024)).first().is_holiday is None


def test_neighbours_cross_the_year_end(spark):
    row = cal.adjacent_holiday(days(spark, "2023-12-31"), "day").first()
    assert (row.is_day_before_holiday, row.is_day_after_holiday) == (1, 0)


def test_named_list_differs_from_the_flags(spark):
    got = {r.day.isoformat(): r.holiday_name for r in cal.named_holidays(days(spark, "2024-11-11", "2024-08-05"), "day").collect()}
    assert got == {"2024-11-11": "remembrance_day", "2024-08-05": None}


def test_named_dates_match_the_named_flags(spark):
    spine = cal.date_spine(spark, 2020, 2027, pad=0)
    flagged = cal.named_holidays(spine, "calendar_date").filter("is_holiday = 1").select("calendar_date")
    listed = spark.range(2020, 2028).select(F.explode(hd.named_holiday_dates("id")).alias("calendar_date"))
    assert flagged.exceptAll(listed.distinct()).isEmpty()
    assert listed.distinct().exceptAll(flagged).isEmpty()


def test_school_breaks(spark):
    texts = ["2023-12-22", "2023-12-23", "2024-01-06", "2024-01-07", "2024-03-11", "2024-03-17", "2024-06-30", "2024-07-01", "2024-08-31"]
    got = [r.school_break_name for r in cal.school_breaks(days(spark, *texts), "day", (2023, 2024)).orderBy("day").collect()]
    winter, march, summer = "winter_break", "march_break", "summer_break"
    assert got == [None, winter, winter, None, march, march, None, summer, summer]


def test_distance_knows_only_the_given_years(spark):
    frame = days(spark, "2024-12-30", "2024-12-24", "2024-01-01")
    near = {r.day.isoformat(): r for r in cal.holiday_distance(frame, "day", (2024, 2024)).collect()}
    assert near["2024-12-30"].days_to_next_holiday == 365
    assert near["2024-12-24"].days_to_next_holiday == 1
    assert near["2024-01-01"].days_since_last_holiday == 365
    wide = {r.day.isoformat(): r for r in cal.holiday_distance(frame, "day", (2024, 2024), pad=1).collect()}
    assert wide["2024-12-30"].days_to_next_holiday == 2


@pytest.mark.parametrize(
    "local, standard, daylight",
    [
        ("2024-11-03 00:30:00", "2024-11-03 04:30:00", "2024-11-03 04:30:00"),
        ("2024-11-03 01:00:00", "2024-11-03 06:00:00", "2024-11-03 05:00:00"),
        ("2024-11-03 02:00:00", "2024-11-03 07:00:00", "2024-11-03 07:00:00"),
        ("2024-03-10 01:00:00", "2024-03-10 06:00:00", "2024-03-10 06:00:00"),
        ("2024-03-10 02:30:00", "2024-03-10 07:00:00", "2024-03-10 07:00:00"),
        ("2024-03-10 03:00:00", "2024-03-10 07:00:00", "2024-03-10 07:00:00"),
    ],
)
def test_local_to_utc_at_clock_changes(spark, local, standard, daylight):
    df = spark.createDataFrame([(datetime.fromisoformat(local),)], "t timestamp")
    zone = "America/Toronto"
    row = df.select(
        tc.to_utc("t", zone).cast("string"), tc.to_utc("t", zone, ambiguous="daylight").cast("string")
    ).first()
    assert tuple(row) == (standard, daylight)


@pytest.mark.parametrize("now, anchor", [("07:59", "2024-05-01 08:00"), ("08:00", "2024-05-02 08:00"), ("23:00", "2024-05-02 08:00")])
def test_anchor_is_the_last_eight_oclock(spark, now, anchor):
    df = spark.createDataFrame([(datetime.fromisoformat(f"2024-05-02 {now}"),)], "t timestamp")
    row = df.withColumns(tc.forecast_window(F.col("t"))).first()
    assert row.prediction_start == datetime.fromisoformat(anchor)
    assert (row.prediction_end - row.prediction_start).total_seconds() == 25 * 3600
