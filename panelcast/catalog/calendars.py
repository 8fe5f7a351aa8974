"""Checks of calendar operators on the dates of the orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.catalog.base import P_DAY, check, with_sql
from panelcast.functions import holidays as hd
from panelcast.functions.holidays import HOLIDAY_RULES, NAMED_RULES
from panelcast.operators import calendar as cal
from panelcast.plans import panels as pn


def easter_sql(y: str) -> str:
    """Easter as a date, by the Julian full moon table turned Gregorian."""
    g, c = f"({y} % 19)", f"({y} // 100)"
    h = f"(({c} - {c} // 4 - (8 * {c} + 13) // 25 + 19 * {g} + 15) % 30)"
    i = f"({h} - CASE WHEN {h} = 29 OR ({h} = 28 AND {g} > 10) THEN 1 ELSE 0 END)"
    j = f"(({y} + {y} // 4 + {i} + 2 - {c} + {c} // 4) % 7)"
    return f"(make_date(CAST({y} AS INTEGER), 3, 28) + CAST({i} - {j} AS INTEGER))"


def rule_sql(rule, d: str) -> str:
    kind, *a = rule
    if kind == "fixed":
        return f"(month({d}) = {a[0]} AND day({d}) = {a[1]})"
    if kind == "monday":
        return f"(month({d}) = {a[0]} AND isodow({d}) = 1 AND day({d}) BETWEEN {a[1]} AND {a[2]})"
    return f"(CAST({d} AS DATE) = {easter_sql(f'year({d})')} + {a[0]})"


def flag_sql(test: str) -> str:
    return f"CASE WHEN {test} THEN 1 ELSE 0 END"


def any_sql(d: str) -> str:
    return "(" + " OR ".join(rule_sql(r, d) for r in HOLIDAY_RULES.values()) + ")"


def calendar_sql(d: str) -> str:
    parts = [f"{flag_sql(rule_sql(r, d))} AS {n}" for n, r in HOLIDAY_RULES.items()]
    parts.append(f"{flag_sql(any_sql(d))} AS is_holiday")
    parts.append(f"{flag_sql(any_sql(f'({d} + INTERVAL 1 DAY)'))} AS is_day_before_holiday")
    parts.append(f"{flag_sql(any_sql(f'({d} - INTERVAL 1 DAY)'))} AS is_day_after_holiday")
    return ", ".join(parts)


CALENDAR = [*HOLIDAY_RULES, "is_holiday", "is_day_before_holiday", "is_day_after_holiday"]
_FLAGS = ", ".join(f"{c} i" for c in CALENDAR)
_DAYS = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders"


def _days(t):
    return t.orders.select(F.to_date("o_orderdate").alias("day")).distinct()


def _years(t):
    return cal.year_bounds(t.orders, "o_orderdate")


@check(
    "date_spine",
    "calendar_date date",
    """SELECT unnest(generate_series(
         CAST(make_date(CAST(min(year(o_orderdate)) - 1 AS INTEGER), 1, 1) AS TIMESTAMP),
         CAST(make_date(CAST(max(year(o_orderdate)) + 1 AS INTEGER), 12, 31) AS TIMESTAMP), INTERVAL 1 DAY)) AS calendar_date
       FROM orders""",
)
def _(t):
    return cal.date_spine(t.spark, *_years(t))


@check(
    "fixed_holidays",
    "o_orderkey i, new_year i, christmas i",
    f"""SELECT o_orderkey, {flag_sql(rule_sql(('fixed', 1, 1), 'o_orderdate'))} AS new_year,
               {flag_sql(rule_sql(('fixed', 12, 25), 'o_orderdate'))} AS christmas FROM orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        hd.fixed_holiday("o_orderdate", 1, 1).cast("int").alias("new_year"),
        hd.fixed_holiday("o_orderdate", 12, 25).cast("int").alias("christmas"),
    )


@check(
    "nth_weekday_holidays",
    "o_orderkey i, third_monday_feb i, first_sunday_feb i, victoria_day i, labour_day date",
    """SELECT o_orderkey,
         CASE WHEN month(d) = 2 AND isodow(d) = 1 AND day(d) BETWEEN 15 AND 21 THEN 1 ELSE 0 END AS third_monday_feb,
         CASE WHEN month(d) = 2 AND isodow(d) = 7 AND day(d) <= 7 THEN 1 ELSE 0 END AS first_sunday_feb,
         CASE WHEN month(d) = 5 AND isodow(d) = 1 AND day(d) BETWEEN 18 AND 24 THEN 1 ELSE 0 END AS victoria_day,
         make_date(CAST(year(d) AS INTEGER), 9, 1)
           + CAST((8 - isodow(make_date(CAST(year(d) AS INTEGER), 9, 1))) % 7 AS INTEGER) AS labour_day
       FROM (SELECT o_orderkey, o_orderdate AS d FROM orders)""",
)
def _(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        hd.nth_weekday_flag(d, 2, 0, 3).cast("int").alias("third_monday_feb"),
        hd.nth_weekday_flag(d, 2, 6, 1).cast("int").alias("first_sunday_feb"),
        hd.weekday_band_flag(d, 5, 0, 18, 24).cast("int").alias("victoria_day"),
        hd.nth_weekday(F.year(d), 9, 0, 1).alias("labour_day"),
    )


@check(
    "easter_dates",
    "year i, orders i, easter date, good_friday date, easter_monday date",
    f"""SELECT year, orders, {easter_sql('year')} AS easter, {easter_sql('year')} - 2 AS good_friday,
               {easter_sql('year')} + 1 AS easter_monday
        FROM (SELECT year(o_orderdate) AS year, count(*) AS orders FROM orders GROUP BY 1)""",
)
def _(t):
    years = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("orders"))
    easter = hd.easter_date("year")
    return years.withColumns(
        {"easter": easter, "good_friday": F.date_sub(easter, 2), "easter_monday": F.date_add(easter, 1)}
    )


@check(
    "calendar_join",
    f"zone s, date date, y d2, {_FLAGS}",
    with_sql(P_DAY, f"SELECT zone, date, y, {calendar_sql('date')} FROM p_day"),
)
def _(t):
    days = pn.daily_panel(t.orders).withColumn("date", F.to_date("date"))
    return cal.with_calendar(days, "date", _years(t))


@check(
    "calendar_without_join",
    f"zone s, date date, y d2, {_FLAGS}",
    with_sql(P_DAY, f"SELECT zone, date, y, {calendar_sql('date')} FROM p_day"),
)
def _(t):
    return cal.with_calendar(pn.daily_panel(t.orders).withColumn("date", F.to_date("date")), "date")


@check(
    "any_and_adjacent_holiday",
    "day date, is_holiday i, is_day_before_holiday i, is_day_after_holiday i",
    f"""SELECT day, {flag_sql(any_sql('day'))} AS is_holiday,
               {flag_sql(any_sql('(day + INTERVAL 1 DAY)'))} AS is_day_before_holiday,
               {flag_sql(any_sql('(day - INTERVAL 1 DAY)'))} AS is_day_after_holiday FROM ({_DAYS})""",
)
def _(t):
    return cal.adjacent_holiday(_days(t).withColumn("is_holiday", hd.is_holiday("day")), "day")


def name_sql(d: str) -> str:
    cases = " ".join(f"WHEN {rule_sql(r, d)} THEN '{n}'" for n, r in NAMED_RULES.items())
    return f"CASE {cases} END"


@check(
    "holiday_names",
    "o_orderkey i, holiday_name s, is_holiday i",
    f"""SELECT o_orderkey, holiday_name, CASE WHEN holiday_name IS NOT NULL THEN 1 ELSE 0 END AS is_holiday
        FROM (SELECT o_orderkey, {name_sql('o_orderdate')} AS holiday_name FROM orders)""",
)
def _(t):
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return cal.named_holidays(rows, "day")


@check(
    "school_breaks",
    "o_orderkey i, is_school_break i, school_break_name s",
    """SELECT o_orderkey, CASE WHEN n IS NULL THEN 0 ELSE 1 END AS is_school_break, n AS school_break_name FROM (
         SELECT o_orderkey,
           CASE WHEN (month(d) = 12 AND day(d) >= 23) OR (month(d) = 1 AND day(d) <= 6) THEN 'winter_break'
                WHEN month(d) IN (7, 8) THEN 'summer_break'
                WHEN CAST(d AS DATE) BETWEEN m AND m + 6 THEN 'march_break' END AS n
         FROM (SELECT o_orderkey, o_orderdate AS d,
                      make_date(CAST(year(o_orderdate) AS INTEGER), 3, 1)
                      + CAST((8 - isodow(make_date(CAST(year(o_orderdate) AS INTEGER), 3, 1))) % 7 + 7 AS INTEGER) AS m
               FROM orders))""",
)
def _(t):
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return cal.school_breaks(rows, "day", _years(t))


@check(
    "special_events",
    "o_orderkey i, is_special_event i, event_name s",
    """SELECT o_orderkey, CASE WHEN e THEN 1 ELSE 0 END AS is_special_event, CASE WHEN e THEN 'super_bowl' END AS event_name
       FROM (SELECT o_orderkey, month(o_orderdate) = 2 AND isodow(o_orderdate) = 7 AND day(o_orderdate) <= 7 AS e FROM orders)""",
)
def _(t):
    return cal.special_events(t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day")), "day")


@check(
    "row_adjacent_holiday",
    "zone s, date date, is_holiday i, is_holiday_eve i, is_holiday_aftermath i",
    with_sql(
        P_DAY,
        f""", marked AS (SELECT zone, date, {flag_sql(any_sql('date'))} AS is_holiday FROM p_day)
            SELECT *, coalesce(lead(is_holiday) OVER w, 0) AS is_holiday_eve,
                   coalesce(lag(is_holiday) OVER w, 0) AS is_holiday_aftermath
            FROM marked WINDOW w AS (PARTITION BY zone ORDER BY date)""",
    ),
)
def _(t):
    days = pn.daily_panel(t.orders).withColumn("is_holiday", hd.is_holiday("date"))
    return cal.row_adjacent_holiday(days, "zone", "date")


_HOLIDAYS = (
    "ys AS (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1)) AS y FROM orders), "
    "hs AS (SELECT d FROM (SELECT CAST(unnest(generate_series(make_date(CAST(y AS INTEGER), 1, 1), "
    "make_date(CAST(y AS INTEGER), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d FROM ys) WHERE ("
    + " OR ".join(rule_sql(r, "d") for r in NAMED_RULES.values())
    + "))"
)


@check(
    "holiday_distance",
    "day date, days_to_next_holiday i, days_since_last_holiday i, near_holiday i",
    f"""WITH {_HOLIDAYS}, ds AS ({_DAYS}), dist AS (
          SELECT day, coalesce((SELECT min(d) FROM hs WHERE d > day) - day, 365) AS days_to_next_holiday,
                 coalesce(day - (SELECT max(d) FROM hs WHERE d < day), 365) AS days_since_last_holiday FROM ds)
        SELECT *, CASE WHEN days_to_next_holiday <= 3 OR days_since_last_holiday <= 3 THEN 1 ELSE 0 END AS near_holiday
        FROM dist""",
)
def _(t):
    return cal.holiday_distance(_days(t), "day", _years(t))


@check(
    "holiday_table_join",
    "o_orderkey i, holiday_name s, is_holiday i, days_to_holiday i, days_from_holiday i",
    f"""SELECT o_orderkey, holiday_name, CASE WHEN holiday_name IS NULL THEN 0 ELSE 1 END AS is_holiday,
               0 AS days_to_holiday, 0 AS days_from_holiday
        FROM (SELECT o_orderkey, {name_sql('o_orderdate')} AS holiday_name FROM orders)""",
)
def _(t):
    years = _years(t)
    spine = cal.date_spine(t.spark, *years)
    named = cal.named_holidays(spine, "calendar_date").filter("is_holiday = 1")
    table = named.select(F.col("calendar_date").alias("date"), "holiday_name")
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return cal.add_holiday_features(rows, table, "o_orderdate")


@check(
    "calendar_features",
    "zone s, date date, is_holiday i, holiday_name s, is_school_break i, is_special_event i, days_to_next_holiday i, days_since_last_holiday i, near_holiday i",
    f"""WITH {P_DAY}, {_HOLIDAYS}, dist AS (
          SELECT zone, CAST(date AS DATE) AS date, {name_sql('date')} AS holiday_name,
                 CASE WHEN month(date) = 2 AND isodow(date) = 7 AND day(date) <= 7 THEN 1 ELSE 0 END AS is_special_event,
                 CASE WHEN (month(date) = 12 AND day(date) >= 23) OR (month(date) = 1 AND day(date) <= 6)
                        OR month(date) IN (7, 8)
                        OR CAST(date AS DATE) - (make_date(CAST(year(date) AS INTEGER), 3, 1)
                           + CAST((8 - isodow(make_date(CAST(year(date) AS INTEGER), 3, 1))) % 7 + 7 AS INTEGER)) BETWEEN 0 AND 6
                      THEN 1 ELSE 0 END AS is_school_break,
                 coalesce((SELECT min(d) FROM hs WHERE d > CAST(date AS DATE)) - CAST(date AS DATE), 365) AS days_to_next_holiday,
                 coalesce(CAST(date AS DATE) - (SELECT max(d) FROM hs WHERE d < CAST(date AS DATE)), 365)
                   AS days_since_last_holiday
          FROM p_day)
        SELECT *, CASE WHEN holiday_name IS NULL THEN 0 ELSE 1 END AS is_holiday,
               CASE WHEN days_to_next_holiday <= 3 OR days_since_last_holiday <= 3 THEN 1 ELSE 0 END AS near_holiday
        FROM dist""",
)
def _(t):
    return cal.add_calendar_features(pn.daily_panel(t.orders), "zone", "date", _years(t))
