"""Holiday tests as pure functions of a date, so they need neither a join nor a table."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The statutory days the feature tables flag, and how each is found.
# ("fixed", month, day) | ("monday", month, first day, last day) | ("easter", days after Easter)
HOLIDAY_RULES = {
    "is_new_year": ("fixed", 1, 1),
    "is_family_day": ("monday", 2, 15, 21),
    "is_good_friday": ("easter", -2),
    "is_easter_monday": ("easter", 1),
    "is_victoria_day": ("monday", 5, 18, 24),
    "is_canada_day": ("fixed", 7, 1),
    "is_civic_holiday": ("monday", 8, 1, 7),
    "is_labour_day": ("monday", 9, 1, 7),
    "is_thanksgiving": ("monday", 10, 8, 14),
    "is_christmas": ("fixed", 12, 25),
    "is_boxing_day": ("fixed", 12, 26),
}
HOLIDAY_FLAGS = list(HOLIDAY_RULES)

# The named list adds Remembrance Day and leaves out the August civic holiday.
NAMED_RULES = {
    "new_year": ("fixed", 1, 1),
    "family_day": ("monday", 2, 15, 21),
    "good_friday": ("easter", -2),
    "easter_monday": ("easter", 1),
    "victoria_day": ("monday", 5, 18, 24),
    "canada_day": ("fixed", 7, 1),
    "labour_day": ("monday", 9, 1, 7),
    "thanksgiving": ("monday", 10, 8, 14),
    "remembrance_day": ("fixed", 11, 11),
    "christmas": ("fixed", 12, 25),
    "boxing_day": ("fixed", 12, 26),
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fixed_holiday(date, month: int, day: int) -> Column:
    d = _c(date)
    return (F.month(d) == month) & (F.dayofmonth(d) == day)


def weekday_band_flag(date, month: int, weekday: int, first: int, last: int) -> Column:
    """The one given weekday (Monday = 0) that falls in a band of days of the month."""
    d = _c(date)
    band = F.dayofmonth(d).between(first, last)
    return (F.month(d) == month) & (F.weekday(d) == weekday) & band


def nth_weekday_flag(date, month: int, weekday: int, n: int) -> Column:
    return weekday_band_flag(date, month, weekday, 7 * (n - 1) + 1, 7 * n)


def nth_weekday(year, month: int, weekday: int, n: int) -> Column:
    """Date of the n-th given weekday (Monday = 0) of a month."""
    names = ["MO", "TU", "WE", "TH", "FR", "SA", "SU"]
    first = F.make_date(_c(year), F.lit(month), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), names[weekday]), 7 * (n - 1))


def easter_date(year) -> Column:
    """Easter Sunday from golden number, epact and the Sunday correction (the form published by Oudin)."""
    y = _c(year).cast("int")

    def div(a, n):
        return F.floor(a / F.lit(n)).cast("int")

    century = div(y, 100)
    golden = F.pmod(y, F.lit(19))
    solar = div(century, 4)
    lunar = div(century * 8 + 13, 25)
    epact = F.pmod(golden * 19 + century - solar - lunar + 15, F.lit(30))
    # two exceptions keep the full moon on or before 18 April
    late = (epact == 29) | ((epact == 28) & (golden > 10))
    full_moon = epact - F.when(late, 1).otherwise(0)
    weekday = F.pmod(y + div(y, 4) + full_moon + 2 - century + solar, F.lit(7))
    from_21_march = full_moon - weekday + 7
    return F.date_add(F.make_date(y, F.lit(3), F.lit(21)), from_21_march)


def _tests(date, rules: dict[str, tuple]) -> dict[str, Column]:
    """One boolean per rule; the parts of the date and its Easter are worked out once for all."""
    d = _c(date)
    month, day = F.month(d), F.dayofmonth(d)
    monday = F.weekday(d) == 0
    since_easter = F.date_diff(d, easter_date(F.year(d)))

    def test(kind, *args):
        if kind == "easter":
            return since_easter == args[0]
        if kind == "fixed":
            return (month == args[0]) & (day == args[1])
        return (month == args[0]) & monday & day.between(args[1], args[2])

    return {name: test(*rule) for name, rule in rules.items()}


def _flag(test: Column) -> Column:
    return F.when(test, 1).otherwise(0)


def is_holiday(date) -> Column:
    return _flag(reduce(or_, _tests(date, HOLIDAY_RULES).values()))


def calendar_flags(date) -> dict[str, Column]:
    """Holiday flags of a date with its neighbours on the calendar."""
    d = _c(date)
    tests = _tests(d, HOLIDAY_RULES)
    return {
        **{name: _flag(test) for name, test in tests.items()},
        "is_holiday": _flag(reduce(or_, tests.values())),
        "is_day_before_holiday": is_holiday(F.date_add(d, 1)),
        "is_day_after_holiday": is_holiday(F.date_sub(d, 1)),
    }


def holiday_name(date) -> Column:
    """Name from the named list, null on other days."""
    named = [F.when(test, F.lit(name)) for name, test in _tests(date, NAMED_RULES).items()]
    return F.coalesce(*named)


def named_holiday_dates(year) -> Column:
    """Array of the named holidays of a year."""
    y = _c(year)
    dates = []
    for kind, *args in NAMED_RULES.values():
        if kind == "fixed":
            dates.append(F.make_date(y, F.lit(args[0]), F.lit(args[1])))
        elif kind == "monday":
            # the band starts on the earliest day the n-th Monday can fall on
            before = F.make_date(y, F.lit(args[0]), F.lit(args[1])) - F.expr("INTERVAL 1 DAY")
            dates.append(F.next_day(before.cast("date"), "MO"))
        else:
            dates.append(F.date_add(easter_date(y), args[0]))
    return F.array(*dates)

