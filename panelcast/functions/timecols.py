"""Date and time expressions. Every function takes and returns Columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_timestamp(ts) -> Column:
    return _c(ts).cast("timestamp")


def micros(ts) -> Column:
    """Microseconds since the epoch; the numeric order all range frames use."""
    return F.unix_micros(as_timestamp(ts))


def seconds(ts) -> Column:
    return F.unix_seconds(as_timestamp(ts))


def add_hours(ts, hours) -> Column:
    """Timestamp shifted by a number of hours, fixed or per row."""
    hours = F.lit(hours) if isinstance(hours, int) else _c(hours)
    return F.timestamp_add("HOUR", hours.cast("int"), _c(ts))


def hour_start(date, hour) -> Column:
    """Hour-ending report time (date, 1..24) to the start of that hour."""
    return add_hours(_c(date).cast("timestamp"), _c(hour) - 1)


def interval_end(hour_ts, interval) -> Column:
    """Five-minute interval 1..12 of an hour to the moment the interval ends."""
    return F.timestamp_add("MINUTE", (_c(interval) * 5).cast("int"), _c(hour_ts))


def horizon_hours(issue, target) -> Column:
    """Whole hours from issue to target."""
    return F.timestamp_diff("HOUR", _c(issue), _c(target)).cast("int")


def age_minutes(ts, now) -> Column:
    return (seconds(now) - seconds(ts)) / F.lit(60.0)


def to_local(ts, zone: str) -> Column:
    """UTC wall time to local wall time."""
    return F.from_utc_timestamp(as_timestamp(ts), zone)


def to_utc(ts, zone: str, ambiguous: str = "standard") -> Column:
    """Local wall time to UTC.

    The hour that repeats in autumn is read as standard time (the later instant) or,
    with ``ambiguous="daylight"``, as the earlier one. A wall time that spring skips
    moves to the first instant after the gap.
    """
    if ambiguous not in ("standard", "daylight"):
        raise ValueError("ambiguous must be 'standard' or 'daylight'")
    local = as_timestamp(ts)
    utc = F.to_utc_timestamp(local, zone)
    later = utc + F.expr("INTERVAL 1 HOUR")
    there = F.from_utc_timestamp(utc, zone)
    past_the_gap = F.unix_micros(there) - F.unix_micros(F.date_trunc("HOUR", there))
    resolved = utc
    if ambiguous == "standard":
        repeated = F.from_utc_timestamp(later, zone) == local
        resolved = F.when(repeated, later).otherwise(utc)
    moved = F.timestamp_micros(F.unix_micros(utc) - past_the_gap)
    return F.when(there != local, moved).otherwise(resolved)


def dow_monday0(ts) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(_c(ts))


def dow_sunday0(ts) -> Column:
    """Day of week with Sunday = 0, the numbering the joined panel stores."""
    return F.dayofweek(_c(ts)) - 1


def weekend_flag(day_of_week) -> Column:
    """1 from day number 5 upwards, whichever numbering ``day_of_week`` uses."""
    return F.when(_c(day_of_week) >= 5, 1).otherwise(0)


def is_business_hours(ts) -> Column:
    return F.hour(_c(ts)).between(8, 18).cast("int")


def date_parts(ts, prefix: str = "", week: bool = False) -> dict[str, Column]:
    """Named calendar parts of a timestamp, for one ``withColumns`` call."""
    ts = _c(ts)
    parts = {
        "date": F.to_date(ts),
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "day_of_week": dow_monday0(ts),
        "day_of_year": F.dayofyear(ts),
        "is_weekend": weekend_flag(dow_monday0(ts)),
    }
    if week:
        parts["week_of_year"] = F.weekofyear(ts)
    return {prefix + name: value for name, value in parts.items()}


def day_parts(hour, prefix: str = "time_") -> dict[str, Column]:
    """Morning 6-11, afternoon 12-17, evening 18-21, night the rest."""
    h = _c(hour)
    flags = {
        "morning": h.between(6, 11),
        "afternoon": h.between(12, 17),
        "evening": h.between(18, 21),
        "night": (h < 6) | (h >= 22),
    }
    return {prefix + name: F.when(test, 1).otherwise(0) for name, test in flags.items()}


def cyclic(x, period: float, name: str, offset: int = 0) -> dict[str, Column]:
    """Sine and cosine of a cyclic quantity; ``offset`` is subtracted first."""
    angle = F.lit(2.0 * math.pi) * (_c(x) - F.lit(offset)) / F.lit(float(period))
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}


def forecast_anchor(now, hour: int = 8) -> Column:
    """Last moment at ``hour`` o'clock at or before ``now``."""
    shifted = F.timestamp_add("HOUR", F.lit(-hour), _c(now))
    return F.timestamp_add("HOUR", F.lit(hour), F.date_trunc("DAY", shifted))


def forecast_window(now, hour: int = 8, length: int = 25) -> dict[str, Column]:
    """Start and exclusive end of the prediction window at the anchor."""
    start = forecast_anchor(now, hour)
    return {
        "prediction_start": start,
        "prediction_end": F.timestamp_add("HOUR", F.lit(length), start),
    }
