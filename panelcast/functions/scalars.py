"""Feature arithmetic as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def delta(a, b) -> Column:
    return _c(a) - _c(b)


def pct_change(a, b, scale: float = 1.0, eps: float = 0.0) -> Column:
    """Relative change of ``a`` against ``b``; null when ``|b|`` is not above ``eps``."""
    a, b = _c(a), _c(b)
    return F.when(F.abs(b) > eps, (a - b) / b * F.lit(float(scale)))


def safe_ratio(a, b, eps: float = 0.0) -> Column:
    a, b = _c(a), _c(b)
    return F.when(F.abs(b) > eps, a / b)


def _degree_hours(excess: Column, null_safe: bool) -> Column:
    # greatest() skips nulls, so a missing temperature reads as zero degree hours
    hours = F.greatest(excess, F.lit(0.0))
    return F.when(excess.isNotNull(), hours) if null_safe else hours


def hdd(t, base: float = 18.0, null_safe: bool = False) -> Column:
    """Heating degree hours below ``base``; ``null_safe`` keeps a missing value missing."""
    return _degree_hours(F.lit(base) - _c(t), null_safe)


def cdd(t, base: float = 18.0, null_safe: bool = False) -> Column:
    """Cooling degree hours above ``base``."""
    return _degree_hours(_c(t) - F.lit(base), null_safe)


# Coefficients of the published wet-bulb fit (temperature in C, humidity in %).
WET_BULB = {
    "atan_scale": 0.151977,
    "humidity_shift": 8.313659,
    "humidity_offset": 1.676331,
    "power_scale": 0.00391838,
    "power": 1.5,
    "power_atan": 0.023101,
    "constant": 4.686035,
}


def wet_bulb(t, rh) -> Column:
    """Wet-bulb temperature from temperature and relative humidity."""
    t, rh, k = _c(t), _c(rh), WET_BULB
    main = t * F.atan(k["atan_scale"] * F.sqrt(rh + k["humidity_shift"]))
    angles = F.atan(t + rh) - F.atan(rh - k["humidity_offset"])
    damp = k["power_scale"] * F.pow(rh, F.lit(k["power"])) * F.atan(k["power_atan"] * rh)
    return main + angles + damp - k["constant"]


def heat_index(t, rh) -> Column:
    return _c(t) + _c(rh) / F.lit(100) * F.lit(2)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.when(condition, 1).otherwise(0)


def interact(pairs: Iterable[tuple[str, str]]) -> dict[str, Column]:
    """Products of column pairs, named ``a_x_b``."""
    return {f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in pairs}


def target_weather(prefix: str = "weather_target_") -> dict[str, Column]:
    """Derived weather of the target hour from its five measures."""
    t, dew = F.col(prefix + "temperature_c"), F.col(prefix + "dew_point_c")
    rh, wind = F.col(prefix + "relative_humidity_pct"), F.col(prefix + "wind_speed_kmh")
    rain = F.coalesce(F.col(prefix + "precipitation_mm"), F.lit(0.0))
    derived = {
        "temperature_sq": F.pow(t, F.lit(2.0)),
        "temperature_cube": F.pow(t, F.lit(3.0)),
        "hdd18": hdd(t, 18.0),
        "cdd18": cdd(t, 18.0),
        "hdd15_5": hdd(t, 15.5),
        "cdd15_5": cdd(t, 15.5),
        "temp_dew_spread": delta(t, dew),
        "wet_bulb_approx_c": wet_bulb(t, rh),
        "is_precipitation": flag(rain > 0.0),
        "is_high_humidity": flag(rh >= 80.0),
        "is_strong_wind": flag(wind >= 30.0),
    }
    return {prefix + name: value for name, value in derived.items()}


def weather_interactions(prefix: str = "weather_target_") -> dict[str, Column]:
    """Products of the target weather with hour of day, weekend and humidity."""
    out = {}
    for measure, column in (("temperature", "temperature_c"), ("hdd18", "hdd18"), ("cdd18", "cdd18")):
        for wave in ("sin", "cos"):
            product = F.col(prefix + column) * F.col(f"target_hour_{wave}")
            out[f"{prefix}{measure}_x_hour_{wave}"] = product
    for measure in ("hdd18", "cdd18"):
        out[f"{prefix}{measure}_x_weekend"] = F.col(prefix + measure) * F.col("target_is_weekend")
    humid = F.col(prefix + "temperature_c") * F.col(prefix + "relative_humidity_pct")
    out[prefix + "temperature_x_humidity"] = humid
    return out


def holiday_interactions(prefix: str = "weather_target_") -> dict[str, Column]:
    holiday = F.col("is_holiday")
    out = {f"{prefix}{m}_x_holiday": F.col(prefix + m) * holiday for m in ("hdd18", "cdd18")}
    out |= {f"holiday_x_target_hour_{w}": holiday * F.col(f"target_hour_{w}") for w in ("sin", "cos")}
    return out


def horizon_features(h="forecast_horizon_hours") -> dict[str, Column]:
    """Position of a horizon in its day and week, its cycles and two damped forms."""
    h = _c(h)
    angle = F.lit(2.0 * 3.141592653589793) * h
    return {
        "forecast_day": (F.floor((h - 1) / 24) + 1).cast("int"),
        "forecast_hour_in_day": (F.pmod(h - 1, F.lit(24)) + 1).cast("int"),
        "forecast_horizon_sin_24h": F.sin(angle / 24.0),
        "forecast_horizon_cos_24h": F.cos(angle / 24.0),
        "forecast_horizon_sin_168h": F.sin(angle / 168.0),
        "forecast_horizon_cos_168h": F.cos(angle / 168.0),
        "forecast_horizon_sqrt": F.sqrt(h),
        "forecast_horizon_log1p": F.log1p(h),
    }
