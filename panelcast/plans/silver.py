"""Demand and weather joined and cleaned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalars import cdd, hdd
from panelcast.functions.timecols import dow_sunday0, weekend_flag
from panelcast.operators.joins import join_panel
from panelcast.operators.projection import exclude_aggregates, select_ordered
from panelcast.operators.windows import zscore
from panelcast.schemas import SILVER_COLUMNS, WEATHER_MEASURES


def silver_panel(demand: DataFrame, weather: DataFrame) -> DataFrame:
    """One row per zone and hour of demand with weather, degree hours and date parts.

    Day of week counts from Sunday = 0 here, and 5 and above is flagged as weekend; the feature
    tables use Monday = 0 instead.
    """
    observed = exclude_aggregates(weather).select("zone", "datetime", "datetime_local", *WEATHER_MEASURES)
    observed = observed.withColumns({"hdd18": hdd("temperature_c"), "cdd18": cdd("temperature_c")})
    joined = join_panel(exclude_aggregates(demand), observed)
    parts = {
        "year": F.year("datetime"),
        "month": F.month("datetime"),
        "day": F.dayofmonth("datetime"),
        "hour": F.hour("datetime"),
        "day_of_week": dow_sunday0("datetime"),
        "is_weekend": weekend_flag(dow_sunday0("datetime")),
    }
    return select_ordered(zscore(joined.withColumns(parts), "zone", "demand_mw"), SILVER_COLUMNS)
