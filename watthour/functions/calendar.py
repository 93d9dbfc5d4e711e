"""Calendar columns of a timestamp."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: season label per code 1..4, where code = (month % 12 + 3) // 3
SEASON_BY_CODE = ("winter", "spring", "summer", "autumn")
# one-hot columns come sorted by label
SEASONS = tuple(sorted(SEASON_BY_CODE))

# fixed values: hour windows, both ends included
DAYLIGHT_HOURS = (6, 18)
PEAK_HOURS = (10, 14)
SATURDAY = 5

TEMPORAL_COLUMNS = (
    "hour_of_day", "day_of_week", "day_of_year", "month", "quarter",
    "is_daylight", "is_peak_solar", "is_weekend",
    "hour_sin", "hour_cos", "day_of_year_sin", "day_of_year_cos",
    "day_of_week_sin", "day_of_week_cos", "solar_elevation_proxy",
)


def _turn(part: Column, period: int) -> Column:
    return F.lit(2 * math.pi) * part / F.lit(period)


def _flag(condition: Column) -> Column:
    return condition.cast("int")


def season_label(ts: Column) -> Column:
    code = F.floor((F.month(ts) % 12 + 3) / 3).cast("int")
    return F.element_at(F.array(*[F.lit(s) for s in SEASON_BY_CODE]), code)


def season_flags(ts: Column) -> dict[str, Column]:
    """Four booleans, always all four, so the schema never depends on the data."""
    label = season_label(ts)
    return {f"season_{name}": label == F.lit(name) for name in SEASONS}


def temporal_columns(ts: Column) -> dict[str, Column]:
    """Hour, weekday (Monday = 0), day, month, quarter, flags and cyclic encodings."""
    hour, weekday, yearday = F.hour(ts), F.weekday(ts), F.dayofyear(ts)
    values = (
        hour, weekday, yearday, F.month(ts), F.quarter(ts),
        _flag(hour.between(*DAYLIGHT_HOURS)),
        _flag(hour.between(*PEAK_HOURS)),
        _flag(weekday >= SATURDAY),
        F.sin(_turn(hour, 24)), F.cos(_turn(hour, 24)),
        F.sin(_turn(yearday, 365)), F.cos(_turn(yearday, 365)),
        F.sin(_turn(weekday, 7)), F.cos(_turn(weekday, 7)),
        F.sin(_turn(hour, 24)) * F.sin(_turn(yearday, 365)),
    )
    return dict(zip(TEMPORAL_COLUMNS, values))


def calendar_columns(ts: Column) -> dict[str, Column]:
    return {**temporal_columns(ts), **season_flags(ts)}
