"""Exploration: hour and day profiles, weather join, head and tail of a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watthour.functions.frames import join_on
from watthour.schemas import TS, VALUE


def hour_profile(readings: DataFrame, ts: str = TS, value: str = VALUE, keys: Sequence[str] = ()) -> DataFrame:
    return readings.groupBy(*keys, F.hour(ts).alias("hour")).agg(F.avg(value).alias("mean_value"))


def peak_hour(profile: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Hour with the highest mean, the earliest on a tie."""
    place = F.struct(-F.col("mean_value"), F.col("hour"))
    return profile.groupBy(*keys).agg(
        F.min_by("hour", place).alias("peak_hour"), F.max("mean_value").alias("peak_mean"))


def daily_totals(readings: DataFrame, ts: str = TS, value: str = VALUE, keys: Sequence[str] = ()) -> DataFrame:
    return readings.groupBy(*keys, F.to_date(ts).alias("date")).agg(F.sum(value).alias("total_value"))


def gen_weather_join(generation: DataFrame, weather: DataFrame, ts: str = TS, keys: Sequence[str] = ()) -> DataFrame:
    """Readings with the sensor row of the same time; Spark picks the strategy by size."""
    return join_on(generation, weather, [*keys, ts])


def time_slice(series: DataFrame, start, end, ts: str = TS) -> DataFrame:
    """Rows from ``start`` to ``end``, both included."""
    return series.where(F.col(ts).between(start, end))


def first_rows(series: DataFrame, n: int, ts: str = TS) -> DataFrame:
    return series.orderBy(ts).limit(n)


def last_rows(series: DataFrame, n: int, ts: str = TS) -> DataFrame:
    """The latest ``n`` rows (168 = the last week of an hourly series)."""
    return series.orderBy(F.desc(ts)).limit(n)
