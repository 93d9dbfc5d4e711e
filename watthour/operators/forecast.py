"""Day-ahead forecasts: features at midnight for many dates at once, day figures, checks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from watthour.functions.calendar import DAYLIGHT_HOURS, calendar_columns
from watthour.functions.frames import join_on
from watthour.operators.blocks import Stage, over_rows
from watthour.operators.features import (
    DAY, HORIZON, LAG_DAYS, ROLLING_DAYS, WEEK, check_settings, lag_columns, reach, rolling_stages,
)
from watthour.schemas import TS, VALUE

# fixed values: hour whose calendar stands for the whole forecast day, plausible power limit
NOON = 12
POWER_LIMIT = 1000.0


def naive_predictions(window: WindowSpec, value: str = VALUE, horizon: int = HORIZON,
                      season: int = DAY) -> list[Column]:
    """Seasonal-naive forecasts of the next rows: the value one ``season`` before each."""
    def at(h: int) -> Column:
        back = season - h if h <= season else -((h - 1) % season) + season - 1
        return (F.lag(value, back) if back else F.lag(value, 0)).over(window)
    return [at(h) for h in range(1, horizon + 1)]


def at_midnights(hourly: DataFrame, stages: Sequence[Stage], start: date, end: date, *,
                 ts: str = TS, keys: Sequence[str] = (), behind: int = 0,
                 block_rows: int | None = None) -> DataFrame:
    """The last row before each midnight from ``start`` to ``end``, with columns over its past.

    A row serves the midnights after it up to its successor's date, so it is repeated
    once for each and no as-of join is needed.  Dates without history give no row.
    """
    rows = over_rows(
        hourly, *stages, lambda w: {"_next": F.lead(ts).over(w)},
        ts=ts, keys=keys, behind=behind, ahead=1, block_rows=block_rows,
    )
    first = F.greatest(F.date_add(F.to_date(ts), 1), F.lit(start))
    last = F.least(F.coalesce(F.to_date("_next"), F.lit(end)), F.lit(end))
    serving = rows.where(first <= last)
    return serving.withColumn("prediction_date", F.explode(F.sequence(first, last))).drop("_next")


def midnight_features(hourly: DataFrame, start: date, end: date, ts: str = TS, value: str = VALUE,
                      keys: Sequence[str] = (), lag_days: Sequence[int] = LAG_DAYS,
                      rolling_days: Sequence[int] = ROLLING_DAYS, calendar_at: str = "noon",
                      block_rows: int | None = None) -> DataFrame:
    """One complete feature row per series and date: lags as of the last row before
    midnight, calendar at noon of the day (or at that row, with ``calendar_at="anchor"``)."""
    check_settings(1, lag_days, rolling_days)
    if calendar_at not in ("noon", "anchor"):
        raise ValueError("calendar_at must be 'noon' or 'anchor'")
    rows = at_midnights(
        hourly,
        rolling_stages(value, rolling_days, lambda w: lag_columns(w, value, lag_days)),
        start, end, ts=ts, keys=keys, behind=reach(lag_days, rolling_days), block_rows=block_rows,
    )
    noon = F.col("prediction_date").cast("timestamp_ntz") + F.expr(f"INTERVAL {NOON} HOURS")
    moment = noon if calendar_at == "noon" else F.col(ts)
    history = [c for c in rows.columns if c not in {*hourly.columns, "prediction_date"}]
    return rows.select(
        *keys, "prediction_date", F.col(ts).alias("anchor_ts"), *history,
        *[c.alias(n) for n, c in calendar_columns(moment).items()],
    )


def require_history(features: DataFrame, dates: Sequence[date]) -> None:
    """Raise if some asked-for date has no row before its midnight."""
    asked = features.sparkSession.createDataFrame([(d,) for d in dates], "prediction_date date")
    lacking = sorted(r[0] for r in asked.join(features, "prediction_date", "left_anti").collect())  # asked dates at most
    if lacking:
        raise ValueError(f"no history before midnight of {', '.join(map(str, lacking))}")


def naive_forecast(hourly: DataFrame, start: date, end: date, ts: str = TS, value: str = VALUE,
                   keys: Sequence[str] = (), horizon: int = HORIZON, season: int = DAY,
                   block_rows: int | None = None) -> DataFrame:
    """Seasonal-naive forecast arrays made at each midnight."""
    rows = at_midnights(
        hourly, [lambda w: {"forecast_24h": F.array(*naive_predictions(w, value, horizon, season))}],
        start, end, ts=ts, keys=keys, behind=max(season, WEEK), block_rows=block_rows,
    )
    return rows.select(*keys, "prediction_date", F.col(ts).alias("anchor_ts"), "forecast_24h")


def forecast_steps(forecasts: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Long form of forecast arrays: horizon, the hour it is for, predicted value."""
    steps = forecasts.select(*ids, "anchor_ts", F.posexplode("forecast_24h").alias("_i", "y_hat"))
    horizon = (F.col("_i") + 1).cast("int")
    return steps.select(
        *ids, "anchor_ts", horizon.alias("horizon"),
        (F.col("anchor_ts") + F.make_dt_interval(hours=horizon)).alias("target_ts"), "y_hat",
    )


def forecast_vs_actual(steps: DataFrame, hourly: DataFrame, ids: Sequence[str], keys: Sequence[str] = (),
                       ts: str = TS, value: str = VALUE, horizon: int = HORIZON) -> DataFrame:
    """Predicted and actual hour by hour, for forecasts whose every hour has an actual."""
    actual = hourly.select(*keys, F.col(ts).alias("target_ts"), F.col(value).alias("y"))
    pairs = join_on(steps, actual, [*keys, "target_ts"])
    known = F.count("*").over(Window.partitionBy(*ids))
    return pairs.withColumn("_known", known).where(F.col("_known") == horizon).drop("_known")


def forecast_day_accuracy(pairs: DataFrame, ids: Sequence[str]) -> DataFrame:
    """rmse and mae of each forecast day, and the day's actual peak and energy."""
    error = F.col("y") - F.col("y_hat")
    return pairs.groupBy(*ids).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"),
        F.max("y").alias("actual_peak"), F.sum("y").alias("actual_energy"),
    )


def daylight_slice(rows: DataFrame, ts: str = TS) -> DataFrame:
    return rows.where(F.hour(ts).between(*DAYLIGHT_HOURS))


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, x: a + x)


def forecast_day_metrics(forecasts: DataFrame, array: str = "forecast_24h") -> DataFrame:
    """Peak, 1-based peak hour (first on a tie), energy of the day, of items 6..18, of the rest."""
    power = F.col(array)
    lo, hi = DAYLIGHT_HOURS
    day = _sum(F.slice(power, lo + 1, hi - lo + 1))
    night = _sum(F.slice(power, 1, lo)) + _sum(F.slice(power, hi + 2, HORIZON))
    return forecasts.withColumns({
        "peak_power": F.array_max(power),
        "peak_hour": F.array_position(power, F.array_max(power)).cast("int"),
        "total_energy": _sum(power),
        "daylight_energy": day,
        "night_energy": night,
    })


def forecast_validate(forecasts: DataFrame, array: str = "forecast_24h", horizon: int = HORIZON,
                      limit: float = POWER_LIMIT, strict: bool = False) -> DataFrame:
    """Length (an error), negative values and implausible power (warnings) per forecast."""
    power = F.col(array)
    length = F.size(power)
    checked = forecasts.withColumns({
        "forecast_length": length,
        "negative_predictions": F.size(F.filter(power, lambda x: x < 0)),
        "max_power": F.array_max(power),
        "high_power": F.coalesce(F.array_max(power) > limit, F.lit(False)),
        "validation_passed": length == horizon,
        "error": F.when(length != horizon,
                        F.format_string(f"Invalid forecast length: %d, expected {horizon}", length)),
    })
    if strict:
        bad = checked.where(~F.col("validation_passed")).select("error").first()
        if bad:
            raise ValueError(bad["error"])
    return checked


def hourly_arrays(hourly: DataFrame, ts: str = TS, value: str = VALUE, keys: Sequence[str] = ()) -> DataFrame:
    """The hours of each day as one array in time order (at most 24 items)."""
    items = F.array_sort(F.collect_list(F.struct(F.col(ts).alias("t"), F.col(value).alias("v"))))
    days = hourly.groupBy(*keys, F.to_date(ts).alias("prediction_date")).agg(items.alias("_items"))
    return days.select(*keys, "prediction_date", F.transform("_items", lambda i: i["v"]).alias("forecast_24h"))
