"""Lag, rolling and calendar features that are known at prediction time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from watthour.functions.calendar import calendar_columns
from watthour.operators.blocks import SCRATCH, Stage, over_rows
from watthour.schemas import TS, VALUE

DAY = 24
WEEK = 7 * DAY
# fixed values: default lags and rolling windows, in days
LAG_DAYS = (1, 2, 3, 7, 30)
ROLLING_DAYS = (7, 30)
# fixed values: forecast length in hours
HORIZON = 24
SAME_HOUR = ("same_hour_last_week", "same_hour_2_weeks_ago", "same_weekday_last_week")


def check_settings(horizon: int, lag_days: Sequence[int], rolling_days: Sequence[int] = ()) -> None:
    if horizon <= 0:
        raise ValueError("horizon must be positive")
    if not lag_days or min(lag_days) <= 0:
        raise ValueError("lag_days must hold positive integers")
    if rolling_days and min(rolling_days) <= 0:
        raise ValueError("rolling_days must hold positive integers")


def lag_columns(window: WindowSpec, value: str = VALUE, lag_days: Sequence[int] = LAG_DAYS) -> dict[str, Column]:
    """Value some whole days back, by row; and the same hour one and two weeks back."""
    back = {f"ac_power_lag_{d}d": F.lag(value, DAY * d).over(window) for d in sorted(lag_days)}
    weeks = dict(zip(SAME_HOUR, (1, 2, 1)))
    return {**back, **{name: F.lag(value, WEEK * n).over(window) for name, n in weeks.items()}}


# what is known of a run of rows: count, mean, squared deviations from it, maximum
_PARTS = ("n", "mean", "sq", "max")


def _part(name: str, level: int, back: int | None = None) -> str:
    return f"{SCRATCH}{name}{level}" + ("" if back is None else f"_{back}")


def _runs(days: int) -> list[tuple[int, int]]:
    """Split a window of whole days into runs of 2**level days: (level, rows back)."""
    runs, back = [], DAY
    for level in range(days.bit_length()):
        if days >> level & 1:
            runs.append((level, back))
            back += DAY << level
    return runs


def _lagged(level: int, back: int) -> Stage:
    """A run that ended ``back`` rows ago; before the series starts it is an empty run."""
    empty = {"n": 0, "mean": 0.0, "sq": 0.0, "max": None}
    return lambda w: {
        _part(p, level, back): F.lag(_part(p, level), back, empty[p]).over(w) for p in _PARTS
    }


def _size_mean_max(runs: Sequence[str]) -> tuple[Column, Column, Column]:
    """Count, mean (0 if empty) and maximum of several runs taken together."""
    n = sum((F.col(r.format("n")) for r in runs[1:]), F.col(runs[0].format("n")))
    total = sum((F.col(r.format("n")) * F.col(r.format("mean")) for r in runs[1:]),
                F.col(runs[0].format("n")) * F.col(runs[0].format("mean")))
    tops = [F.col(r.format("max")) for r in runs]
    return n, F.when(n > 0, total / n).otherwise(0.0), F.greatest(*tops) if len(tops) > 1 else tops[0]


def _squares(runs: Sequence[str], mean: str) -> Column:
    """Squared deviations of several runs from their common mean."""
    def one(r: str) -> Column:
        off = F.col(r.format("mean")) - F.col(mean)
        return F.col(r.format("sq")) + F.col(r.format("n")) * off * off
    return sum((one(r) for r in runs[1:]), one(runs[0]))


def rolling_stages(value: str = VALUE, days: Sequence[int] = ROLLING_DAYS, beside: Stage | None = None) -> list[Stage]:
    """Mean, sample deviation and maximum of windows that ended a day ago.

    A frame of 720 rows would be added up anew for every row.  Instead the last 24 rows
    are summed up once, runs of 2, 4, 8, ... days come from two runs half as long, and a
    window is put together from the runs that make it up (30 days = 2 + 4 + 8 + 16).
    Windows less than half full are NULL.  ``beside`` adds columns to the last pass over
    the window, so that they are not carried through the others.
    """
    def one_day(w: WindowSpec) -> dict[str, Column]:
        frame = w.rowsBetween(1 - DAY, 0)
        count = F.count(value).over(frame)
        return {
            _part("n", 0): count,
            _part("mean", 0): F.coalesce(F.avg(value).over(frame), F.lit(0.0)),
            _part("sq", 0): F.coalesce(F.var_pop(value).over(frame) * count, F.lit(0.0)),
            _part("max", 0): F.max(value).over(frame),
        }

    # means become columns before deviations are taken from them
    def double(level: int) -> list[Stage]:
        runs = [f"{SCRATCH}{{}}{level}", f"{SCRATCH}{{}}{level}_{DAY << level}"]
        n, mean, top = _size_mean_max(runs)
        up = level + 1
        return [
            lambda w: {_part("n", up): n, _part("mean", up): mean, _part("max", up): top},
            lambda w: {_part("sq", up): _squares(runs, _part("mean", up))},
        ]

    stages: list[Stage] = [one_day]
    for level in range(max(days).bit_length() - 1):
        stages += [_lagged(level, DAY << level), *double(level)]
    pieces = sorted({run for d in days for run in _runs(d)})
    stages.append(lambda w: {
        **{k: c for run in pieces for k, c in _lagged(*run)(w).items()}, **(beside(w) if beside else {})})

    whole = {d: [f"{SCRATCH}{{}}{level}_{back}" for level, back in _runs(d)] for d in sorted(days)}

    def sizes(w: WindowSpec) -> dict[str, Column]:
        names = ("size", "centre", "top")
        return {f"{SCRATCH}{name}_{d}d": c for d, runs in whole.items() for name, c in zip(names, _size_mean_max(runs))}

    def windows(w: WindowSpec) -> dict[str, Column]:
        out = {}
        for d, runs in whole.items():
            size, centre, top = (F.col(f"{SCRATCH}{name}_{d}d") for name in ("size", "centre", "top"))
            enough = size >= DAY * d // 2
            out[f"rolling_mean_{d}d"] = F.when(enough, centre)
            std = F.sqrt(_squares(runs, f"{SCRATCH}centre_{d}d") / (size - 1))
            out[f"rolling_std_{d}d"] = F.when(enough & (size > 1), std)
            out[f"rolling_max_{d}d"] = F.when(enough, top)
        return out

    return [*stages, sizes, windows]


def target_columns(window: WindowSpec, value: str = VALUE, horizon: int = HORIZON) -> dict[str, Column]:
    return {name: F.lead(value, h).over(window) for h, name in enumerate(target_names(horizon), start=1)}


def target_names(horizon: int = HORIZON) -> list[str]:
    return [f"ac_power_{h}h" for h in range(1, horizon + 1)]


def reach(lag_days: Sequence[int], rolling_days: Sequence[int]) -> int:
    """Rows of history the features look back on."""
    rolling = [DAY * d + DAY - 1 for d in rolling_days]
    return max([DAY * d for d in lag_days] + rolling + [2 * WEEK])


def lag_features(hourly: DataFrame, ts: str = TS, value: str = VALUE, keys: Sequence[str] = (),
                 lag_days: Sequence[int] = LAG_DAYS, rolling_days: Sequence[int] = ROLLING_DAYS,
                 block_rows: int | None = None) -> DataFrame:
    check_settings(1, lag_days, rolling_days)
    return over_rows(
        hourly, *rolling_stages(value, rolling_days, lambda w: lag_columns(w, value, lag_days)),
        ts=ts, keys=keys, behind=reach(lag_days, rolling_days), block_rows=block_rows,
    )


def lead_targets(hourly: DataFrame, ts: str = TS, value: str = VALUE, keys: Sequence[str] = (),
                 horizon: int = HORIZON, block_rows: int | None = None) -> DataFrame:
    check_settings(horizon, (1,))
    return over_rows(hourly, lambda w: target_columns(w, value, horizon),
                     ts=ts, keys=keys, ahead=horizon, block_rows=block_rows)


def calendar_features(df: DataFrame, ts: str = TS) -> DataFrame:
    return df.withColumns(calendar_columns(F.col(ts)))
