"""Readings to scaled training rows, and the same steps on new data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from watthour.functions.frames import join_on
from watthour.operators.checks import leakage_report, rejected_series, require_valid
from watthour.operators.correlation import correlation_pairs, correlation_report, high_pairs
from watthour.operators.dataset import (
    align_columns, feature_families, feature_names, forecast_dataset, numeric_names,
)
from watthour.operators.features import HORIZON, LAG_DAYS, ROLLING_DAYS, calendar_features, lag_features, target_names
from watthour.operators.hourly import hourly_mean
from watthour.operators.profile import (
    drift_statistics, feature_profile, quality_summary, target_stats, target_stats_by_horizon,
)
from watthour.operators.scaling import METHODS, apply_scaler, fit_scaler
from watthour.schemas import TS, VALUE
from watthour.session import written


@dataclass(frozen=True)
class Fitted:
    """What a fit leaves behind: scaling parameters, feature order, settings."""

    params: DataFrame | None
    features: tuple[str, ...]
    lag_days: tuple[int, ...]
    rolling_days: tuple[int, ...]
    method: str
    rejected: DataFrame | None = None

    @property
    def families(self) -> dict[str, int]:
        return feature_families(self.features)


def fit_dataset(readings: DataFrame, ts: str = TS, value: str = VALUE, keys: Sequence[str] = (),
                horizon: int = HORIZON, lag_days: Sequence[int] = LAG_DAYS,
                rolling_days: Sequence[int] = ROLLING_DAYS, method: str = "standard",
                check: bool = True, fit_rows=None, drop_unfit: bool = False) -> tuple[DataFrame, Fitted]:
    """Hourly means, readiness check, features and targets, scaling.

    ``fit_rows`` is a condition that restricts the rows the scaler learns from (the
    training part); without it all rows are used.  A series that fails the readiness check
    stops the fit; with ``drop_unfit`` it is left out and listed with reasons in ``rejected``,
    and only a fit without any series left is an error.
    """
    if method not in METHODS:
        raise ValueError(f"unknown scaling method: {method}")
    hourly = hourly_mean(readings, ts, value, keys)
    rejected = None
    if check and drop_unfit and keys:
        # one row per series, read three times
        report = written(leakage_report(hourly, ts, value, keys, lag_days), "readiness")
        fit = report.where("overall_valid").select(*keys)
        if fit.isEmpty():
            raise ValueError("no series fit for training; see the report")
        hourly, rejected = join_on(hourly, fit, keys, "left_semi"), rejected_series(report, lag_days)
    elif check:
        require_valid(leakage_report(hourly, ts, value, keys, lag_days))
    rows = forecast_dataset(hourly, ts, value, keys, horizon, lag_days, rolling_days)
    names = feature_names(rows, ts, keys, target_names(horizon))
    params = None
    if method != "none":
        learned = fit_scaler(rows if fit_rows is None else rows.where(fit_rows), numeric_names(rows, names))
        # one row per column, kept as values: later runs must not read the training rows again
        params = rows.sparkSession.createDataFrame(learned.collect(), learned.schema)
        rows = apply_scaler(rows, params, method)
    return rows, Fitted(params, tuple(names), tuple(lag_days), tuple(rolling_days), method, rejected)


def transform(readings: DataFrame, fitted: Fitted | None, ts: str = TS, value: str = VALUE,
              keys: Sequence[str] = ()) -> DataFrame:
    """Features of new readings in the fitted order and scale, rows without NULL only."""
    if fitted is None:
        raise RuntimeError("fit before transform")
    hourly = hourly_mean(readings, ts, value, keys)
    rows = calendar_features(
        lag_features(hourly, ts, value, keys, fitted.lag_days, fitted.rolling_days), ts)
    aligned = align_columns(rows, fitted.features, [*keys, ts])
    scaled = aligned if fitted.params is None else apply_scaler(aligned, fitted.params, fitted.method)
    return scaled.dropna()


def collect_reference(rows: DataFrame, features: Sequence[str], targets: Sequence[str]) -> dict[str, DataFrame]:
    """The reference profile of training rows, one long table per kind of statistic."""
    x = rows.select(*features)
    numbers = numeric_names(rows, features)
    profile = written(feature_profile(x), "profile")  # a row per feature, read by two tables
    out = {
        "feature_profile": profile,
        "drift_reference": drift_statistics(x),
        "data_quality": quality_summary(profile),
        "target_profile": target_stats(rows, targets),
        "target_profile_by_horizon": target_stats_by_horizon(rows, targets),
    }
    if len(numbers) >= 2:
        out["correlation_pairs"] = high_pairs(correlation_pairs(x, numbers))
    out["correlation_summary"] = correlation_report(x, numbers)
    return out
