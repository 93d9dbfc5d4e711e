"""The daily forecast run, for any number of series and dates in one plan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watthour.operators.drift import DRIFT_THRESHOLD, detect_drift, drift_log_rows, drift_summary
from watthour.operators.dataset import align_columns
from watthour.operators.forecast import (
    forecast_day_metrics, forecast_validate, midnight_features, naive_forecast, require_history,
)
from watthour.operators.models import predict_horizons
from watthour.operators.scaling import apply_scaler
from watthour.plans.training import Fitted
from watthour.schemas import TS, VALUE
from watthour.session import drop_written, written
from watthour.sources.tables import append_drift, save_predictions


def model_forecast(hourly: DataFrame, start: date, end: date, fitted: Fitted, models: dict,
                   ts: str = TS, value: str = VALUE, keys: Sequence[str] = (),
                   scaled: bool = True, calendar_at: str = "noon") -> tuple[DataFrame, DataFrame]:
    """(features, forecasts) of fitted models at each midnight.

    Features are scaled as in training unless ``scaled`` is false.  Training rows carry
    the calendar of their own hour; ``calendar_at="anchor"`` does the same here.  A row whose history is
    too short for some feature has a NULL forecast, and ``reason`` names the missing features
    (NULL otherwise).
    """
    features = model_features(hourly, start, end, fitted, ts, value, keys, scaled, calendar_at)
    return features, forecast_features(features, fitted, models, keys)


def model_features(hourly: DataFrame, start: date, end: date, fitted: Fitted, ts: str = TS, value: str = VALUE,
                   keys: Sequence[str] = (), scaled: bool = True, calendar_at: str = "noon") -> DataFrame:
    """The fitted features at each midnight, in their order."""
    raw = midnight_features(hourly, start, end, ts, value, keys, fitted.lag_days, fitted.rolling_days,
                            calendar_at)
    features = align_columns(raw, fitted.features, [*keys, "prediction_date", "anchor_ts"])
    if scaled and fitted.params is not None:
        features = apply_scaler(features, fitted.params, fitted.method)
    return features


def forecast_features(features: DataFrame, fitted: Fitted, models: dict, keys: Sequence[str] = ()) -> DataFrame:
    """Forecast, or the reason why there is none, of each row of features."""
    ids = [*keys, "prediction_date", "anchor_ts"]
    lacking = F.array_compact(F.array(*[
        F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), F.lit(c)) for c in fitted.features]))
    reason = F.when(F.size(lacking) > 0, F.concat(F.lit("missing features: "), F.concat_ws(", ", lacking)))
    judged = features.withColumn("reason", reason).fillna(0, subset=list(fitted.features))
    predicted = predict_horizons(judged, fitted.features, models)
    forecast = F.array(*[F.col(f"pred_{h}") for h in sorted(models)])
    return predicted.select(*ids, F.when(F.col("reason").isNull(), forecast).alias("forecast_24h"), "reason")


def prediction_rows(forecasts: DataFrame, model_name: str | Column, features_count: int, at: Column,
                    strict: bool = True) -> DataFrame:
    """Day figures and checks, in the shape of the predictions table (plus series keys)."""
    name = F.lit(model_name) if isinstance(model_name, str) else model_name
    checked = forecast_validate(forecasts, strict=strict)
    return forecast_day_metrics(checked).withColumns({
        "model_name": name,
        "features_count": F.lit(features_count),
        "prediction_timestamp": at.cast("timestamp_ntz"),
        "created_at": at.cast("timestamp_ntz"),
    })


def naive_run(hourly: DataFrame, start: date, end: date, at: Column, model_name: str = "seasonal_naive",
              ts: str = TS, value: str = VALUE, keys: Sequence[str] = ()) -> DataFrame:
    """Daily run of the seasonal-naive baseline; short forecasts are flagged, not raised."""
    forecasts = naive_forecast(hourly, start, end, ts, value, keys)
    return prediction_rows(forecasts, model_name, 0, at, strict=False)


def daily_run(hourly: DataFrame, start: date, end: date, fitted: Fitted, models: dict, model_name: str,
              at: Column, predictions_path: str, reference: DataFrame | None = None,
              drift_path: str | None = None, ts: str = TS, value: str = VALUE, keys: Sequence[str] = (),
              calendar_at: str = "noon") -> DataFrame:
    """Forecast, check, store, and score drift for every series and date.

    Returns a row for every series and date with history; those without a forecast say why
    in ``reason`` and are not stored.  A date before which no series has a row, a forecast of
    the wrong length or a key that is taken stops the run.  Features and forecasts are computed
    once and written to the shared folder; the rows returned are read from there.
    """
    features = written(model_features(hourly, start, end, fitted, ts, value, keys, calendar_at=calendar_at), "features")
    try:
        forecasts = written(forecast_features(features, fitted, models, keys), "forecasts")
        require_history(forecasts, [start + timedelta(days=i) for i in range((end - start).days + 1)])
        rows = prediction_rows(forecasts, model_name, len(fitted.features), at)
        save_predictions(rows.where("reason IS NULL").drop("reason"), predictions_path, keys)
        quick_drift_check(features.drop(*keys), reference, at, drift_path)
    finally:
        drop_written(features)
    return rows


def drift_check(features: DataFrame, reference: DataFrame, at: Column, dataset_name: str = "batch_predictions",
                keys: Sequence[str] = ()) -> DataFrame:
    """Score the features of a run and shape the result for the drift log."""
    return drift_log_rows(detect_drift(features.drop("anchor_ts", "prediction_date"), reference, keys=keys),
                          dataset_name, at)


def quick_drift_check(features: DataFrame, reference: DataFrame | None, at: Column, drift_path: str | None = None,
                      dataset_name: str = "batch_predictions", threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Summary row of a drift check, logged to ``drift_path`` if given.

    Without a reference nothing is scored and ``drift_detection_failed`` is true.
    """
    spark = features.sparkSession
    missing = reference is None
    if missing:
        reference = spark.createDataFrame([], "feature string, mean double, std double")
    scores = detect_drift(features.drop("anchor_ts", "prediction_date"), reference, threshold)
    if drift_path is not None and not missing:
        append_drift(drift_log_rows(scores, dataset_name, at), drift_path)
    return drift_summary(scores, threshold).withColumns({
        "drift_detection_failed": F.lit(missing),
        "reason": F.lit("no_reference_data" if missing else None).cast("string"),
    })
