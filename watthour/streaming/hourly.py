"""Hourly means with a watermark, and drift scores per micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from watthour.functions.stats import nan_to_null
from watthour.operators.drift import DRIFT_THRESHOLD, detect_drift, drift_log_rows
from watthour.schemas import TS, VALUE


def hourly_mean_stream(readings: DataFrame, late: str = "2 hours", ts: str = TS, value: str = VALUE,
                       keys: Sequence[str] = ()) -> DataFrame:
    """The batch aggregate on a stream: an hour is final once the watermark has passed it.

    State holds one running sum per open hour and key.  Watermarks exist for zoned
    timestamps only, so the time is cast there and back.
    """
    zoned = readings.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    hour = F.window(ts, "1 hour").alias("_hour")
    means = zoned.groupBy(*keys, hour).agg(F.avg(nan_to_null(F.col(value))).alias(value))
    return means.where(F.col(value).isNotNull()).select(
        *keys, F.col("_hour.start").cast("timestamp_ntz").alias(ts), value)


def drift_stream(features: DataFrame, reference: DataFrame, path: str, dataset_name: str = "stream",
                 threshold: float = DRIFT_THRESHOLD, ts: str = TS) -> DataStreamWriter:
    """Writer that scores every micro-batch and stores it under its batch number.

    A batch that is run again after a failure overwrites its own folder, so each
    batch counts once.
    """
    def score(batch: DataFrame, number: int) -> None:
        scores = detect_drift(batch, reference, threshold, ts)
        rows = drift_log_rows(scores, dataset_name, F.current_timestamp())
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return features.writeStream.foreachBatch(score)
