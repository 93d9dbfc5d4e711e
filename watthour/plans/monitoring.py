"""The monitoring run: trends, health and report over the logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from watthour.operators.monitor import drift_daily, drift_rate, drift_top, monitor_health, monitor_report


def monitoring_run(log: DataFrame, predictions: DataFrame, references: DataFrame, performance: DataFrame,
                   as_of: Column, days: int = 7) -> dict[str, DataFrame]:
    rate = drift_rate(log, as_of, days)
    top = drift_top(log, as_of, 5, days)
    health = monitor_health(references, performance, log, predictions, as_of)
    return {
        "drift_by_day": drift_daily(log, as_of, days),
        "drift_rate": rate,
        "top_drifted": top,
        "health": health,
        "report": monitor_report(rate, health, top),
    }
