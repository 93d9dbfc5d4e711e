"""Trend queries, dashboard panels, health and recommendations over the logs.

All lookbacks count from an explicit ``as_of``; nothing reads the wall clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watthour.functions.stats import percent

# fixed values: drift rate (percent) above which to retrain, below which all is normal
RETRAIN_ABOVE = 20
NORMAL_BELOW = 10
DASHBOARD_DAYS = 30
RATE_DAYS = 7


def since(column: str, as_of: Column, days: int) -> Column:
    return F.col(column) >= as_of.cast("timestamp_ntz") - F.expr(f"INTERVAL {days} DAYS")


def drift_daily(log: DataFrame, as_of: Column, days: int = RATE_DAYS, digits: int = 1) -> DataFrame:
    """Checks, drifted checks and rate per day; sort by ``drift_date`` for display."""
    recent = log.where(since("timestamp", as_of, days))
    daily = recent.groupBy(F.to_date("timestamp").alias("drift_date")).agg(
        F.count("*").alias("total_features"), F.count_if("drift_detected").alias("drifted_features"))
    rate = F.round(percent(F.col("drifted_features"), F.col("total_features")), digits)
    return daily.withColumn("drift_rate", rate)


def panel_daily_drift(log: DataFrame, as_of: Column, days: int = DASHBOARD_DAYS) -> DataFrame:
    day = F.col("drift_date").cast("timestamp_ntz").alias("time")
    return drift_daily(log, as_of, days, 2).select(day, "total_features", "drifted_features", "drift_rate")


def drift_rate(log: DataFrame, as_of: Column, days: int = RATE_DAYS) -> DataFrame:
    """Overall rate over the lookback, 0 when it holds no check."""
    recent = log.where(since("timestamp", as_of, days))
    totals = recent.agg(
        F.count("*").alias("total_feature_checks"), F.count_if("drift_detected").alias("total_drift_events"))
    rate = percent(F.col("total_drift_events"), F.col("total_feature_checks"))
    return totals.select(
        F.lit(days).alias("analysis_period_days"), "total_drift_events", "total_feature_checks",
        F.coalesce(F.round(rate, 2), F.lit(0.0)).alias("overall_drift_rate"),
    )


def drift_top(log: DataFrame, as_of: Column, n: int = 5, days: int = RATE_DAYS) -> DataFrame:
    """Features that drifted most often, names breaking ties."""
    hits = log.where(since("timestamp", as_of, days) & F.col("drift_detected"))
    counts = hits.groupBy("feature_name").agg(
        F.count("*").alias("drift_count"), F.round(F.avg("drift_score"), 3).alias("avg_drift_score"))
    return counts.orderBy(F.desc("drift_count"), "feature_name").limit(n)


def prediction_stats(predictions: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    recent = predictions.where(since("prediction_date", as_of, days))
    return recent.agg(
        F.count("*").alias("total_predictions"),
        F.count_distinct("prediction_date").alias("unique_dates"),
        F.count_distinct("model_name").alias("unique_models"),
        *[F.avg(c).alias(f"avg_{c}") for c in ("peak_power", "total_energy", "daylight_energy")
          if c in predictions.columns],
        F.min("peak_power").alias("min_peak_power"), F.max("peak_power").alias("max_peak_power"),
        F.min("prediction_date").alias("earliest_date"), F.max("prediction_date").alias("latest_date"),
    )


def panel_prediction_trend(predictions: DataFrame, as_of: Column, days: int = DASHBOARD_DAYS) -> DataFrame:
    recent = predictions.where(since("created_at", as_of, days))
    day = F.to_date("created_at").cast("timestamp_ntz").alias("time")
    return recent.groupBy(day).agg(
        F.avg("peak_power").alias("avg_peak_power"), F.avg("total_energy").alias("avg_total_energy"))


def _stat(name: str, column: Column) -> list[Column]:
    return [F.lit(name).alias("metric"), column.cast("double").alias("value")]


def panel_stats(predictions: DataFrame, log: DataFrame, references: DataFrame,
                predictions_as_of: Column, log_as_of: Column) -> DataFrame:
    """Four single-number panels as (metric, value) rows."""
    lately = predictions.where(since("created_at", predictions_as_of, 1))
    week = drift_rate(log, log_as_of)
    rate = percent(F.col("total_drift_events"), F.col("total_feature_checks"))
    parts = [
        lately.agg(F.count("*").alias("n")).select(*_stat("total_predictions_24h", F.col("n"))),
        week.select(*_stat("current_drift_rate", F.round(rate, 2))),
        references.agg(F.count("*").alias("n")).select(*_stat("reference_models", F.col("n"))),
        log.agg(F.count_if("drift_detected").alias("n")).select(*_stat("total_drift_events", F.col("n"))),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def monitor_health(references: DataFrame, performance: DataFrame, log: DataFrame,
                   predictions: DataFrame, predictions_as_of: Column) -> DataFrame:
    """Rows per table, predictions of the last day, and the overall verdict, as one row."""
    lately = predictions.where(since("created_at", predictions_as_of, 1))
    tables = {"reference_data_records": references, "performance_records": performance,
              "drift_records": log, "recent_predictions_24h": lately}
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).withColumn("t", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    wide = counts.agg(*[F.max(F.when(F.col("t") == name, F.col("n"))).alias(name) for name in tables])
    have = F.col("reference_data_records") > 0
    return wide.withColumns({
        "reference_data_available": have,
        "overall_healthy": have & (F.col("recent_predictions_24h") > 0),
    })


def recommendations(rate: Column, recent: Column, have_reference: Column, healthy: Column) -> Column:
    """Array of advice codes, in the order of the rules."""
    rules = (
        (rate > RETRAIN_ABOVE, "high_drift_consider_retraining"),
        (recent == 0, "no_recent_predictions_check_daily_run"),
        (~have_reference, "no_reference_run_training"),
        ((rate < NORMAL_BELOW) & healthy, "operating_normally"),
    )
    return F.array_compact(F.array(*[F.when(rule, F.lit(advice)) for rule, advice in rules]))


def monitor_report(rate: DataFrame, health: DataFrame, top: DataFrame, lines: int = 3) -> DataFrame:
    """One row: drift figures, health, the top features as text, and the advice.

    The single-row inputs are stacked and folded into one row.
    """
    ranked = top.orderBy(F.desc("drift_count"), "feature_name").limit(lines)
    text = F.format_string("%s: %d events", F.col("feature_name"), F.col("drift_count"))
    listed = ranked.agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("drift_count")).alias("n"), F.col("feature_name").alias("f"), text.alias("text")))).alias("_top"))
    parts = rate.unionByName(health, allowMissingColumns=True).unionByName(listed, allowMissingColumns=True)
    joined = parts.agg(*[F.first(c, ignorenulls=True).alias(c) for c in parts.columns])
    advice = recommendations(
        F.col("overall_drift_rate"), F.col("recent_predictions_24h"),
        F.col("reference_data_available"), F.col("overall_healthy"))
    return joined.withColumn("_advice", advice).select(
        "analysis_period_days", "overall_drift_rate", "total_drift_events", "overall_healthy",
        "reference_data_records", "recent_predictions_24h",
        F.concat_ws("; ", F.transform("_top", lambda t: t["text"])).alias("top_drifted_features"),
        F.concat_ws("; ", "_advice").alias("recommendations"),
        F.size("_advice").alias("recommendations_count"),
    )
