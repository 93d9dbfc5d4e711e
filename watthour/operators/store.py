"""Rules for the logs and profile tables: conflict-free append, upsert, retention, latest.

All take and return DataFrames; ``sources.tables`` writes the results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watthour.functions.frames import join_on

# fixed values: versions kept per model, and stages that are never archived
KEEP_LATEST = 5
PROTECTED_STAGES = ("Production", "Staging", "Archived")


def append_dedup(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """The incoming rows whose key is not taken yet.

    Keys are made distinct first, map side, so a key with many rows is one row here.
    """
    return join_on(incoming, existing.select(*key).distinct(), key, "left_anti")


def conflicts(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """The incoming rows whose key exists already."""
    return join_on(incoming, existing.select(*key).distinct(), key, "left_semi")


def repeated_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def upsert(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Incoming rows replace existing rows of the same key."""
    return append_dedup(incoming, existing, key).unionByName(incoming)


def latest_by(rows: DataFrame, key: Sequence[str], order: Sequence[str], n: int = 1) -> DataFrame:
    """The ``n`` rows per key that are highest in ``order``.  Spark limits each task's rows per key before the
    shuffle, so a key with most of the rows brings at most ``n`` per task."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order]))
    return rows.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def select_profile(profiles: DataFrame, model_name: str, model_version: str | None = None) -> DataFrame:
    """Reference rows of one model: the given version, else the newest one."""
    mine = profiles.where(F.col("model_name") == model_name)
    if model_version is not None:
        return mine.where(F.col("model_version") == model_version)
    return mine.orderBy(F.desc("timestamp"), F.desc("model_version")).limit(1)


def list_profiles(profiles: DataFrame, tie: str = "model_version") -> DataFrame:
    return profiles.orderBy(F.desc("timestamp"), F.desc(tie))


def recent_predictions(predictions: DataFrame, as_of: Column, days: int = 7, model_name: str | None = None,
                       tie: Sequence[str] = ()) -> DataFrame:
    """Newest first; a day boundary, so ``as_of`` is taken as a date."""
    rows = predictions.where(F.col("prediction_date") >= F.date_sub(as_of.cast("date"), days))
    if model_name is not None:
        rows = rows.where(F.col("model_name") == model_name)
    return rows.orderBy(F.desc("prediction_date"), F.desc("created_at"), *tie)


def retained(predictions: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    return predictions.where(F.col("prediction_date") >= F.date_sub(as_of.cast("date"), days))


def expired(predictions: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    return predictions.where(F.col("prediction_date") < F.date_sub(as_of.cast("date"), days))


def retention_split(predictions: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    """How many rows stay and how many go."""
    old = F.col("prediction_date") < F.date_sub(as_of.cast("date"), days)
    return predictions.agg(F.count_if(~old).alias("kept"), F.count_if(old).alias("dropped"))


def keep_latest_n(rows: DataFrame, key: Sequence[str], version: Sequence[str], state: str,
                  n: int = KEEP_LATEST, protected: Sequence[str] = PROTECTED_STAGES) -> DataFrame:
    """Flag rows older than the newest ``n`` per key, unless their state is protected.

    Only the n-th newest version per key is looked up, so no key is sorted as a whole.
    ``version`` must be unique within a key.
    """
    stamp = F.struct(*version)
    newest = latest_by(rows.select(*key, *version), key, version, n)
    cutoff = newest.groupBy(*key).agg(F.min(stamp).alias("_cutoff"))
    older = stamp < F.col("_cutoff")
    flagged = join_on(rows, cutoff, key)
    return flagged.withColumn("to_archive", older & ~F.col(state).isin(*protected)).drop("_cutoff")


def metrics_long(metrics: DataFrame, names: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Wide metric columns to one row per metric."""
    wide = metrics.select(*ids, *[F.col(m).cast("double").alias(m) for m in names])
    return wide.unpivot(list(ids), list(names), "metric_name", "metric_value")


def performance_rows(metrics: DataFrame, model_name: str, model_version: str | None, at: Column,
                     metadata: dict[str, str] | None = None) -> DataFrame:
    """(metric_name, metric_value) rows in the shape of the performance table."""
    pairs = [F.lit(x) for item in (metadata or {}).items() for x in item]
    text = F.to_json(F.create_map(*pairs)) if pairs else F.lit("{}")
    return metrics.select(
        at.cast("timestamp_ntz").alias("timestamp"), F.lit(model_name).alias("model_name"),
        F.lit(model_version).cast("string").alias("model_version"), "metric_name", "metric_value",
        text.alias("metadata"),
    )


def forecast_json(forecasts: DataFrame, array: str = "forecast_24h") -> DataFrame:
    """The array as JSON text, for export."""
    return forecasts.withColumn(array, F.to_json(array))


def forecast_from_json(rows: DataFrame, array: str = "forecast_24h") -> DataFrame:
    return rows.withColumn(array, F.from_json(array, "array<double>"))
