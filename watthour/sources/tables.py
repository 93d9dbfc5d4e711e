"""Parquet tables for predictions, metrics, drift log, profiles and fitted parameters.

Predictions grow by commits (``sources.commits``) partitioned by date, so a conflict check
reads only the incoming dates and retention drops whole folders.  The drift log grows in
place, by day.  The small tables that are upserted (profiles, parameters) are published as a
new ``version=N`` folder, never over the files being read; a writer that loses the race for
a number starts again from the winner's version.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watthour.operators.store import conflicts, repeated_keys, select_profile, upsert
from watthour.schemas import DRIFT_LOG, PREDICTION_KEY, PREDICTIONS, REFERENCE_DATA, REFERENCE_KEY, SCALER_PARAMS
from watthour.sources.commits import Staged, children, exists, folder, numbers, publish

LOG_DAY = "log_day"


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The table's columns in order and type; a NULL in a required one is an error."""
    def column(field: T.StructField) -> Column:
        if field.name not in rows.columns:
            if not field.nullable:
                raise ValueError(f"column {field.name} is required")
            return F.lit(None).cast(field.dataType).alias(field.name)
        typed = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            typed = F.coalesce(typed, F.raise_error(F.lit(f"{field.name} must not be null")).cast(field.dataType))
        return typed.alias(field.name)

    return rows.select(*[column(f) for f in schema.fields])


def current_version(spark: SparkSession, path: str) -> int:
    """Newest completely written version, 0 if there is none."""
    return max(numbers(spark, path, "version="), default=0)


def read_version(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    version = current_version(spark, path)
    if version == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/version={version}")


def write_version(rows: DataFrame, path: str) -> int:
    """The rows as the next version, whatever others publish meanwhile."""
    return Staged(rows, path).commit(lambda fresh: None, "version=")


def append(rows: DataFrame, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    conform(rows, schema).write.mode("append").partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    # folders named commit=N or by day are columns of the files, not of the table
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def append_drift(rows: DataFrame, path: str) -> None:
    """Append to the drift log, partitioned by the day of the entry."""
    log = conform(rows, DRIFT_LOG).withColumn(LOG_DAY, F.to_date("timestamp"))
    log.write.mode("append").partitionBy(LOG_DAY).parquet(path)


def read_drift(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """The drift log; ``since`` leaves out the folders of earlier days (entries without a time too)."""
    if not exists(spark, path):
        return spark.createDataFrame([], DRIFT_LOG)
    schema = T.StructType([*DRIFT_LOG.fields, T.StructField(LOG_DAY, T.DateType())])
    log = spark.read.schema(schema).parquet(path)
    return (log if since is None else log.where(F.col(LOG_DAY) >= F.lit(since))).select(*DRIFT_LOG.names)


def predictions_schema(rows: DataFrame, keys: Sequence[str] = ()) -> T.StructType:
    """The predictions table, led by the series keys where there are several series."""
    return T.StructType([*[rows.schema[k] for k in keys], *PREDICTIONS.fields])


def save_predictions(rows: DataFrame, path: str, keys: Sequence[str] = ()) -> int:
    """Commit predictions; a key that is taken already, or twice in ``rows``, is an error.

    ``rows`` is computed once, by the write.  Only the partitions of its dates are read for the
    check, and after a lost race only the commits of the others.
    """
    spark = rows.sparkSession
    schema, key = predictions_schema(rows, keys), [*keys, *PREDICTION_KEY]
    staged = Staged(conform(rows, schema), path, ("prediction_date",))
    days = [date.fromisoformat(day) for day in staged.partitions("prediction_date")]

    def check(fresh: list[int] | None) -> None:
        if fresh is None and not repeated_keys(staged.read(), key).isEmpty():
            raise RuntimeError("duplicate prediction: already exists")
        stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("commit", T.LongType())])).parquet(path)
        stored = stored.where(F.col("prediction_date").isin(days))
        if fresh is not None:
            stored = stored.where(F.col("commit").isin(fresh))
        if not conflicts(stored.select(*schema.names), staged.read(), key).isEmpty():
            raise RuntimeError("duplicate prediction: already exists")

    return staged.commit(check)


def delete_old_predictions(spark: SparkSession, path: str, as_of: date, days: int = 90) -> int:
    """Drop the partitions older than ``days`` and return how many predictions went.

    A commit left without a partition keeps its folder: its number stays taken.
    """
    if not exists(spark, path):
        return 0
    cutoff = as_of - timedelta(days=days)
    gone = read_table(spark, path, PREDICTIONS).where(F.col("prediction_date") < F.lit(cutoff)).count()
    for number in numbers(spark, path):
        for name in children(spark, f"{path}/commit={number}"):
            column, _, day = name.partition("=")
            if column == "prediction_date" and date.fromisoformat(day) < cutoff:
                files, where = folder(spark, f"{path}/commit={number}/{name}")
                files.delete(where, True)
    return gone


def upsert_table(rows: DataFrame, path: str, schema: T.StructType, key: Sequence[str] = REFERENCE_KEY) -> int:
    """Replace all rows of the incoming keys; a key may hold many rows (one per feature).

    If another version appears meanwhile, the upsert is made anew on top of that one.
    """
    spark, incoming = rows.sparkSession, conform(rows, schema)
    while True:
        parent = current_version(spark, path)
        merged = Staged(upsert(read_version(spark, path, schema), incoming, key), path)
        if publish(spark, merged.folder, f"{path}/version={parent + 1}"):
            return parent + 1
        merged.discard()
        if current_version(spark, path) == parent:
            raise RuntimeError(f"{path}/version={parent + 1} is in the way and no complete version")


def save_reference(tables: dict[str, DataFrame], path: str, model_name: str, model_version: str,
                   at: Column) -> None:
    """Store the tables of a reference profile under (model, version); the same version
    again replaces its rows and refreshes its timestamp."""
    def tagged(rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(model_name).alias("model_name"), F.lit(model_version).alias("model_version"), "*")

    for name, rows in tables.items():
        rows = tagged(rows)
        upsert_table(rows, f"{path}/{name}", _nullable(rows.schema))
    counts = tables["target_profile"].select(
        F.col("total_samples").alias("training_samples"), F.col("forecast_horizons").alias("target_horizons"))
    features = tables["data_quality"].first()["feature_count"]
    head = tagged(counts).withColumns({
        "feature_count": F.lit(features), "timestamp": at.cast("timestamp_ntz"),
        "collection_timestamp": at.cast("timestamp_ntz"),
    })
    upsert_table(head, f"{path}/reference_data", REFERENCE_DATA)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def load_drift_reference(spark: SparkSession, path: str, model_name: str,
                         model_version: str | None = None) -> DataFrame | None:
    """Slim statistics of the given version, else of the newest one; None if there is none."""
    head = select_profile(read_version(spark, f"{path}/reference_data", REFERENCE_DATA), model_name, model_version)
    found = head.select("model_version").first()
    if found is None:
        return None
    folder = f"{path}/drift_reference"
    rows = spark.read.parquet(f"{folder}/version={current_version(spark, folder)}")
    return rows.where((F.col("model_name") == model_name) & F.col("model_version").eqNullSafe(F.lit(found[0])))


def save_params(params: DataFrame, path: str) -> int:
    return write_version(conform(params, SCALER_PARAMS).coalesce(1), path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    if current_version(spark, path) == 0:
        raise RuntimeError("no fitted parameters there: fit before transform")
    return read_version(spark, path, SCALER_PARAMS)
