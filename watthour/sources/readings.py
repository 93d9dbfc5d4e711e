"""Generation and weather readings from CSV or Parquet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watthour.schemas import GENERATION, TS, WEATHER

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _read(spark: SparkSession, path: str, schema: T.StructType, source: str, time_format: str) -> DataFrame:
    if source == "csv":
        # enforceSchema=False: the header must carry the expected names
        raw = spark.read.csv(path, schema=schema, header=True, enforceSchema=False)
        return raw.withColumn(TS, F.to_timestamp_ntz(TS, F.lit(time_format)))
    rows = spark.read.format(source).load(path)
    return rows.select(*[
        F.col(f.name).cast("timestamp_ntz" if f.name == TS else f.dataType).alias(f.name) for f in schema.fields
    ])


def read_generation(spark: SparkSession, path: str, source: str = "csv", time_format: str = TIME_FORMAT) -> DataFrame:
    return _read(spark, path, GENERATION, source, time_format)


def read_weather(spark: SparkSession, path: str | None, source: str = "csv",
                 time_format: str = TIME_FORMAT) -> DataFrame | None:
    """Weather is only counted, so a path that cannot be read gives None."""
    if path is None:
        return None
    try:
        return _read(spark, path, WEATHER, source, time_format)
    except AnalysisException:
        return None
