"""Where intermediate tables live: the shared folder the cluster names, never a local one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from watthour.session import shared_folder


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where none is set, local sessions get their own and others an error."""
    return shared_folder(spark)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Few texts in an Arrow batch: its buffers exist several times, in the JVM and in Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def widened(df: DataFrame, **columns: T.DataType) -> T.StructType:
    """The schema of ``df`` with more columns at its end."""
    return T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in columns.items())])
