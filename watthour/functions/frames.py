"""Small frame helpers: NULL-safe joins and wide-to-long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watthour.functions.stats import nan_to_null


def join_on(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other, as they do in groupBy."""
    renamed = right
    for name in columns:
        renamed = renamed.withColumnRenamed(name, f"_r_{name}")
    condition = None
    for name in columns:
        same = left[name].eqNullSafe(renamed[f"_r_{name}"])
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"_r_{name}" for name in columns])


def to_long(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = (),
            name: str = "feature", value: str = "value") -> DataFrame:
    """One row per (row, column), values as double, NaN as NULL.  No shuffle."""
    narrow = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    long = narrow.unpivot(list(ids), list(columns), name, value)
    return long.withColumn(value, nan_to_null(F.col(value)))
