"""Scaling with the population deviation and a divisor of 1 for columns without spread."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METHODS = ("standard", "minmax", "none")


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: (feature, mean, std, min, max, ord).  One aggregate, no long form."""
    stats = {"mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max}
    one = df.agg(*[
        F.struct(*[f(F.col(c).cast("double")).alias(s) for s, f in stats.items()]).alias(c)
        for c in columns
    ])
    rows = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("s"), F.lit(i).alias("ord"))
        for i, c in enumerate(columns)
    ])
    return one.select(F.explode(rows).alias("p")).select(
        "p.feature", "p.s.mean", "p.s.std", "p.s.min", "p.s.max", "p.ord"
    )


def apply_scaler(df: DataFrame, params: DataFrame, method: str = "standard") -> DataFrame:
    """Scale the fitted columns and leave the rest.

    The fitted table has one row per column, so it is read once and becomes constants
    of the projection: no join, and the scale stays inside generated code.
    """
    if method not in METHODS:
        raise ValueError(f"unknown scaling method: {method}")
    if method == "none":
        return df
    scaled = {}
    for row in params.collect():
        if row["mean"] is None:
            continue
        if method == "standard":
            shift, spread = row["mean"], row["std"]
        else:
            shift, spread = row["min"], row["max"] - row["min"]
        scaled[row["feature"]] = (F.col(row["feature"]).cast("double") - F.lit(shift)) / F.lit(spread or 1.0)
    return df.withColumns(scaled)
