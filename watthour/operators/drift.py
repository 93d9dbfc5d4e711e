"""Drift of current features against a stored reference profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watthour.functions.frames import to_long
from watthour.operators.profile import numeric_columns
from watthour.schemas import TS

# fixed values: score above which a feature counts as drifted, stand-in for a zero
# deviation, weight of the change in deviation
DRIFT_THRESHOLD = 2.0
TINY_STD = 1e-6
STD_WEIGHT = 0.5


def drift_score(current_mean: Column, current_std: Column, mean: Column, std: Column) -> Column:
    """Shift of the mean in reference deviations plus half the excess ratio of deviations."""
    spread = F.when(std.isNull() | F.isnan(std) | (std == 0), F.lit(TINY_STD)).otherwise(std)
    shift = F.abs(current_mean - mean) / spread
    ratio = F.greatest(F.try_divide(current_std, spread), F.try_divide(spread, current_std))
    usable = current_std.isNotNull() & ~F.isnan(current_std) & (current_std > 0)
    return shift + F.lit(STD_WEIGHT) * F.when(usable, F.abs(ratio - 1)).otherwise(0.0)


def moments(long: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and sample deviation per feature of a long frame, all-NULL features left out."""
    out = long.where(F.col("value").isNotNull()).groupBy(*by, "feature").agg(
        F.avg("value").alias("current_mean"), F.stddev_samp("value").alias("current_std"))
    return out


def score_moments(current: DataFrame, reference: DataFrame, threshold: float = DRIFT_THRESHOLD,
                  by: Sequence[str] = ()) -> DataFrame:
    """Join moments with the reference; features the reference lacks are skipped.

    The reference is the slim profile with one row per feature; one that repeats a feature
    (two versions, say) is refused, as it would give that feature several scores.
    """
    known = reference.groupBy("feature").agg(
        F.count("*").alias("rows"), F.max("mean").alias("reference_mean"), F.max("std").alias("reference_std"))
    refused = F.raise_error(F.concat(F.lit("reference repeats feature "), F.col("feature"))).cast("double")
    known = known.select("feature", F.when(F.col("rows") > 1, refused).otherwise(F.col("reference_mean")).alias("reference_mean"), "reference_std")
    scored = current.join(known, "feature").withColumn(
        "drift_score",
        drift_score(*[F.col(c) for c in ("current_mean", "current_std", "reference_mean", "reference_std")]),
    )
    return scored.select(
        *by, "feature", "drift_score", (F.col("drift_score") > threshold).alias("drift_detected"),
        "current_mean", "current_std", "reference_mean", "reference_std",
    )


def detect_drift(features: DataFrame, reference: DataFrame, threshold: float = DRIFT_THRESHOLD,
                 ts: str = TS, keys: Sequence[str] = ()) -> DataFrame:
    """Score every numeric column of a wide frame that the reference knows."""
    columns = [c for c in numeric_columns(features) if c not in {ts, *keys}]
    numbers = features.select(*keys, *[
        (F.col(c).cast("int") if dict(features.dtypes)[c] == "boolean" else F.col(c)).alias(c) for c in columns
    ])
    return score_moments(moments(to_long(numbers, columns, ids=keys), keys), reference, threshold, keys)


def drift_summary(scores: DataFrame, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """One row over all scored features; zeros when there are none.

    The list of drifted names has at most one entry per feature column.
    """
    drifted = F.col("drift_detected")
    names = F.array_sort(F.collect_set(F.when(drifted, F.col("feature"))))
    return scores.agg(
        F.coalesce(F.bool_or(drifted), F.lit(False)).alias("overall_drift_detected"),
        F.count("*").alias("features_analyzed"),
        F.count_if(drifted).alias("drifted_features_count"),
        names.alias("drifted_features"),
        F.coalesce(F.avg("drift_score"), F.lit(0.0)).alias("average_drift_score"),
        F.coalesce(F.max("drift_score"), F.lit(0.0)).alias("max_drift_score"),
        F.lit(threshold).alias("drift_threshold"),
    )


def drift_log_rows(scores: DataFrame, dataset_name: str, at: Column) -> DataFrame:
    """Scores in the shape of the drift log table."""
    return scores.select(
        at.cast("timestamp_ntz").alias("timestamp"), F.lit(dataset_name).alias("dataset_name"),
        F.col("feature").alias("feature_name"), "drift_score", "drift_detected",
    )
