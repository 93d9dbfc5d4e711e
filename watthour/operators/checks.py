"""Readiness and leakage report of a series before it is used for training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watthour.functions.stats import seconds_between, whole_days
from watthour.operators.blocks import over_rows
from watthour.operators.features import DAY, LAG_DAYS
from watthour.operators.hourly import FREQUENCY_TOLERANCE_SECONDS, HOUR_SECONDS
from watthour.schemas import TS, VALUE

# fixed values: columns that would leak the weather of the hour to be predicted
FORBIDDEN_COLUMNS = (
    "AMBIENT_TEMPERATURE",
    "MODULE_TEMPERATURE",
    "IRRADIATION",
    "temp_difference",
    "temp_ratio",
    "irradiation_per_temp",
    "power_efficiency",
    "temp_irradiation_interaction",
)


def forbidden_present(df: DataFrame) -> list[str]:
    """Forbidden names among the columns, case ignored as Spark does; runs no job."""
    present = {c.lower() for c in df.columns}
    return [c for c in FORBIDDEN_COLUMNS if c.lower() in present]


def leakage_report(series: DataFrame, ts: str = TS, value: str = VALUE, keys: Sequence[str] = (),
                   lag_days: Sequence[int] = LAG_DAYS, expected_seconds: float = HOUR_SECONDS,
                   order: DataFrame | None = None) -> DataFrame:
    """One row per series: counts, gaps, range, frequency, history, and the verdict.

    Everything comes from one tally of the step to the previous row.  A DataFrame has no
    order of its own; pass the result of ``order_check`` as ``order`` to judge ingest
    order, else ``is_sorted`` is true.
    """
    forbidden = forbidden_present(series)
    steps = over_rows(
        series.select(*keys, ts, value),
        lambda w: {"_step": seconds_between(F.lag(ts).over(w), F.col(ts))},
        ts=ts, keys=keys, behind=1,
    )
    tally = steps.groupBy(*keys, "_step").agg(
        F.count("*").alias("_n"),
        F.count_if(F.col(value).isNull()).alias("_missing"),
        F.count_if(F.col(value) < 0).alias("_negative"),
        F.count_if(F.col(ts).isNull()).alias("_no_ts"),
        F.min(ts).alias("_lo"), F.max(ts).alias("_hi"),
    )
    step, n = F.col("_step"), F.col("_n")
    gap = step > expected_seconds
    modal = F.min(F.when(step.isNotNull(), F.struct((-n).alias("n"), step.alias("s"))))
    facts = tally.groupBy(*keys).agg(
        F.sum("_n").alias("total_records"),
        F.sum("_missing").alias("missing_values"),
        F.sum("_negative").alias("negative_values"),
        (F.sum(F.when(step == 0, n).otherwise(0))
         + F.greatest(F.sum("_no_ts") - 1, F.lit(0))).alias("duplicate_timestamps"),
        F.sum(F.when(gap, n).otherwise(0)).alias("total_gaps"),
        F.coalesce(F.max(F.when(gap, step)) / HOUR_SECONDS, F.lit(0.0)).alias("max_gap_hours"),
        F.min("_lo").alias("start"), F.max("_hi").alias("end"),
        modal.alias("_modal"),
    )
    if order is not None and keys:
        facts = facts.join(order.select(*keys, "is_sorted"), list(keys), "left")
    elif order is not None:
        facts = facts.withColumn("is_sorted", F.lit(order.first()["is_sorted"]))
    else:
        facts = facts.withColumn("is_sorted", F.lit(True))
    records = F.coalesce("total_records", F.lit(0))
    off = F.abs(F.col("_modal.s") - expected_seconds)
    return facts.withColumns({
        "total_days": whole_days(F.col("start"), F.col("end")),
        "frequency_consistent": F.coalesce(off < FREQUENCY_TOLERANCE_SECONDS, F.lit(True)),
        "sufficient_history": records >= max(lag_days) * DAY,
        "min_lag_availability": records >= min(lag_days) * DAY,
        "forbidden_columns": F.lit(", ".join(forbidden)),
        "only_allowed_features": F.lit(not forbidden),
        "overall_valid": (
            (F.coalesce("missing_values", F.lit(0)) == 0) & F.col("is_sorted")
            & (records >= max(lag_days) * DAY) & F.lit(not forbidden)
        ),
    }).drop("_modal")


def require_valid(report: DataFrame) -> None:
    """Raise if any series of the report is not fit for training."""
    bad = report.where(~F.col("overall_valid")).count()
    if bad:
        raise ValueError(f"{bad} series not fit for training; see the report")


def rejected_series(report: DataFrame, lag_days: Sequence[int] = LAG_DAYS) -> DataFrame:
    """The series of a report that are not fit for training, with ``reasons``."""
    needed = max(lag_days) * DAY
    reasons = F.array_compact(F.array(
        F.when(F.coalesce("missing_values", F.lit(0)) > 0, F.format_string("%d missing values", F.col("missing_values").cast("long"))),
        F.when(~F.col("is_sorted"), F.lit("times not in order")),
        F.when(F.col("total_records") < needed, F.format_string(f"%d hours, {needed} needed", F.col("total_records").cast("long"))),
        F.when(~F.col("only_allowed_features"), F.lit("forbidden columns")),
    ))
    return report.where(~F.col("overall_valid")).withColumn("reasons", reasons)
