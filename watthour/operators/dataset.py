"""The supervised frame: features, targets, complete rows, and splits in time order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watthour.functions.calendar import SEASONS, calendar_columns
from watthour.operators.blocks import over_rows, with_positions
from watthour.operators.features import (
    HORIZON, LAG_DAYS, ROLLING_DAYS, SAME_HOUR, check_settings, lag_columns, reach, rolling_stages,
    target_columns, target_names,
)
from watthour.schemas import TS, VALUE

# fixed values: share of rows in the training part, folds and rows per test fold
TRAIN_SHARE = 0.8
CV_SPLITS = 3
CV_TEST_ROWS = 7


def forecast_dataset(hourly: DataFrame, ts: str = TS, value: str = VALUE, keys: Sequence[str] = (),
                     horizon: int = HORIZON, lag_days: Sequence[int] = LAG_DAYS,
                     rolling_days: Sequence[int] = ROLLING_DAYS, complete: bool = True,
                     block_rows: int | None = None,
                     extra: Callable[[WindowSpec], dict[str, Column]] | None = None) -> DataFrame:
    """Features and targets on one row; lags, frames and leads share a single sort.

    ``extra`` adds columns over the same window, such as a baseline's predictions; they
    may look back no farther than the features do.
    """
    check_settings(horizon, lag_days, rolling_days)
    windowed = over_rows(
        hourly,
        *rolling_stages(value, rolling_days, beside=lambda w: {
            **lag_columns(w, value, lag_days),
            **target_columns(w, value, horizon),
            **(extra(w) if extra else {}),
        }),
        ts=ts, keys=keys, behind=reach(lag_days, rolling_days), ahead=horizon, block_rows=block_rows,
    )
    known = {*hourly.columns, *target_names(horizon)}
    made = [c for c in windowed.columns if c not in known]
    rolling = [f"rolling_{s}_{d}d" for d in sorted(rolling_days) for s in ("mean", "std", "max")]
    lags = [f"ac_power_lag_{d}d" for d in sorted(lag_days)]
    history = [*lags, *rolling, *SAME_HOUR]
    others = [c for c in made if c not in set(history)]
    calendar = calendar_columns(F.col(ts))
    whole = windowed.select(
        *keys, ts, *history, *[c.alias(n) for n, c in calendar.items()], *target_names(horizon), *others
    )
    return complete_rows(whole, ts, keys, others) if complete else whole


def feature_names(df: DataFrame, ts: str = TS, keys: Sequence[str] = (), targets: Sequence[str] | None = None) -> list[str]:
    """Feature columns in order: everything but time, keys and targets."""
    hidden = {ts, *keys, *(target_names() if targets is None else targets)}
    return [c for c in df.columns if c not in hidden]


def numeric_names(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns that hold numbers; flags of type boolean are not among them."""
    return [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]


def complete_rows(df: DataFrame, ts: str = TS, keys: Sequence[str] = (), aside: Sequence[str] = ()) -> DataFrame:
    """Rows whose numeric features and targets are all present."""
    needed = [c for c in df.columns if c not in {ts, *keys, *aside}]
    return df.dropna(subset=numeric_names(df, needed))


def align_columns(df: DataFrame, fitted: Sequence[str], keep: Sequence[str] = (TS,)) -> DataFrame:
    """The fitted columns in their order; absent ones are 0, others are dropped."""
    def filler(name: str):
        return F.lit(False) if name in {f"season_{s}" for s in SEASONS} else F.lit(0)

    present = set(df.columns)
    return df.select(*keep, *[F.col(c) if c in present else filler(c).alias(c) for c in fitted])


def feature_families(names: Sequence[str]) -> dict[str, int]:
    """How many features belong to each family, told by their names."""
    temporal = ("hour", "day", "month", "season")
    return {
        "total_features": len(names),
        "lag_features": sum("lag_" in n for n in names),
        "rolling_features": sum("rolling_" in n for n in names),
        "temporal_features": sum(any(t in n for t in temporal) for n in names),
    }


def train_test_split(df: DataFrame, ts: str = TS, keys: Sequence[str] = (), share: float = TRAIN_SHARE) -> DataFrame:
    """Mark the first ``share`` of each series' rows as train, the rest as test."""
    placed = with_positions(df, ts, keys)
    head = F.col("_pos") < F.floor(F.lit(share) * F.col("_total"))
    return placed.withColumn("split", F.when(head, "train").otherwise("test")).drop("_pos", "_total")


def cv_folds(df: DataFrame, ts: str = TS, keys: Sequence[str] = (), splits: int = CV_SPLITS,
             test_rows: int = CV_TEST_ROWS, min_train_rows: int = 1) -> DataFrame:
    """One copy of a row per fold it takes part in, with ``fold`` (from 1) and ``role``.

    Fold k tests ``test_rows`` rows and trains on every row before them.
    """
    placed = with_positions(df, ts, keys)

    def fold(k: int):
        start = F.col("_total") - (splits - k + 1) * test_rows
        role = (
            F.when(F.col("_pos") < start, F.lit("train"))
            .when(F.col("_pos") < start + test_rows, F.lit("test"))
        )
        usable = start >= min_train_rows
        return F.when(usable & role.isNotNull(), F.struct(F.lit(k).alias("fold"), role.alias("role")))

    folds = F.array_compact(F.array(*[fold(k) for k in range(1, splits + 1)]))
    spread = placed.withColumn("_fold", F.explode(folds))
    return spread.withColumns({"fold": F.col("_fold.fold"), "role": F.col("_fold.role")}).drop("_fold", "_pos", "_total")


def fold_ranges(folds: DataFrame, ts: str = TS, keys: Sequence[str] = ()) -> DataFrame:
    """Rows and time range of each fold and role."""
    return folds.groupBy(*keys, "fold", "role").agg(
        F.count("*").alias("rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
