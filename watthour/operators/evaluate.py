"""Forecast accuracy from the long form (horizon, y, y_hat)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watthour.functions.stats import percent, r_squared

# fixed values: guard added to the divisor of relative errors, and horizons shown alone
EPSILON = 1e-8
KEY_HORIZONS = (1, 6, 12, 24)
# fixed values: tolerances of the equal-predictions check
ABSOLUTE_TOLERANCE, RELATIVE_TOLERANCE = 1e-8, 1e-5

SUMMARY_METRICS = ("rmse", "mae", "r2", "mape")


def to_pairs(df: DataFrame, targets: Sequence[str], predictions: Sequence[str],
             ids: Sequence[str] = ()) -> DataFrame:
    """One row per (row, horizon) from two sets of wide columns; no shuffle."""
    cells = F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.col(y).alias("y"), F.col(p).alias("y_hat"))
        for h, (y, p) in enumerate(zip(targets, predictions), start=1)
    ])
    return df.select(*ids, F.explode(cells).alias("_p")).select(*ids, "_p.*")


def _accuracy(within: Sequence[int]) -> list[Column]:
    y, y_hat = F.col("y"), F.col("y_hat")
    error = y - y_hat
    n = F.count("*")
    return [
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        r_squared(F.sum(error * error), F.var_pop(y) * n).alias("r2"),
        (F.avg(F.abs(F.try_divide(error, y + EPSILON))) * 100).alias("mape"),
        F.avg(error).alias("residual_mean"),
        F.stddev_pop(error).alias("residual_std"),
        # the divisor keeps its sign: a negative y always counts as within
        *[percent(F.count_if(F.try_divide(F.abs(error), y + EPSILON) * 100 <= p), n)
          .alias(f"predictions_within_{p}pct") for p in within],
    ]


def complete_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs with both sides; every measure is over the same rows."""
    return pairs.where(F.col("y").isNotNull() & F.col("y_hat").isNotNull())


def overall_metrics(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All horizons taken together, per model or fold if ``by`` says so."""
    return complete_pairs(pairs).groupBy(*by).agg(
        *_accuracy((10, 20, 30)),
        F.count("*").alias("total_samples"),
        F.count_distinct("horizon").alias("forecast_horizons"),
    )


def horizon_metrics(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per horizon, with mean and population deviation of both sides."""
    return complete_pairs(pairs).groupBy(*by, "horizon").agg(
        *_accuracy((10, 20)),
        F.avg("y").alias("true_mean"), F.stddev_pop("y").alias("true_std"),
        F.avg("y_hat").alias("pred_mean"), F.stddev_pop("y_hat").alias("pred_std"),
        F.count("*").alias("samples"),
    )


def horizon_summary(by_horizon: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Spread of each metric over the horizons, best and worst horizon (first on a tie).

    The input has one row per horizon, so the exact median needs no special care.
    """
    stats: list[Column] = []
    for m in SUMMARY_METRICS:
        stats += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std"), F.min(m).alias(f"{m}_min"),
                  F.max(m).alias(f"{m}_max"), F.median(m).alias(f"{m}_median")]
    for m, sign in (("rmse", 1), ("mae", 1), ("r2", -1)):
        best = F.struct(F.col(m) * sign, F.col("horizon"))
        worst = F.struct(F.col(m) * -sign, F.col("horizon"))
        stats += [F.min_by("horizon", best).alias(f"best_horizon_{m}"),
                  F.min_by("horizon", worst).alias(f"worst_horizon_{m}")]
    return by_horizon.groupBy(*by).agg(*stats)


def key_horizons(by_horizon: DataFrame, horizons: Sequence[int] = KEY_HORIZONS) -> DataFrame:
    return by_horizon.where(F.col("horizon").isin(*horizons))


def training_metrics(pairs: DataFrame, part: str = "split") -> DataFrame:
    """(metric_name, metric_value): overall, key horizons and spread, prefixed by ``part``.

    Overall figures come from the per-horizon partial sums, so the pairs are read once.
    """
    y, error = F.col("y"), F.col("y") - F.col("y_hat")
    sums = pairs.groupBy(part, "horizon").agg(
        F.count("*").alias("n"), F.sum(error * error).alias("sse"), F.sum(F.abs(error)).alias("sae"),
        F.avg(y).alias("ym"), (F.var_pop(y) * F.count("*")).alias("yss"),
    )
    # total spread of y = spread inside the horizons + spread between their means; the
    # window covers one row per horizon
    whole = Window.partitionBy(part)
    centre = F.sum(F.col("n") * F.col("ym")).over(whole) / F.sum("n").over(whole)
    sums = sums.withColumn("tss", F.col("yss") + F.col("n") * F.pow(F.col("ym") - centre, 2))
    rmse, mae = F.sqrt(F.col("sse") / F.col("n")), F.col("sae") / F.col("n")
    n = F.sum("n")
    named = {
        "rmse_overall": F.sqrt(F.sum("sse") / n),
        "mae_overall": F.sum("sae") / n,
        "r2_overall": r_squared(F.sum("sse"), F.sum("tss")),
        **{f"rmse_{h}h": F.max(F.when(F.col("horizon") == h, rmse)) for h in KEY_HORIZONS},
        **{f"mae_{h}h": F.max(F.when(F.col("horizon") == h, mae)) for h in KEY_HORIZONS},
        "rmse_horizon_mean": F.avg(rmse), "rmse_horizon_std": F.stddev_pop(rmse),
        "mae_horizon_mean": F.avg(mae), "mae_horizon_std": F.stddev_pop(mae),
    }
    wide = sums.groupBy(part).agg(*[c.alias(name) for name, c in named.items()])
    long = wide.unpivot([part], list(named), "metric", "metric_value").where(F.col("metric_value").isNotNull())
    return long.select(F.concat_ws("_", part, "metric").alias("metric_name"), "metric_value")


def cv_summary(fold_pairs: DataFrame, fold: str = "fold") -> DataFrame:
    """Mean and population deviation over the folds of rmse, mae and r2."""
    per_fold = overall_metrics(fold_pairs, [fold])
    return per_fold.agg(
        F.count("*").alias("folds"),
        *[f(m).alias(f"cv_{m}_{name}") for m in ("rmse", "mae", "r2")
          for name, f in (("mean", F.avg), ("std", F.stddev_pop))],
    )


def compare_models(metrics: DataFrame, model: str = "model_name", order: str = "model_index") -> DataFrame:
    """Best model per metric (earlier model on a tie), ranges, improvement, recommendation."""
    sides = {"rmse": 1, "mae": 1, "r2": -1, "mape": 1, "predictions_within_10pct": -1}
    best = {m: F.min_by(model, F.struct(F.col(m) * s, F.col(order))) for m, s in sides.items()}
    spread: list[Column] = []
    for m in ("rmse", "mae"):
        gain = percent(F.max(m) - F.min(m), F.max(m))
        spread += [F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max"), gain.alias(f"{m}_improvement")]
    return metrics.agg(
        F.count("*").alias("models"),
        *[c.alias(f"best_{m}") for m, c in best.items()], *spread,
        best["rmse"].alias("recommendation"),
    )


def predictions_close(left: DataFrame, right: DataFrame, ids: Sequence[str],
                      by: Sequence[str] = ()) -> DataFrame:
    """Are two sets of predictions equal within tolerance?  A row without partner is not."""
    a = left.select(*ids, F.col("y_hat").alias("_a"), F.lit(True).alias("_in_a"))
    b = right.select(*ids, F.col("y_hat").alias("_b"), F.lit(True).alias("_in_b"))
    both = a.join(b, list(ids), "full")
    gap = F.abs(F.col("_a") - F.col("_b"))
    near = F.coalesce(gap <= ABSOLUTE_TOLERANCE + RELATIVE_TOLERANCE * F.abs("_b"), F.lit(False))
    return both.groupBy(*by).agg(
        F.count("*").alias("compared"), F.count_if(near).alias("close"),
        F.bool_and(near).alias("all_close"), F.max(gap).alias("max_difference"),
    )
