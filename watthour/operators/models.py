"""Boosted trees per horizon, importances, and a search over time folds.

All horizons, settings and folds are fitted together by ``boosting``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watthour.operators.boosting import Boosted, boost, check
from watthour.operators.dataset import CV_SPLITS, CV_TEST_ROWS, cv_folds
from watthour.operators.evaluate import overall_metrics
from watthour.schemas import TS

# fixed values: production settings of the model
GBT_SETTINGS = {"trees": 50, "depth": 4, "rate": 0.1, "rows": 0.8, "columns": 0.8}
# fixed values: the three settings that are searched
GBT_GRID = (
    {"trees": 50, "depth": 4, "rate": 0.1, "rows": 0.8, "columns": 0.8},
    {"trees": 100, "depth": 6, "rate": 0.05, "rows": 0.9, "columns": 0.9},
    {"trees": 150, "depth": 8, "rate": 0.02, "rows": 0.8, "columns": 0.8},
)


@dataclass(frozen=True)
class HorizonModel:
    """One horizon's trees of a fit."""

    fit: Boosted
    horizon: int
    setting: int = 0
    group: int = 0

    @property
    def importances(self) -> np.ndarray:
        """Share of each feature in the gain of all splits."""
        return self.fit.importances(self.setting, self.group)[list(self.fit.targets).index(self.horizon)]


def fit_horizons(train: DataFrame, features: Sequence[str], targets: dict[int, str], settings: dict = GBT_SETTINGS,
                 threads: int | None = None) -> dict[int, HorizonModel]:
    """One independent model per horizon, all grown together over the same rows.

    ``threads`` is without effect: there are no fits side by side any more.
    """
    fit = boost(train, features, targets, [settings])
    return {h: HorizonModel(fit, h) for h in targets}


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column, with NaN for missing values."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def predict_horizons(df: DataFrame, features: Sequence[str], models: dict[int, HorizonModel]) -> DataFrame:
    """Add ``pred_{h}`` for each model; the trees travel with the task, the rows stay in place."""
    features, fits = list(features), {}
    for h, m in models.items():
        if m.fit.features != features:
            raise ValueError(f"the model of horizon {h} was fitted on other features")
        fits.setdefault((id(m.fit), m.setting, m.group), (m, []))[1].append((h, m.horizon))
    scorers = [([h for h, _ in own], m.fit.scorer(m.setting, m.group, [x for _, x in own])) for m, own in fits.values()]
    names = [f"pred_{h}" for own, _ in scorers for h in own]

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("_features"), len(features))
            found = [pa.array(c) for _, score in scorers for c in score(x).T.copy()] if len(x) else [pa.array([], pa.float64())] * len(names)
            kept = [c for c, n in zip(batch.columns, batch.schema.names) if n != "_features"]
            yield pa.RecordBatch.from_arrays([*kept, *found], names=[*(n for n in batch.schema.names if n != "_features"), *names])

    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])
    return df.withColumn("_features", F.array(*[F.col(f).cast("double") for f in features])).mapInArrow(run, schema)


def horizon_pairs(predicted: DataFrame, targets: dict[int, str], ids: Sequence[str]) -> DataFrame:
    """Long form (ids, horizon, y, y_hat) of targets and predictions."""
    cells = F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.col(y).alias("y"), F.col(f"pred_{h}").alias("y_hat"))
        for h, y in targets.items()
    ])
    return predicted.select(*ids, F.explode(cells).alias("_p")).select(*ids, "_p.*")


def feature_importance(spark, models: dict[int, HorizonModel], features: Sequence[str],
                       average: bool = False, top: int | None = None) -> DataFrame:
    """Importance per feature of the first horizon's model, or averaged over all."""
    chosen = list(models.values()) if average else [models[min(models)]]
    totals = sum(m.importances for m in chosen) / len(chosen)
    rows = [(name, float(x)) for name, x in zip(features, totals)]
    ranked = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return ranked.limit(top) if top else ranked


def _scored(fit: Boosted, numbers: Sequence[int]):
    """(fold, setting, horizon, y, y_hat) of test rows under the models of their fold."""
    horizons = list(fit.targets)

    def run(batches):
        scorers = {}
        for batch in batches:
            fold = batch.column("fold").to_numpy()
            for name in np.unique(fold):
                if name not in fit.groups:
                    continue  # nothing to learn from: no forecast
                own = batch.filter(pa.array(fold == name))
                x, y = _matrix(own.column("_features"), len(fit.features)), _matrix(own.column("_targets"), len(horizons))
                for s, number in enumerate(numbers):
                    if (name, s) not in scorers:
                        scorers[name, s] = fit.scorer(s, fit.groups.index(name), horizons)
                    n = y.size
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, name, dtype=np.int32)), pa.array(np.full(n, number, dtype=np.int32)),
                         pa.array(np.tile(np.array(horizons, dtype=np.int32), len(y))),
                         pa.array(y.reshape(-1), mask=np.isnan(y.reshape(-1))), pa.array(scorers[name, s](x).reshape(-1))],
                        names=["fold", "setting", "horizon", "y", "y_hat"])
    return run


def grid_search(dataset: DataFrame, features: Sequence[str], targets: dict[int, str],
                grid: Sequence[dict] = GBT_GRID, ts: str = TS, splits: int = CV_SPLITS,
                test_rows: int = CV_TEST_ROWS, keys: Sequence[str] = ()) -> DataFrame:
    """rmse of every setting on every time fold, with each fold's best marked.

    Folds are cut in every series of ``keys``; all settings of all folds are one fit.  A setting
    that can't be grown has rows with null rmse and the message in ``error`` (empty
    otherwise), and so has a fold without rows; neither is anybody's best.
    """
    spark, problems = dataset.sparkSession, {}
    for i, setting in enumerate(grid):
        try:
            check(setting)
        except ValueError as problem:
            problems[i] = str(problem)
    sound = [i for i in range(len(grid)) if i not in problems]
    if not sound:
        raise RuntimeError("every setting failed on every fold")
    folds = cv_folds(dataset, ts, keys, splits=splits, test_rows=test_rows)
    fit = boost(folds.where("role = 'train'"), features, targets, [grid[i] for i in sound], "fold")
    wide = folds.where("role = 'test'").select(
        "fold", *[F.array(*[F.col(c).cast("double") for c in cs]).alias(n) for n, cs in (("_features", features), ("_targets", targets.values()))])
    pairs = wide.mapInArrow(_scored(fit, sound), "fold int, setting int, horizon int, y double, y_hat double")
    rmse = overall_metrics(pairs, ["fold", "setting"]).select("fold", "setting", "rmse")
    tried = spark.createDataFrame([(k, i, problems.get(i, "")) for k in range(1, splits + 1) for i in range(len(grid))], "fold int, setting int, error string")
    scores = tried.join(rmse, ["fold", "setting"], "left").select(
        "fold", "setting", "rmse", F.when(F.col("rmse").isNull() & (F.col("error") == ""), "no rows in this fold").otherwise(F.col("error")).alias("error"))
    first = F.min(F.when(F.col("rmse").isNotNull(), F.struct("rmse", "setting"))).over(Window.partitionBy("fold"))
    return scores.withColumn("is_best", F.coalesce(F.col("setting") == first["setting"], F.lit(False)))


def grid_summary(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of the folds' best rmse."""
    return scores.where("is_best").agg(
        F.count("*").alias("folds"), F.avg("rmse").alias("best_rmse_mean"), F.stddev_pop("rmse").alias("best_rmse_std"))
