"""Boosted trees have no SQL twin; these queries are checked by rows and by tests."""

from pyspark.sql import functions as F

from watthour.catalog.registry import SEASON_FLAGS, NUMERIC, TARGETS, dataset, query
from watthour.operators import models as ops
from watthour.operators.dataset import CV_SPLITS, train_test_split

FEATURES = [*NUMERIC, *SEASON_FLAGS]
HORIZONS = dict(enumerate(TARGETS, start=1))


def _split(spark, sf):
    rows = train_test_split(dataset(spark, sf))
    return rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")


def _fitted(spark, sf):
    train, test = _split(spark, sf)
    return test, ops.fit_horizons(train, FEATURES, HORIZONS, ops.GBT_SETTINGS)


@query("gbt_forecast")
def gbt_forecast(spark, sf):
    test, models = _fitted(spark, sf)
    return ops.horizon_pairs(ops.predict_horizons(test, FEATURES, models), HORIZONS, ["date_time"])


@query("feature_importance")
def feature_importance(spark, sf):
    first = {1: HORIZONS[1]}  # the only horizon that is shown
    return ops.feature_importance(spark, ops.fit_horizons(_split(spark, sf)[0], FEATURES, first), FEATURES, top=15)


@query("grid_search")
def grid_search(spark, sf):
    return ops.grid_search(dataset(spark, sf), FEATURES, HORIZONS, ops.GBT_GRID, splits=CV_SPLITS)
