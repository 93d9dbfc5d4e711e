import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from frames import solar_days
from watthour.catalog import models as catalog
from watthour.operators import boosting
from watthour.operators import models as ops
from watthour.operators.dataset import CV_SPLITS, feature_names, forecast_dataset, train_test_split
from watthour.operators.evaluate import overall_metrics
from watthour.operators.features import target_names
from watthour.session import ensure_checkpoint_dir

SETTINGS = {"trees": 5, "depth": 4, "rate": 0.3, "rows": 1.0, "columns": 1.0}


@pytest.fixture(scope="module")
def rows(spark):
    hourly = spark.createDataFrame(solar_days(30), "date_time timestamp_ntz, ac_power double")
    return forecast_dataset(hourly, lag_days=(1, 2), rolling_days=(2,)).coalesce(1).cache()


TARGETS = {h: target_names()[h - 1] for h in (1, 6)}


def test_trees_learn_the_day(spark, rows):
    features = feature_names(rows)
    split = train_test_split(rows)
    models = ops.fit_horizons(split.where("split = 'train'"), features, TARGETS, SETTINGS, threads=2)
    scored = ops.predict_horizons(split.where("split = 'test'"), features, models)
    pairs = ops.horizon_pairs(scored, TARGETS, ["date_time"])
    assert pairs.count() == 2 * split.where("split = 'test'").count()
    assert overall_metrics(pairs).first()["r2"] > 0.9
    ranked = ops.feature_importance(spark, models, features, top=5).collect()
    assert len(ranked) == 5 and ranked[0]["importance"] >= ranked[-1]["importance"]
    assert ops.feature_importance(spark, models, features, average=True).agg(F.sum("importance")).first()[0] == pytest.approx(1)


def test_grid_marks_one_best_per_fold_and_reports_failures(rows):
    bad = {**SETTINGS, "depth": -1}
    scores = ops.grid_search(rows, feature_names(rows), TARGETS, (SETTINGS, bad), splits=2)
    got = scores.collect()
    assert {(r["fold"], r["setting"], r["is_best"]) for r in got} == {(k, i, i == 0) for k in (1, 2) for i in (0, 1)}
    assert all((r["rmse"] is None) == bool(r["error"]) == (r["setting"] == 1) for r in got)
    assert ops.grid_summary(scores).first()["folds"] == 2


def test_queries_train_every_horizon_with_the_settings_of_the_operators(monkeypatch):
    """Without fitting: what the queries ask of the operators, on the rows as Spark reads them."""
    asked = []
    monkeypatch.setattr(catalog, "dataset", lambda *_: None)
    monkeypatch.setattr(catalog, "_split", lambda *_: (None, None), raising=False)
    monkeypatch.setattr(ops, "fit_horizons", lambda *a, **k: asked.append((a[2:], k)))
    monkeypatch.setattr(ops, "grid_search", lambda *a, **k: asked.append((a[2:], k)))
    catalog._fitted(None, None)
    catalog.grid_search(None, None)
    every = dict(enumerate(target_names(), start=1))
    assert len(every) == 24
    assert asked == [((every, ops.GBT_SETTINGS), {}), ((every, ops.GBT_GRID), {"splits": CV_SPLITS})]


def test_checkpoint_folder_is_kept(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == before


def test_both_ways_grow_the_same_trees(rows, monkeypatch):
    """Broadcast rows, or a job per level over partitions, in folds and with two settings."""
    features = feature_names(rows)
    grouped = rows.withColumn("part", F.hour("date_time") % 2).repartition(3)
    grid = [{**SETTINGS, "trees": 3, "rows": 0.7, "columns": 0.5}, {**SETTINGS, "trees": 2, "depth": 2}]
    monkeypatch.setattr(boosting, "EVERY", 2)
    few = boosting.boost(grouped, features, TARGETS, grid, "part")
    monkeypatch.setattr(boosting, "SMALL", 0)
    many = boosting.boost(grouped, features, TARGETS, grid, "part")
    for a, b in zip(few.trees, many.trees):
        assert len(a.feature) == len(b.feature) == a.setting["trees"]
        assert all((x == y).all() for x, y in zip(a.feature + a.bin, b.feature + b.bin))
        assert all(np.allclose(x, y) for x, y in zip(a.value, b.value)) and np.allclose(a.gain, b.gain)


def test_a_split_is_the_best_one():
    rng = np.random.default_rng(1)
    bins, y = rng.integers(0, 6, (40, 3)).astype(np.uint8), rng.normal(size=(40, 1))
    tree = boosting.Trees({"depth": 2, "trees": 1, "rate": 1.0, "rows": 1.0, "columns": 1.0}, 1, 1)
    tree.sprout()
    found = boosting.best_splits(*boosting.histogram(
        bins, y, np.arange(40, dtype=np.uint64), np.zeros((40, 1)), tree.feature[0][0], tree.bin[0][0], np.arange(3), 1.0, 0, 0))

    def gain(left):
        score = lambda r: r.sum() ** 2 / (len(r) + boosting.SHRINK)
        return score(y[left, 0]) + score(y[~left, 0]) - score(y[:, 0])

    every = {(f, b): gain(bins[:, f] <= b) for f in range(3) for b in range(5)}
    best = max(every, key=every.get)
    assert (found["feature"][0], found["bin"][0]) == best and found["gain"][0] == pytest.approx(every[best])
    assert found["total"][0] == pytest.approx(y.sum()) and found["n"][0] == 40


def test_as_good_as_the_library_of_spark(rows):
    """On noisy targets and with the share of 0.8 of rows; MLlib takes its first tree whole, so there are some trees."""
    features = feature_names(rows)
    noise = F.pmod(F.xxhash64("date_time"), F.lit(1000)) / 25 - 20
    split = train_test_split(rows.withColumn(TARGETS[1], F.col(TARGETS[1]) + noise))
    train, test = (split.where(F.col("split") == part) for part in ("train", "test"))
    settings = {"trees": 25, "depth": 4, "rate": 0.2, "rows": 0.8, "columns": 1.0}
    ours = ops.predict_horizons(test, features, ops.fit_horizons(train, features, {1: TARGETS[1]}, settings))
    vectors = VectorAssembler(inputCols=features, outputCol="vector")
    library = GBTRegressor(featuresCol="vector", labelCol=TARGETS[1], predictionCol="pred_1", maxIter=25, maxDepth=4, stepSize=0.2, subsamplingRate=0.8, seed=1)
    theirs = library.fit(vectors.transform(train)).transform(vectors.transform(test))
    rmse = [overall_metrics(ops.horizon_pairs(x, {1: TARGETS[1]}, ["date_time"])).first()["rmse"] for x in (ours, theirs)]
    assert 1 < rmse[0] <= 1.1 * rmse[1]


def test_missing_values_constant_features_and_no_rows(spark):
    data = [(float(i), 1.0, float(i % 7 > 3), None if i % 5 == 0 else 2.0 * i) for i in range(60)] + [(None, 1.0, float("nan"), 3.0)]
    df = spark.createDataFrame(data, "a double, same double, b double, y double")
    models = ops.fit_horizons(df, ["a", "same", "b"], {1: "y"}, {**SETTINGS, "trees": 20})
    assert models[1].importances[1] == 0
    got = {r["a"]: r["pred_1"] for r in ops.predict_horizons(df, ["a", "same", "b"], models).collect()}
    assert abs(got[41.0] - 82) < 8 and got[None] is not None
    none = ops.fit_horizons(df.limit(0), ["a", "same", "b"], {1: "y"}, SETTINGS)
    assert {r["pred_1"] for r in ops.predict_horizons(df, ["a", "same", "b"], none).collect()} == {0.0}
    with pytest.raises(ValueError):
        ops.predict_horizons(df, ["a"], models)
