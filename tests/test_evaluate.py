import numpy as np
import pytest

from watthour.operators import evaluate as ops

SCHEMA = "horizon int, y double, y_hat double"


def pairs(spark, y, y_hat):
    rows = [(h + 1, float(a), float(b)) for ys, ps in zip(y, y_hat) for h, (a, b) in enumerate(zip(ys, ps))]
    return spark.createDataFrame(rows, SCHEMA)


def test_overall_follows_numpy(spark):
    y = np.array([[1.0, 2.0], [3.0, -4.0], [0.0, 6.0]])
    p = np.array([[1.1, 2.5], [2.0, -4.1], [0.0, 9.0]])
    row = ops.overall_metrics(pairs(spark, y, p)).first()
    e, flat = (y - p).flatten(), y.flatten()
    assert row["rmse"] == pytest.approx(np.sqrt((e ** 2).mean()))
    assert row["mae"] == pytest.approx(abs(e).mean())
    assert row["r2"] == pytest.approx(1 - (e ** 2).sum() / ((flat - flat.mean()) ** 2).sum())
    assert row["mape"] == pytest.approx(np.mean(abs(e / (flat + 1e-8))) * 100)
    assert row["residual_std"] == pytest.approx(e.std())
    share = np.abs(e) / (flat + 1e-8) * 100
    for limit in (10, 20, 30):
        # a negative y always counts as within
        assert row[f"predictions_within_{limit}pct"] == pytest.approx((share <= limit).mean() * 100)
    assert (row["total_samples"], row["forecast_horizons"]) == (6, 2)


@pytest.mark.parametrize("y_hat, r2", [([5.0, 5.0], 1.0), ([5.0, 6.0], 0.0)])
def test_r2_without_spread(spark, y_hat, r2):
    assert ops.overall_metrics(pairs(spark, [[5.0], [5.0]], [[v] for v in y_hat])).first()["r2"] == r2


def test_zero_actual_explodes_mape_without_failing(spark):
    assert ops.overall_metrics(pairs(spark, [[0.0], [1.0]], [[1.0], [1.0]])).first()["mape"] == pytest.approx(5e9)


def test_best_and_worst_horizon_take_the_first_on_a_tie(spark):
    y = np.array([[1.0, 1.0, 1.0, 1.0], [2.0, 2.0, 2.0, 2.0]])
    row = ops.horizon_summary(ops.horizon_metrics(pairs(spark, y, y + [3.0, 1.0, 1.0, 3.0]))).first()
    assert (row["best_horizon_rmse"], row["worst_horizon_rmse"]) == (2, 1)
    assert (row["best_horizon_r2"], row["worst_horizon_r2"]) == (2, 1)
    assert row["rmse_median"] == 2.0 and row["rmse_std"] == pytest.approx(1.0)


def test_training_metrics_agree_with_overall(spark):
    rng = np.random.default_rng(3)
    y, p = rng.normal(50, 9, (20, 24)), rng.normal(50, 9, (20, 24))
    df = pairs(spark, y, p).selectExpr("*", "'test' AS split")
    got = {r["metric_name"]: r["metric_value"] for r in ops.training_metrics(df).collect()}
    row = ops.overall_metrics(df).first()
    for m in ("rmse", "mae", "r2"):
        assert got[f"test_{m}_overall"] == pytest.approx(row[m])
    assert got["test_rmse_6h"] == pytest.approx(np.sqrt(((y - p)[:, 5] ** 2).mean()))
    assert len(got) == 3 + 8 + 4


def test_model_comparison_keeps_the_earlier_on_a_tie(spark):
    rows = [("b", 0, 1.0, 2.0, 0.5, 9.0, 10.0), ("a", 1, 1.0, 1.0, 0.5, 8.0, 10.0), ("c", 2, 4.0, 3.0, 0.9, 7.0, 5.0)]
    df = spark.createDataFrame(
        rows, "model_name string, model_index int, rmse double, mae double, r2 double, mape double, "
              "predictions_within_10pct double")
    row = ops.compare_models(df).first()
    assert (row["best_rmse"], row["best_mae"], row["best_r2"], row["best_mape"]) == ("b", "a", "c", "c")
    assert row["recommendation"] == "b" and row["best_predictions_within_10pct"] == "b"
    assert row["rmse_improvement"] == 75.0


def test_predictions_close(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 100.0), (3, 5.0)], "id int, y_hat double")
    b = spark.createDataFrame([(1, 1.0), (2, 100.0005), (4, 5.0)], "id int, y_hat double")
    row = ops.predictions_close(a, b, ["id"]).first()
    assert (row["compared"], row["close"], row["all_close"]) == (4, 2, False)
    assert ops.predictions_close(a, a, ["id"]).first()["all_close"]
