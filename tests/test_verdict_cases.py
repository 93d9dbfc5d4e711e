import pytest

from watthour.operators.drift import score_moments
from watthour.operators.evaluate import overall_metrics


def test_null_actuals_do_not_count(spark):
    pairs = spark.createDataFrame([(1, 1.0, 1.0), (1, 2.0, 2.0), (1, None, 3.0)], "horizon int, y double, y_hat double")
    row = overall_metrics(pairs).first()
    assert (row.rmse, row.predictions_within_10pct, row.total_samples) == (0.0, 100.0, 2)


def test_reference_with_a_repeated_feature_is_refused(spark):
    current = spark.createDataFrame([("a", 1.0, 1.0)], "feature string, current_mean double, current_std double")
    reference = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 1.0)], "feature string, mean double, std double")
    with pytest.raises(Exception, match="reference repeats feature a"):
        score_moments(current, reference).collect()
    assert score_moments(current, reference.limit(1)).first().drift_score is not None
