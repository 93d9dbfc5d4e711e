from datetime import datetime

import pytest
from pyspark.sql import functions as F

from watthour.operators import drift as ops
from watthour.operators import monitor as mon
from watthour.plans.monitoring import monitoring_run

def at(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize("cm, cs, rm, rs, expected", [
    (3.0, 1.0, 1.0, 1.0, 2.0),
    (1.0, 2.0, 1.0, 1.0, 0.5),
    (1.0, 0.5, 1.0, 1.0, 0.5),
    (1.0, None, 1.0, 2.0, 0.0),
    (2.0, float("nan"), 1.0, 2.0, 0.5),
    (1.0, 0.0, 1.0, 2.0, 0.0),
    (1.0, 1e-6, 1.0, 0.0, 0.0),
    (1.0, 1e-6, 1.0, float("nan"), 0.0),
    (1.0 + 1e-6, 0.0, 1.0, None, 1.0),
])
def test_score(spark, cm, cs, rm, rs, expected):
    df = spark.createDataFrame([(cm, cs, rm, rs)], "cm double, cs double, rm double, rs double")
    assert df.select(ops.drift_score(*[F.col(c) for c in df.columns])).first()[0] == pytest.approx(expected, rel=1e-6)


@pytest.fixture(scope="module")
def reference(spark):
    rows = [("a", 1.0, 1.0), ("b", 10.0, 2.0), ("flag", 0.5, 0.5), ("gone", 1.0, 1.0)]
    return spark.createDataFrame(rows, "feature string, mean double, std double")


def test_detect(spark, reference):
    df = spark.createDataFrame([(5.0, 10.0, True, None, 1.0), (6.0, 12.0, False, None, 2.0)],
                               "a double, b double, flag boolean, gone double, unknown double")
    got = {r["feature"]: r for r in ops.detect_drift(df, reference).collect()}
    # no reference for one feature, no values for another: both skipped
    assert set(got) == {"a", "b", "flag"}
    assert got["a"]["drift_detected"] and not got["b"]["drift_detected"]
    row = ops.drift_summary(ops.detect_drift(df, reference)).first()
    assert (row["overall_drift_detected"], row["features_analyzed"], row["drifted_features"]) == (True, 3, ["a"])
    assert row["max_drift_score"] == got["a"]["drift_score"]


def test_summary_of_nothing(spark, reference):
    scores = ops.detect_drift(spark.createDataFrame([], "a double"), reference)
    row = ops.drift_summary(scores).first()
    assert (row["overall_drift_detected"], row["features_analyzed"], row["average_drift_score"]) == (False, 0, 0.0)
    assert row["drifted_features"] == []


@pytest.fixture(scope="module")
def log(spark):
    def day(n, h=0):
        return datetime(2024, 1, n, h)
    rows = [(day(1), "a", 3.0, True), (day(9), "a", 3.0, True), (day(9, 5), "b", 1.0, False), (day(9), "c", 4.0, True),
            (day(10), "b", 2.5, True), (day(10), "c", 1.0, False), (day(10), "a", 2.1, True)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, feature_name string, drift_score double, drift_detected boolean")


def test_trends(log):
    daily = {str(r["drift_date"]): r for r in mon.drift_daily(log, at("2024-01-11")).collect()}
    assert set(daily) == {"2024-01-09", "2024-01-10"}
    assert daily["2024-01-09"]["drift_rate"] == 66.7
    assert mon.drift_rate(log, at("2024-01-11")).first()["overall_drift_rate"] == 66.67
    empty = mon.drift_rate(log, at("2025-01-11")).first()
    assert (empty["overall_drift_rate"], empty["total_feature_checks"]) == (0.0, 0)
    top = mon.drift_top(log, at("2024-01-11"), 2).collect()
    assert [(r["feature_name"], r["drift_count"]) for r in top] == [("a", 2), ("b", 1)]


def test_lookback_includes_its_edge(log):
    assert mon.drift_rate(log, at("2024-01-17"), 7).first()["total_feature_checks"] == 3
    assert mon.drift_rate(log, at("2024-01-16 05:00:00"), 7).first()["total_feature_checks"] == 4


@pytest.mark.parametrize("rate, recent, have, healthy, expected", [
    (25.0, 3, True, True, ["high_drift_consider_retraining"]),
    (20.0, 3, True, True, []),
    (10.0, 3, True, True, []),
    (9.9, 3, True, True, ["operating_normally"]),
    (0.0, 0, False, False, ["no_recent_predictions_check_daily_run", "no_reference_run_training"]),
])
def test_recommendations(spark, rate, recent, have, healthy, expected):
    df = spark.createDataFrame([(rate, recent, have, healthy)], "r double, n long, h boolean, ok boolean")
    got = df.select(mon.recommendations(F.col("r"), F.col("n"), F.col("h"), F.col("ok"))).first()[0]
    assert got == expected


def test_monitoring_run(spark, log):
    predictions = spark.createDataFrame([(datetime(2024, 1, 10, 12),)], "created_at timestamp_ntz")
    one = spark.createDataFrame([(1,)], "id int")
    out = monitoring_run(log, predictions, one, one.limit(0), at("2024-01-11"))
    health = out["health"].first()
    assert (health["performance_records"], health["drift_records"], health["overall_healthy"]) == (0, 7, True)
    report = out["report"].first()
    assert report["top_drifted_features"] == "a: 2 events; b: 1 events; c: 1 events"
    assert report["recommendations"] == "high_drift_consider_retraining" and report["recommendations_count"] == 1
    unhealthy = monitoring_run(log, predictions, one.limit(0), one, at("2025-01-11"))["report"].first()
    assert unhealthy["recommendations_count"] == 2 and not unhealthy["overall_healthy"]
    assert unhealthy["top_drifted_features"] == ""
