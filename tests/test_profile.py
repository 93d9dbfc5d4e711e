import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from watthour.operators import profile as ops
from watthour.operators.correlation import correlation_matrix, correlation_pairs, correlation_summary, high_pairs

NAN = float("nan")
DATA = {
    "a": [1.0, 2.0, 2.0, 3.0, 50.0, None, NAN, 4.0],
    "b": [3.0] * 8,
    "c": [None] * 8,
    "d": [8.0, 7.0, 6.0, 5.0, 4.0, 3.0, 2.0, 1.0],
    "flag": [True, False, True, True, False, True, None, True],
    "text": ["x", "y", "x", None, "z", "x", "y", "y"],
}


@pytest.fixture(scope="module")
def df(spark):
    rows = list(zip(*DATA.values()))
    return spark.createDataFrame(rows, "a double, b double, c double, d double, flag boolean, text string")


@pytest.fixture(scope="module")
def numeric(df):
    return {r["feature"]: r for r in ops.profile_numeric(df).collect()}


@pytest.mark.parametrize("name", ["a", "d", "flag"])
def test_numbers_match_pandas(numeric, name):
    s = pd.Series([np.nan if v is None else float(v) for v in DATA[name]]).dropna()
    row = numeric[name]
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    expected = {
        "count": len(s), "missing_count": 8 - len(s), "missing_percentage": (8 - len(s)) / 8 * 100,
        "unique_values": s.nunique(), "mode": s.mode().iloc[0], "mean": s.mean(), "median": s.median(),
        "std": s.std(), "variance": s.var(), "min": s.min(), "max": s.max(), "range": s.max() - s.min(),
        "q1": q1, "q3": q3, "iqr": q3 - q1, "skewness": s.skew(), "kurtosis": s.kurt(),
        "outlier_count": ((s < q1 - 1.5 * (q3 - q1)) | (s > q3 + 1.5 * (q3 - q1))).sum(),
    }
    for field, value in expected.items():
        assert row[field] == pytest.approx(value, rel=1e-9), field
    assert row["outlier_percentage"] == pytest.approx(expected["outlier_count"] / len(s) * 100)
    assert not row["is_constant"]


def test_constant_column(numeric):
    row = numeric["b"]
    assert (row["is_constant"], row["skewness"], row["kurtosis"], row["std"]) == (True, 0.0, 0.0, 0.0)


def test_all_null_column_gets_the_template(numeric):
    row = numeric["c"]
    assert (row["count"], row["missing_count"], row["missing_percentage"]) == (0, 0, 100.0)
    assert (row["dtype"], row["unique_values"], row["is_constant"]) == ("unknown", 0, True)
    assert (row["outlier_count"], row["outlier_percentage"], row["mean"], row["mode"]) == (0, 0.0, None, None)


def test_text_column(df):
    row = ops.profile_strings(df).first()
    assert (row["count"], row["missing_count"], row["unique_values"], row["mode"]) == (7, 1, 3, "x")
    assert row["mean"] is None and row["outlier_count"] == 0


def test_roll_up_and_slim_reference(df):
    profile = ops.feature_profile(df)
    assert profile.count() == 6
    row = ops.quality_summary(profile).first()
    assert (row["features_with_missing"], row["features_constant"], row["features_with_outliers"]) == (3, 2, 1)
    assert row["average_missing_percentage"] == pytest.approx((25 + 0 + 100 + 0 + 12.5 + 12.5) / 6)
    assert {r["feature"] for r in ops.drift_reference(profile).collect()} == {"a", "b", "d", "flag"}


def test_describe_keeps_empty_columns(df):
    rows = {r["feature"]: r for r in ops.describe(df, ["a", "c"]).collect()}
    assert rows["c"]["count"] == 0 and rows["c"]["mean"] is None
    s = pd.Series(DATA["a"], dtype=float)
    assert rows["a"]["p50"] == s.median() and rows["a"]["std"] == pytest.approx(s.std())


def test_null_counts(df):
    got = {r["column_name"]: r["null_count"] for r in ops.null_counts(df).collect()}
    assert got == {"a": 1, "b": 0, "c": 8, "d": 0, "flag": 1, "text": 1}


def test_histogram_keeps_empty_bins_and_the_maximum(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 1.0, 1.5, 10.0)], "v double")
    rows = ops.histogram(df, {"v": 5}).orderBy("bin").collect()
    assert [r["count"] for r in rows] == np.histogram([0, 1, 1.5, 10], 5)[0].tolist()
    flat = ops.histogram(spark.createDataFrame([(2.0,)] * 3, "v double"), {"v": 4}).collect()
    assert sum(r["count"] for r in flat) == 3 and len(flat) == 4


def test_target_stats(spark):
    rows = [(1.0, 10.0), (2.0, None), (4.0, 30.0)]
    df = spark.createDataFrame(rows, "t1 double, t2 double")
    row = ops.target_stats(df, ["t1", "t2"]).first()
    flat = np.array([1, 2, 4, 10, 30.0])
    assert (row["total_samples"], row["total_predictions"], row["missing_predictions"]) == (3, 6, 1)
    assert row["overall_std"] == pytest.approx(flat.std()) and row["overall_median"] == 4.0
    by = {r["horizon"]: r for r in ops.target_stats_by_horizon(df, ["t1", "t2"]).collect()}
    assert by[1]["std"] == pytest.approx(np.std([1, 2, 4], ddof=1)) and by[2]["count"] == 2


def test_correlation_uses_pairwise_rows_and_skips_constants(df):
    got = {(r["feature_1"], r["feature_2"]): r["correlation"]
           for r in correlation_pairs(df, ["a", "b", "d"]).collect()}
    frame = pd.DataFrame({k: pd.Series(DATA[k], dtype=float) for k in "abd"})
    assert got["a", "d"] == pytest.approx(frame.corr().loc["a", "d"])
    assert got["a", "b"] is None and got["b", "d"] is None


def test_correlation_summary(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 1.0), (3.0, 6.0, 4.0)], "x double, y double, z double")
    matrix = correlation_matrix(df, ["x", "y", "z"])
    assert matrix.count() == 9
    row = correlation_summary(matrix).first()
    frame = pd.DataFrame({"x": [1, 2, 3], "y": [2, 4, 6], "z": [5, 1, 4]})
    assert row["average_absolute_correlation"] == pytest.approx(frame.corr().abs().values.mean())
    assert row["high_correlation_count"] == 1
    assert [r["feature_2"] for r in high_pairs(correlation_pairs(df, ["x", "y", "z"])).collect()] == ["y"]
    constant = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    summary = correlation_summary(correlation_matrix(constant, ["x", "y"])).first()
    assert summary["average_absolute_correlation"] == 0.0
    with pytest.raises(ValueError):
        correlation_pairs(df, ["x"])
    assert math.isclose(matrix.where("feature_1 = feature_2").first()["correlation"], 1.0)


def test_a_frame_without_rows_has_a_template_row_for_every_column(spark):
    empty = spark.createDataFrame([], "x double, y string")
    got = {r["feature"]: r for r in ops.feature_profile(empty).collect()}
    assert set(got) == {"x", "y"}
    for row in got.values():
        assert (row["count"], row["missing_percentage"], row["dtype"], row["is_constant"], row["outlier_count"]) == (0, 100.0, "unknown", True, 0)
        assert row["mean"] is None and row["mode"] is None


def test_positive_histogram_leaves_out_zero_and_below(spark):
    df = spark.createDataFrame([(-5.0,), (0.0,), (1.0,), (2.0,), (None,)], "x double")
    got = ops.histogram(df, {"x": 2}, positive=True).orderBy("bin").collect()
    assert [(r["bin_start"], r["count"]) for r in got] == [(1.0, 1), (1.5, 1)]


def test_a_frame_called_complete_is_checked(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 6.0)], "x double, y double")
    with pytest.raises(Exception, match="missing values in a complete frame"):
        correlation_pairs(df, ["x", "y"], complete=True).collect()
    assert correlation_pairs(df, ["x", "y"]).first()["correlation"] == pytest.approx(1.0)


def test_correlation_over_many_blocks_with_missing_values(spark):
    """Blocks of 4 columns and three tasks, pairs over their common rows, constants within those."""
    rng = np.random.default_rng(3)
    x = 1e6 + rng.normal(size=(120, 10)).cumsum(axis=1)
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7] = 5.5
    x[:, 8] = np.nan
    x[60:, 9] = 3.0
    x[:60, 3] = np.nan  # 9 is constant where 3 is there
    names = [f"c{i}" for i in range(10)]
    df = spark.createDataFrame(x.tolist(), ", ".join(f"{n} double" for n in names)).repartition(3)
    want = pd.DataFrame(x, columns=names).corr()
    want.loc["c3", "c9"] = want.loc["c9", "c3"] = np.nan
    got = {(r[0], r[1]): r[2] for r in correlation_matrix(df, names, block=4).collect()}
    assert len(got) == 100
    for (a, b), r in got.items():
        assert (r is None) == bool(np.isnan(want.loc[a, b])), (a, b)
        assert r is None or r == pytest.approx(want.loc[a, b], abs=1e-7)


def test_correlation_of_three_hundred_columns(spark):
    rows = spark.range(0, 20000, 1, 4).select(*[(F.pmod(F.xxhash64("id", F.lit(i // 3)), F.lit(1000)) + F.pmod(F.xxhash64("id", F.lit(1000 + i)), F.lit(300))).alias(f"c{i}") for i in range(300)])
    pairs = correlation_pairs(rows, rows.columns)
    assert pairs.count() == 300 * 299 // 2
    assert {(r[0], r[1]) for r in high_pairs(pairs).collect()} == {(f"c{3 * k + a}", f"c{3 * k + b}") for k in range(100) for a, b in ((0, 1), (0, 2), (1, 2))}


def test_drift_statistics_equal_the_slim_profile_without_shuffling_values(df):
    numbers = [c for c in ("a", "b", "c", "d") if c in ops.numeric_columns(df)]
    slim = ops.drift_statistics(df, numbers)
    got = {r["feature"]: r.asDict() for r in slim.collect()}
    want = {r["feature"]: r.asDict() for r in ops.drift_reference(ops.profile_numeric(df, numbers)).collect()}
    assert got.keys() == want.keys()
    for name, row in want.items():
        for field, x in row.items():
            assert got[name][field] == (x if x is None or field == "feature" else pytest.approx(x)), (name, field)
    assert "hashpartitioning(feature#" in slim._jdf.queryExecution().executedPlan().toString()
    keyed_by_value = [line for line in slim._jdf.queryExecution().executedPlan().toString().split("\n") if "hashpartitioning" in line and "value#" in line]
    assert keyed_by_value == []
