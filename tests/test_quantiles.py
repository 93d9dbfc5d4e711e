import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from watthour.operators.quantiles import exact_percentiles

PROBS = {"p0": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99, "p100": 1.0}


def samples():
    rng = random.Random(7)
    return {
        "uniform": [rng.random() for _ in range(3000)],
        "heavy tail": [rng.random() ** -3 for _ in range(3000)] + [1e300, -1e300],
        "few values": [float(rng.randint(0, 3)) for _ in range(3000)],
        "mostly one value": [1.0] * 2000 + [rng.random() for _ in range(100)],
        "constant": [4.5] * 10,
        "single": [3.0],
        "two": [1.0, 2.0],
        "close together": [1.0 + i * 2.0 ** -50 for i in range(500)],
    }


@pytest.fixture(scope="module")
def got(spark):
    rows = [(name, v) for name, values in samples().items() for v in values]
    df = spark.createDataFrame(rows + [("empty", None)], "feature string, value double").repartition(7)
    out = exact_percentiles(df, ["feature"], "value", PROBS, also={"n": F.count("value")})
    return {r["feature"]: r for r in out.collect()}


@pytest.mark.parametrize("name", list(samples()))
def test_exact(got, name):
    values = samples()[name]
    expected = np.quantile(values, list(PROBS.values()))
    np.testing.assert_allclose([got[name][p] for p in PROBS], expected, rtol=1e-12)
    assert got[name]["n"] == len(values)


def test_group_without_values_is_absent(got):
    assert "empty" not in got


def test_large_group_goes_through_brackets(spark):
    df = spark.range(300_000).select(F.lit("x").alias("feature"), F.pow(F.col("id") * 7919 % 300_000, 2).alias("value"))
    row = exact_percentiles(df, ["feature"], "value", {"q1": 0.25, "q3": 0.75}).first()
    values = np.arange(300_000, dtype=float) ** 2
    np.testing.assert_allclose([row["q1"], row["q3"]], np.quantile(values, [0.25, 0.75]), rtol=1e-12)


def test_every_small_size(spark):
    rows = [(n, float(i * i)) for n in range(1, 60) for i in range(n)]
    df = spark.createDataFrame(rows, "size int, value double").repartition(5)
    for row in exact_percentiles(df, ["size"], "value", PROBS).collect():
        expected = np.quantile(np.arange(row["size"], dtype=float) ** 2, list(PROBS.values()))
        np.testing.assert_allclose([row[p] for p in PROBS], expected, rtol=1e-12)


@pytest.mark.parametrize("low", [149_999, 150_000, 150_001])
def test_percentile_between_distant_clusters(spark, low):
    value = F.when(F.col("id") < low, F.col("id") * 1e-9).otherwise(1e12 + F.col("id"))
    df = spark.range(300_000).select(F.lit("x").alias("feature"), value.cast("double").alias("value"))
    row = exact_percentiles(df, ["feature"], "value", {"median": 0.5, "p99": 0.99}).first()
    ids = np.arange(300_000, dtype=float)
    expected = np.quantile(np.where(ids < low, ids * 1e-9, 1e12 + ids), [0.5, 0.99])
    np.testing.assert_allclose([row["median"], row["p99"]], expected, rtol=1e-12)
