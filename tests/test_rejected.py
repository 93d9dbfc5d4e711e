import pytest
from pyspark.sql import functions as F

from frames import solar_days
from watthour.operators.correlation import correlation_report
from watthour.plans.training import fit_dataset

SCHEMA = "plant string, date_time timestamp_ntz, ac_power double"


def test_a_short_series_is_left_out_with_its_reason(spark):
    rows = [(p, t, v) for p, days in (("a", 6), ("b", 1)) for t, v in solar_days(days)]
    readings = spark.createDataFrame(rows, SCHEMA)
    settings = dict(keys=["plant"], lag_days=(1, 2), rolling_days=(1,), horizon=2)
    with pytest.raises(ValueError, match="1 series not fit"):
        fit_dataset(readings, **settings)
    out, fitted = fit_dataset(readings, drop_unfit=True, **settings)
    alone, _ = fit_dataset(readings.where("plant = 'a'"), **settings)
    assert fitted.rejected.select("plant", "reasons").collect() == [("b", ["24 hours, 48 needed"])]
    assert out.count() == alone.count() and not out.where(F.col("plant") != "a").count()
    with pytest.raises(ValueError, match="no series fit"):
        fit_dataset(readings.where("plant = 'b'"), drop_unfit=True, **settings)


def test_correlation_of_too_few_columns_is_a_status(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 5.0), (3.0, 1.0)], "x double, y double")
    one, two = correlation_report(df, ["x"]), correlation_report(df, ["x", "y"])
    assert sorted(one.columns) == sorted(two.columns)
    row = one.first()
    assert (row["correlation_computed"], row["reason"], row["numeric_features_count"]) == (False, "insufficient_numeric_features", 1)
    row = two.first()
    assert row["correlation_computed"] and row["reason"] is None and row["average_absolute_correlation"] > 0
