import pandas as pd
import pytest
from pyspark.sql import functions as F

from frames import hourly_rows, series
from watthour.operators.blocks import over_rows, with_positions
from watthour.operators.features import lag_features, lead_targets


def wave(n):
    return [(i * 37 % 101) + i / 7 for i in range(n)]


def pandas_features(values):
    v = pd.Series(values)
    out = {f"ac_power_lag_{d}d": v.shift(24 * d) for d in (1, 2)}
    roll = v.rolling(48, min_periods=24)
    for name, f in (("mean", roll.mean()), ("std", roll.std()), ("max", roll.max())):
        out[f"rolling_{name}_2d"] = f.shift(24)
    out["same_hour_last_week"] = v.shift(168)
    out["same_hour_2_weeks_ago"] = v.shift(336)
    return pd.DataFrame(out)


def ordered(df, *columns):
    rows = df.orderBy("date_time").select(*columns).collect()
    return pd.DataFrame([tuple(r) for r in rows], columns=columns).astype(float)


@pytest.mark.parametrize("block_rows", [17, 100, 4096])
def test_blocks_match_row_shifts_over_gaps_and_months(spark, block_rows):
    values = wave(1000)
    df = series(spark, values, skip={5, 30, 31, 700})
    expected = pandas_features(values)
    got = ordered(lag_features(df, lag_days=(1, 2), rolling_days=(2,), block_rows=block_rows), *expected.columns)
    pd.testing.assert_frame_equal(got, expected, rtol=1e-9)


def test_one_key_equals_no_key(spark):
    values = wave(400)
    bare = lag_features(series(spark, values), lag_days=(1,), rolling_days=(2,))
    keyed = lag_features(series(spark, values, key="a"), keys=["plant"], lag_days=(1,), rolling_days=(2,))
    split = lag_features(series(spark, values, key="a"), keys=["plant"], lag_days=(1,), rolling_days=(2,), block_rows=50)
    columns = [c for c in bare.columns if c != "date_time"]
    pd.testing.assert_frame_equal(ordered(bare, *columns), ordered(keyed, *columns))
    pd.testing.assert_frame_equal(ordered(bare, *columns), ordered(split, *columns))


@pytest.mark.parametrize("block_rows", [10, 4096])
def test_leads(spark, block_rows):
    values = wave(200)
    got = ordered(lead_targets(series(spark, values), horizon=3, block_rows=block_rows), "ac_power_1h", "ac_power_3h")
    v = pd.Series(values)
    expected = pd.DataFrame({"ac_power_1h": v.shift(-1), "ac_power_3h": v.shift(-3)})
    pd.testing.assert_frame_equal(got, expected)


def test_positions_per_series_with_a_null_key(spark):
    rows = [("a", *r) for r in hourly_rows(range(900))] + [(None, *r) for r in hourly_rows(range(5))]
    df = spark.createDataFrame(rows, "plant string, date_time timestamp_ntz, ac_power double")
    got = with_positions(df, "date_time", ["plant"])
    assert got.where(F.col("_pos") != F.col("ac_power")).count() == 0
    assert {tuple(r) for r in got.groupBy("plant", "_total").count().collect()} == {("a", 900, 900), (None, 5, 5)}


def test_keyless_windows_stay_off_a_single_partition(spark):
    df = over_rows(series(spark, wave(50)), lambda w: {"x": F.lag("ac_power").over(w)}, ts="date_time", behind=1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    # the only single-partition step is the table of monthly counts
    assert sum("SinglePartition" in line for line in exchanges) <= 1
    assert any("_block" in line for line in exchanges)


def test_future_rows_never_reach_features(spark):
    values = wave(400)
    changed = values[:300] + [v * 9 + 1 for v in values[300:]]
    a = lag_features(series(spark, values), lag_days=(1,), rolling_days=(2,))
    b = lag_features(series(spark, changed), lag_days=(1,), rolling_days=(2,))
    columns = [c for c in a.columns if c not in ("date_time", "ac_power")]
    # rows up to 24 hours after the change still look only at what came before it
    pd.testing.assert_frame_equal(ordered(a, *columns)[:324], ordered(b, *columns)[:324])
