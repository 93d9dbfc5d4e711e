from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frames import START, series
from watthour.functions.calendar import calendar_columns
from watthour.functions.stats import seconds_between, whole_days
from watthour.operators import hourly as ops
from watthour.operators.checks import forbidden_present, leakage_report, require_valid
from watthour.operators.forecast import midnight_features
from watthour.operators.explore import daily_totals, hour_profile, peak_hour

SCHEMA = "date_time timestamp_ntz, ac_power double"


def test_hourly_mean_averages_readings_and_drops_empty_hours(spark):
    at = lambda minute: START + timedelta(minutes=minute)
    rows = [(at(0), 1.0), (at(15), 3.0), (at(59), None), (at(60), float("nan")), (at(120), 5.0), (at(179), 7.0)]
    got = ops.hourly_mean(spark.createDataFrame(rows, SCHEMA)).orderBy("date_time").collect()
    assert [tuple(r) for r in got] == [(START, 2.0), (at(120), 6.0)]


def test_fill_hours_restores_the_clock(spark):
    filled = ops.fill_hours(series(spark, range(4), skip={1, 2}))
    got = [r["ac_power"] for r in filled.orderBy("date_time").collect()]
    assert got == [0.0, None, None, 1.0, 2.0, 3.0]


def test_gap_report(spark):
    row = ops.gap_report(series(spark, range(6), skip={2, 3, 5})).first()
    assert (row["total_gaps"], row["max_gap_hours"], row["gap_locations"]) == (2, 3.0, [2, 3])
    none = ops.gap_report(series(spark, range(3))).first()
    assert (none["total_gaps"], none["max_gap_hours"], none["gap_locations"]) == (0, 0.0, [])


def test_gap_locations_stop_at_ten(spark):
    row = ops.gap_report(series(spark, range(20), skip=set(range(1, 60, 2)))).first()
    assert row["total_gaps"] == 19 and row["gap_locations"] == list(range(1, 11))


def test_frequency(spark):
    assert ops.frequency_check(series(spark, range(5))).first()["frequency_consistent"]
    assert ops.frequency_check(series(spark, [1])).first()["frequency_consistent"]
    quarter = spark.createDataFrame([(START + timedelta(minutes=15 * i), 1.0) for i in range(5)], SCHEMA)
    assert not ops.frequency_check(quarter).first()["frequency_consistent"]
    assert ops.frequency_check(quarter, expected_seconds=900).first()["frequency_consistent"]


def test_modal_step_takes_the_smallest_on_a_tie(spark):
    row = ops.frequency_check(series(spark, range(3), skip={1})).first()
    assert row["modal_step_seconds"] == 3600.0


@pytest.mark.parametrize("width", [2, 3, 1000])
def test_order_check_sees_steps_inside_and_across_blocks(spark, width):
    hours = [0, 1, 1, 3, 2, 5, 4, 6]
    rows = [(i, START + timedelta(hours=h)) for i, h in enumerate(hours)]
    df = spark.createDataFrame(rows, "n long, date_time timestamp_ntz").repartition(4)
    row = ops.order_check(df, "date_time", "n", width=width).first()
    assert (row["records"], row["steps_back"], row["is_sorted"]) == (8, 2, False)


def test_load_summary(spark):
    readings = series(spark, range(50))
    row = ops.load_summary(readings, readings.limit(49), weather=None).first()
    assert (row["generation_records"], row["processed_records"], row["weather_available"]) == (50, 49, False)
    assert row["total_days"] == 2 or row["total_days"] == 1


def test_report_of_a_good_series(spark):
    report = leakage_report(series(spark, range(200)), lag_days=(1, 7))
    row = report.first()
    assert row["overall_valid"] and row["frequency_consistent"] and row["total_days"] == 8
    require_valid(report)


def test_report_of_a_bad_series(spark):
    rows = [(START, 1.0), (START, -2.0), (START + timedelta(hours=5), None), (None, 1.0), (None, 2.0)]
    row = leakage_report(spark.createDataFrame(rows, SCHEMA), lag_days=(1,)).first()
    assert (row["total_records"], row["missing_values"], row["negative_values"]) == (5, 1, 1)
    # the second of two equal times and the second missing time
    assert row["duplicate_timestamps"] == 2
    assert (row["total_gaps"], row["max_gap_hours"]) == (1, 5.0)
    assert not row["sufficient_history"] and not row["overall_valid"]


def test_two_rows_are_not_enough(spark):
    with pytest.raises(ValueError):
        require_valid(leakage_report(series(spark, [1, 2]), lag_days=(1,)))


def test_forbidden_columns(spark):
    df = series(spark, range(30)).withColumn("irradiation", F.lit(1.0))
    assert forbidden_present(df) == ["IRRADIATION"]
    assert not leakage_report(df, lag_days=(1,)).first()["overall_valid"]


@pytest.mark.parametrize("moment, weekday, quarter, season", [
    (datetime(2024, 1, 1, 6), 0, 1, "winter"), (datetime(2024, 3, 31, 19), 6, 1, "spring"),
    (datetime(2024, 6, 1, 10), 5, 2, "summer"), (datetime(2024, 9, 30, 14), 0, 3, "autumn"),
    (datetime(2024, 12, 31, 23), 1, 4, "winter"),
])
def test_calendar(spark, moment, weekday, quarter, season):
    df = spark.createDataFrame([(moment,)], "t timestamp_ntz")
    row = df.withColumns(calendar_columns(F.col("t"))).first()
    assert (row["hour_of_day"], row["day_of_week"], row["quarter"]) == (moment.hour, weekday, quarter)
    assert row["day_of_year"] == moment.timetuple().tm_yday
    assert [s for s in ("autumn", "spring", "summer", "winter") if row[f"season_{s}"]] == [season]
    assert row["is_weekend"] == int(weekday >= 5)
    assert row["is_daylight"] == int(6 <= moment.hour <= 18) and row["is_peak_solar"] == int(10 <= moment.hour <= 14)


def test_peak_hour_takes_the_earliest_on_a_tie(spark):
    df = series(spark, [1, 9, 9, 2])
    row = peak_hour(hour_profile(df)).first()
    assert (row["peak_hour"], row["peak_mean"]) == (1, 9.0)
    assert daily_totals(df).first()["total_value"] == 21.0


def test_session_zone_and_its_clock_change_do_not_matter(spark):
    # clocks in New York skip 2024-03-10 02:00
    rows = [(datetime(2024, 3, 9, 12) + timedelta(hours=i, minutes=5), float(i)) for i in range(30)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        hourly = ops.hourly_mean(spark.createDataFrame(rows, SCHEMA))
        assert hourly.count() == 30
        row = leakage_report(hourly, lag_days=(1,)).first()
        assert (row["total_gaps"], row["duplicate_timestamps"], row["frequency_consistent"]) == (0, 0, True)
        features = midnight_features(hourly, date(2024, 3, 10), date(2024, 3, 10), lag_days=(1,), rolling_days=(1,))
        assert features.first()["anchor_ts"] == datetime(2024, 3, 9, 23)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_seconds_keep_fractions(spark):
    rows = [(START, START + timedelta(days=3, hours=2, seconds=1, microseconds=250_000))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    row = df.select(seconds_between(F.col("a"), F.col("b")), whole_days(F.col("a"), F.col("b"))).first()
    assert tuple(row) == (266401.25, 3)


def test_an_outlying_year_fills_the_clock_without_a_giant_array(spark):
    rows = [(datetime(1970, 1, 31, 5), 1.0), (datetime(2004, 2, 29, 23), 2.0), (datetime(2004, 3, 1, 0), 3.0)]
    df = spark.createDataFrame(rows, "date_time timestamp_ntz, ac_power double")
    filled = ops.fill_hours(df)
    hours = int((rows[-1][0] - rows[0][0]).total_seconds() // 3600) + 1
    seen = filled.agg(F.count("*"), F.count("ac_power"), F.count_distinct("date_time"), F.min("date_time"), F.max("date_time")).first()
    assert tuple(seen) == (hours, 3, hours, rows[0][0], rows[-1][0])
    shares = filled.groupBy(F.spark_partition_id()).count().collect()
    assert len(shares) > 4


def test_each_series_is_filled_within_its_own_span(spark):
    rows = [("a", datetime(2024, 1, 31, 22), 1.0), ("a", datetime(2024, 2, 1, 1), 2.0), ("b", datetime(2024, 2, 1, 0), None)]
    df = spark.createDataFrame(rows, "plant string, date_time timestamp_ntz, ac_power double")
    got = sorted((r["plant"], r["date_time"], r["ac_power"]) for r in ops.fill_hours(df, keys=["plant"]).collect())
    assert [g[1].hour for g in got] == [22, 23, 0, 1, 0] and [g[2] for g in got] == [1.0, None, None, 2.0, None]
    assert ops.fill_hours(df.limit(0), keys=["plant"]).count() == 0
