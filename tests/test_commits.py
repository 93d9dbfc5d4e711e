from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from threading import Barrier, local

import pytest
from pyspark.sql import functions as F

from test_store import forecast, profile
from watthour.schemas import DRIFT_LOG, PREDICTIONS, REFERENCE_DATA
from watthour.sources import commits, tables


@pytest.fixture
def together(monkeypatch):
    """Both writers reach their first publication before either makes it."""
    barrier, seen, real = Barrier(2, timeout=120), local(), commits.publish

    def publish(*args):
        if not getattr(seen, "waited", False):
            seen.waited = True
            barrier.wait()
        return real(*args)

    monkeypatch.setattr(commits, "publish", publish)
    monkeypatch.setattr(tables, "publish", publish)


def both(*tasks):
    def caught(task):
        try:
            return task()
        except RuntimeError as error:
            return str(error)
    with ThreadPoolExecutor(2) as pool:
        return list(pool.map(caught, tasks))


def test_of_two_writers_of_one_key_one_gets_the_conflict(spark, tmp_path, together):
    path = str(tmp_path / "p")
    got = both(lambda: tables.save_predictions(forecast(spark, date(2024, 1, 1), power=1.0), path),
               lambda: tables.save_predictions(forecast(spark, date(2024, 1, 1), power=2.0), path))
    assert sorted(map(str, got)) == ["1", "duplicate prediction: already exists"]
    assert tables.read_table(spark, path, PREDICTIONS).count() == 1
    assert not list((tmp_path / "p" / "_staging").iterdir())


def test_two_writers_of_different_keys_both_commit(spark, tmp_path, together):
    path = str(tmp_path / "p")
    got = both(lambda: tables.save_predictions(forecast(spark, date(2024, 1, 1), model="a"), path),
               lambda: tables.save_predictions(forecast(spark, date(2024, 1, 1), model="b"), path))
    assert sorted(got) == [1, 2] and commits.numbers(spark, path) == [1, 2]
    assert {r["model_name"] for r in tables.read_table(spark, path, PREDICTIONS).collect()} == {"a", "b"}


def test_an_upsert_that_lost_the_race_keeps_the_winners_rows(spark, tmp_path, together):
    path, stamp = str(tmp_path / "r"), datetime(2024, 1, 1)
    got = both(*[lambda v=v: tables.upsert_table(profile(spark, v, 10, stamp), path, REFERENCE_DATA) for v in "12"])
    assert sorted(got) == [1, 2]
    assert {r["model_version"] for r in tables.read_version(spark, path, REFERENCE_DATA).collect()} == {"1", "2"}


def test_rows_are_computed_once_and_nothing_stays_after_an_error(spark, tmp_path):
    path = str(tmp_path / "p")
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        calls.add(1)
        return x

    rows = forecast(spark, date(2024, 1, 1), date(2024, 1, 2))
    tables.save_predictions(rows.withColumn("peak_power", counted("peak_power")), path)
    assert calls.value == 2
    for bad in (rows, rows.withColumn("peak_power", F.lit(None).cast("double")), forecast(spark, date(2024, 5, 1), date(2024, 5, 1))):
        with pytest.raises(Exception):
            tables.save_predictions(bad, path)
    assert commits.numbers(spark, path) == [1] and not list((tmp_path / "p" / "_staging").iterdir())


def test_no_rows_make_an_empty_commit(spark, tmp_path):
    path = str(tmp_path / "p")
    assert tables.save_predictions(forecast(spark, date(2024, 1, 1)).limit(0), path) == 1
    assert tables.read_table(spark, path, PREDICTIONS).count() == 0
    assert tables.save_predictions(forecast(spark, date(2024, 1, 1)), path) == 2


def test_retention_keeps_numbers_taken(spark, tmp_path):
    path = str(tmp_path / "p")
    tables.save_predictions(forecast(spark, date(2024, 1, 1)), path)
    assert tables.delete_old_predictions(spark, path, date(2024, 6, 30)) == 1
    assert tables.save_predictions(forecast(spark, date(2024, 6, 1)), path) == 2
    assert tables.read_table(spark, path, PREDICTIONS).count() == 1


def test_a_rename_outside_the_local_file_system_never_goes_over_a_folder(spark, tmp_path, monkeypatch):
    real = commits.folder

    class Elsewhere:
        def __init__(self, files):
            self.files = files

        def getScheme(self):  # noqa: N802
            return "elsewhere"

        def __getattr__(self, name):
            return getattr(self.files, name)

    monkeypatch.setattr(commits, "folder", lambda spark, path: (Elsewhere(real(spark, path)[0]), real(spark, path)[1]))
    one, two = (commits.Staged(spark.range(n), str(tmp_path / "t")) for n in (1, 2))
    target = str(tmp_path / "t" / "commit=1")
    assert commits.publish(spark, one.folder, target) and not commits.publish(spark, two.folder, target)
    assert spark.read.parquet(target).count() == 1 and two.read().count() == 2


def test_drift_log_by_day(spark, tmp_path):
    path = str(tmp_path / "log")
    assert tables.read_drift(spark, path).columns == DRIFT_LOG.names
    rows = spark.createDataFrame(
        [(datetime(2024, 1, d), "d", "f", float(d), False) for d in (1, 2, 2, 3)] + [(None, "d", "f", 0.0, False)],
        "timestamp timestamp_ntz, dataset_name string, feature_name string, drift_score double, drift_detected boolean")
    tables.append_drift(rows, path)
    late = tables.read_drift(spark, path, date(2024, 1, 2))
    assert sorted(r["drift_score"] for r in late.collect()) == [2.0, 2.0, 3.0]
    assert "PartitionFilters: [isnotnull(log_day" in late._jdf.queryExecution().executedPlan().toString()
    assert tables.read_drift(spark, path).count() == tables.read_table(spark, path, DRIFT_LOG).count() == 5
