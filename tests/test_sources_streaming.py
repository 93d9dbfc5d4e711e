import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from watthour.operators.hourly import hourly_mean
from watthour.sources.readings import read_generation, read_weather
from watthour.streaming.hourly import drift_stream, hourly_mean_stream

HEADER = "DATE_TIME,PLANT_ID,SOURCE_KEY,DC_POWER,AC_POWER,DAILY_YIELD,TOTAL_YIELD"


def csv(tmp_path, *lines, header=HEADER, name="g.csv"):
    path = tmp_path / name
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_generation_csv(spark, tmp_path):
    path = csv(tmp_path, "2024-12-21 05:00:00,1,a,,,0.0,10", "2024-12-21 06:15:00,1,a,5.0,4.5,1.0,11",
               "2024-12-21 06:45:00,1,b,7.0,5.5,1.0,11.5")
    df = read_generation(spark, path)
    assert dict(df.dtypes)["date_time"] == "timestamp_ntz"
    got = hourly_mean(df).collect()
    assert [tuple(r) for r in got] == [(datetime(2024, 12, 21, 6), 5.0)]
    # a scan for the mean reads two columns only
    plan = hourly_mean(df)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<date_time:string,ac_power:double>" in plan


def test_wrong_header_and_bad_time_are_errors(spark, tmp_path):
    swapped = csv(tmp_path, "1,2024-12-21 05:00:00,a,1,1,1,1", header=HEADER.replace("DATE_TIME,PLANT_ID", "PLANT_ID,DATE_TIME"))
    with pytest.raises(Exception):
        read_generation(spark, swapped).collect()
    bad = csv(tmp_path, "21.12.2024,1,a,1,1,1,1", name="b.csv")
    with pytest.raises(Exception):
        read_generation(spark, bad).collect()


def test_parquet_source(spark, tmp_path):
    path = str(tmp_path / "g.parquet")
    csv_df = read_generation(spark, csv(tmp_path, "2024-12-21 05:00:00,1,a,1,2,3,4"))
    csv_df.write.parquet(path)
    assert read_generation(spark, path, "parquet").collect() == csv_df.collect()


def test_missing_weather_is_tolerated(spark, tmp_path):
    assert read_weather(spark, str(tmp_path / "none.csv")) is None
    assert read_weather(spark, None) is None
    path = csv(tmp_path, "2024-12-21 05:00:00,1,w,-4.9,-3.0,0.0", name="w.csv",
               header="DATE_TIME,PLANT_ID,SOURCE_KEY,AMBIENT_TEMPERATURE,MODULE_TEMPERATURE,IRRADIATION")
    assert read_weather(spark, path).first()["ambient_temperature"] == -4.9


def test_stream_of_readings_gives_the_batch_means(spark, tmp_path):
    schema = "plant string, date_time timestamp_ntz, ac_power double"
    rows = [("a", datetime(2024, 1, 1, h, m), float(h + m)) for h in range(6) for m in (0, 30)]
    folder = str(tmp_path / "in")
    for part in (rows[:6], rows[6:], [("a", datetime(2024, 1, 2), 1.0)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    means = hourly_mean_stream(stream, "1 hour", keys=["plant"])
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    run = means.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
    run.awaitTermination(120)
    got = {tuple(r) for r in spark.read.parquet(out).collect()}
    batch = hourly_mean(spark.read.parquet(folder), keys=["plant"]).where(F.col("date_time") < "2024-01-02")
    assert got == {tuple(r) for r in batch.collect()}


def test_drift_of_each_micro_batch(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "log")
    spark.createDataFrame([(9.0,), (10.0,), (11.0,)], "x double").coalesce(1).write.parquet(folder)
    reference = spark.createDataFrame([("x", 1.0, 1.0)], "feature string, mean double, std double")
    stream = spark.readStream.schema("x double").parquet(folder)
    run = drift_stream(stream, reference, out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    row = spark.read.parquet(out).first()
    assert (row["feature_name"], row["drift_detected"], row["drift_score"]) == ("x", True, 9.0)


def test_intermediate_tables_go_to_the_named_folder_or_nowhere(spark, tmp_path):
    from types import SimpleNamespace

    from watthour.session import drop_written, shared_folder, written

    def session(master, named):
        conf = {} if named is None else {"spark.checkpoint.dir": named}
        return SimpleNamespace(conf=SimpleNamespace(get=conf.get, set=conf.__setitem__), sparkContext=SimpleNamespace(master=master))

    assert shared_folder(session("yarn", "hdfs:/shared/")) == "hdfs:/shared"
    with pytest.raises(RuntimeError):
        shared_folder(session("yarn", None))
    local = session("local[2]", None)
    assert shared_folder(local) == shared_folder(local)
    df = written(spark.range(10), "few")
    folder = df.inputFiles()[0].rpartition("/")[0].removeprefix("file://")
    assert df.count() == 10 and os.path.isdir(folder)
    drop_written(df)
    assert not os.path.exists(folder)
    spark.range(3).write.parquet(str(tmp_path / "mine"))
    drop_written(spark.read.parquet(str(tmp_path / "mine")))  # not one of ours: stays
    assert (tmp_path / "mine").exists()
