from datetime import datetime

import pytest

from watthour.sources.quarantine import (
    count_weather, load_report, parse_time, quarantine_summary, scan_generation, scan_weather,
)

HEADER = "DATE_TIME,PLANT_ID,SOURCE_KEY,DC_POWER,AC_POWER,DAILY_YIELD,TOTAL_YIELD"
WEATHER_HEADER = "DATE_TIME,PLANT_ID,SOURCE_KEY,AMBIENT_TEMPERATURE,MODULE_TEMPERATURE,IRRADIATION"
FORMATS = ("yyyy-MM-dd HH:mm:ss", "dd.MM.yyyy HH:mm")


def write(path, *lines, header=HEADER):
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_each_bad_row_is_put_aside_with_its_reason(spark, tmp_path):
    path = write(
        tmp_path / "g.csv",
        "2024-12-21 05:00:00,1,a,,,0.0,10",         # empty numbers are missing values
        "21.12.2024 06:15,1,a,5.0,4.5,1.0,11",      # second format
        "yesterday,1,a,5.0,4.5,1.0,11",
        ",1,a,5.0,4.5,1.0,11",
        "2024-12-21 07:00:00,1,a,5.0,many,1.0,11",
        "2024-12-21 07:00:00,one,a,5.0,4.0,1.0,11",
        "2024-12-21 07:00:00,1,a",
        "2024-12-21 08:00:00,1,a,5.0,4.0,1.0,11,12",
        "2024-02-30 08:00:00,1,a,5.0,4.0,1.0,11",   # no such day
    )
    scan = scan_generation(spark, path, FORMATS)
    assert [(r["date_time"], r["ac_power"]) for r in scan.rows.orderBy("date_time").collect()] == [
        (datetime(2024, 12, 21, 5), None), (datetime(2024, 12, 21, 6, 15), 4.5)]
    assert dict(scan.rows.dtypes)["date_time"] == "timestamp_ntz"
    bad = {(r["reason"], r["record"]) for r in scan.quarantine.collect()}
    assert bad == {
        ("date_time: no time", "yesterday,1,a,5.0,4.5,1.0,11"),
        ("date_time: missing", ",1,a,5.0,4.5,1.0,11"),
        ("ac_power: no double", "2024-12-21 07:00:00,1,a,5.0,many,1.0,11"),
        ("plant_id: no int", "2024-12-21 07:00:00,one,a,5.0,4.0,1.0,11"),
        ("malformed row", "2024-12-21 07:00:00,1,a"),
        ("malformed row", "2024-12-21 08:00:00,1,a,5.0,4.0,1.0,11,12"),
        ("date_time: no time", "2024-02-30 08:00:00,1,a,5.0,4.0,1.0,11"),
    }
    counts = {r["reason"]: r["row_count"] for r in quarantine_summary(scan).collect()}
    assert counts["malformed row"] == 2 and sum(counts.values()) == 7


def test_good_rows_do_not_depend_on_the_columns_selected(spark, tmp_path):
    path = write(tmp_path / "g.csv", "2024-12-21 07:00:00,1,a,x,4.0,1.0,11", "2024-12-21 08:00:00,1,a,1,4.0,1.0,11")
    scan = scan_generation(spark, path)
    assert scan.rows.count() == scan.rows.select("ac_power").count() == len(scan.rows.collect()) == 1
    assert scan.quarantine.count() == 1


def test_a_folder_of_files_an_empty_file_and_a_wrong_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.csv", "2024-12-21 05:00:00,1,a,1,1,1,1", "x,1,a,1,1,1,1")
    write(folder / "b.csv")
    write(folder / "c.csv", "2024-12-21 05:00:00,1,a,1,1,1,1", "2024-12-21 05:00:00,1,a,1,1,1,1", "y,1,a,1,1,1,1")
    scan = scan_generation(spark, str(folder))
    assert scan.rows.count() == 3  # repeated rows stay
    files = {r["file"].rpartition("/")[2]: r["row_count"] for r in quarantine_summary(scan).collect()}
    assert files == {"a.csv": 1, "c.csv": 1}
    swapped = write(tmp_path / "s.csv", "1,2", header=HEADER.replace("DATE_TIME,PLANT_ID", "PLANT_ID,DATE_TIME"))
    with pytest.raises(Exception):
        scan_generation(spark, swapped).rows.collect()


def test_times_in_a_daylight_saving_gap_stay_as_written(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        texts = spark.createDataFrame([("2024-03-31 02:30:00",), ("no",), (None,), ('a"b,c',)], "t string")
        got = [r[0] for r in texts.select(parse_time(texts.t).alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [datetime(2024, 3, 31, 2, 30), None, None, None]


def test_weather_that_fails_while_it_is_read_stops_nothing(spark, tmp_path):
    good = write(tmp_path / "g.csv", "2024-12-21 05:00:00,1,a,2,1,1,1", "bad,1,a,2,1,1,1")
    weather = write(tmp_path / "w.csv", "2024-12-21 05:00:00,1,w,-4.9,-3.0,0.0", "?,1,w,1,1,1", header=WEATHER_HEADER)
    assert count_weather(spark, weather) == (2, True)
    assert scan_weather(spark, weather).rows.count() == 1
    wrong = write(tmp_path / "v.csv", "1,2", header="A,B")
    broken = tmp_path / "broken.parquet"
    broken.write_bytes(b"PAR1 not a parquet file PAR1")
    assert count_weather(spark, wrong) == count_weather(spark, str(tmp_path / "none")) == (0, False)
    assert count_weather(spark, str(broken), "parquet") == count_weather(spark, None) == (0, False)
    row = load_report(spark, good, wrong).first()
    assert (row["generation_records"], row["processed_records"], row["quarantined_records"]) == (1, 1, 1)
    assert (row["weather_records"], row["weather_available"]) == (0, False)
    assert load_report(spark, good, weather).first()["weather_records"] == 2
