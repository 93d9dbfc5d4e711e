from pyspark.sql import functions as F

from watthour.catalog.registry import (
    HOURLY_KEY_SQL, HOURLY_SQL, KEY, hourly, hourly_by_key, query, readings, tidy, tidy_sql,
)
from watthour.operators import explore as ops


@query("gen_weather_join", tidy_sql("""SELECT g.date_time, g.ac_power, w.ac_power AS irradiation FROM hourly g
  JOIN hourly w ON g.date_time = w.date_time AND g.event_type = 'purchase' AND w.event_type = 'view'""",
    ["ac_power", "irradiation"], ctes=f"WITH {HOURLY_KEY_SQL}"))
def gen_weather_join(spark, sf):
    rows = hourly_by_key(spark, sf)
    generation = rows.where(F.col(KEY) == "purchase").select("date_time", "ac_power")
    weather = rows.where(F.col(KEY) == "view").select("date_time", F.col("ac_power").alias("irradiation"))
    return tidy(ops.gen_weather_join(generation, weather))


PROFILE_SQL = """profile AS (SELECT event_type, CAST(hour(ts) AS INTEGER) AS hour, avg(value) AS mean_value
  FROM events GROUP BY 1, 2)"""


@query("hour_profile", tidy_sql("SELECT * FROM profile", ["mean_value"], ctes=f"WITH {PROFILE_SQL}"))
def hour_profile(spark, sf):
    return tidy(ops.hour_profile(readings(spark, sf), keys=[KEY]))


@query("peak_hour", tidy_sql("""SELECT event_type, min(hour) AS peak_hour, max(mean_value) AS peak_mean FROM profile p
  WHERE mean_value = (SELECT max(mean_value) FROM profile q WHERE q.event_type = p.event_type) GROUP BY 1""",
    ["peak_mean"], ctes=f"WITH {PROFILE_SQL}"))
def peak_hour(spark, sf):
    return tidy(ops.peak_hour(ops.hour_profile(readings(spark, sf), keys=[KEY]), [KEY]))


@query("daily_totals", tidy_sql(
    "SELECT event_type, CAST(ts AS DATE) AS date, sum(value) AS total_value FROM events GROUP BY 1, 2", ["total_value"]))
def daily_totals(spark, sf):
    return tidy(ops.daily_totals(readings(spark, sf), keys=[KEY]))


@query("last_week", tidy_sql(
    "SELECT * FROM hourly ORDER BY date_time DESC LIMIT 168", ["ac_power"], ctes=f"WITH {HOURLY_SQL}"))
def last_week(spark, sf):
    return tidy(ops.last_rows(hourly(spark, sf), 168))


@query("first_rows", tidy_sql(
    "SELECT * FROM hourly ORDER BY date_time LIMIT 2000", ["ac_power"], ctes=f"WITH {HOURLY_SQL}"))
def first_rows(spark, sf):
    return tidy(ops.first_rows(hourly(spark, sf), 2000))
