from pyspark.sql import functions as F

from watthour.catalog.registry import (
    HISTORY, HOURLY_KEY_SQL, KEY, LAGS, ROLLING_SQL, SEASON_FLAGS, WINDOWS, calendar_sql,
    hourly_by_key, lags_sql, midnights, query, tidy, tidy_sql, windows_sql,
)
from watthour.functions.calendar import TEMPORAL_COLUMNS
from watthour.operators import forecast as ops

IDS = [KEY, "prediction_date"]
MIDNIGHTS_SQL = """midnights AS (SELECT unnest(generate_series(
    date_trunc('day', min(ts)) + INTERVAL 1 DAY, date_trunc('day', max(ts)), INTERVAL 1 DAY)) AS midnight FROM events)"""
ANCHORS_SQL = """anchors AS (SELECT event_type, midnight, max(date_time) AS anchor_ts
  FROM hourly JOIN midnights ON date_time < midnight GROUP BY 1, 2)"""


@query("midnight_features", tidy_sql(f"""SELECT a.event_type, CAST(a.midnight AS DATE) AS prediction_date, a.anchor_ts,
    {', '.join(f'f.{c}' for c in HISTORY)}, {calendar_sql("(a.midnight + INTERVAL 12 HOUR)")}
  FROM anchors a JOIN feats f ON f.event_type = a.event_type AND f.date_time = a.anchor_ts""",
    [*HISTORY, *TEMPORAL_COLUMNS[8:]], ctes=f"""WITH {HOURLY_KEY_SQL}, {MIDNIGHTS_SQL}, {ANCHORS_SQL},
  feats AS (SELECT event_type, date_time, {lags_sql()}, {ROLLING_SQL} FROM hourly {windows_sql('event_type')})"""))
def midnight_features(spark, sf):
    return tidy(ops.midnight_features(
        hourly_by_key(spark, sf), *midnights(spark, sf), keys=[KEY], lag_days=LAGS, rolling_days=WINDOWS))


STEPS_SQL = f"""WITH {HOURLY_KEY_SQL}, {MIDNIGHTS_SQL}, {ANCHORS_SQL},
numbered AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY date_time) AS n FROM hourly),
steps AS (SELECT a.event_type, CAST(a.midnight AS DATE) AS prediction_date, a.anchor_ts,
    CAST(h.horizon AS INTEGER) AS horizon, a.anchor_ts + to_hours(h.horizon) AS target_ts, p.ac_power AS y_hat
  FROM anchors a JOIN numbered k ON k.event_type = a.event_type AND k.date_time = a.anchor_ts
  CROSS JOIN (SELECT unnest(range(1, 25)) AS horizon) AS h
  LEFT JOIN numbered p ON p.event_type = a.event_type AND p.n = k.n - 24 + h.horizon),
pairs AS (SELECT s.*, f.ac_power AS y, count(*) OVER (PARTITION BY s.event_type, s.prediction_date) AS known
  FROM steps s JOIN hourly f ON f.event_type = s.event_type AND f.date_time = s.target_ts)"""


def _steps(spark, sf):
    rows = hourly_by_key(spark, sf)
    return rows, ops.forecast_steps(ops.naive_forecast(rows, *midnights(spark, sf), keys=[KEY]), IDS)


@query("naive_forecast", tidy_sql("SELECT * FROM steps", ["y_hat"], ctes=STEPS_SQL))
def naive_forecast(spark, sf):
    return tidy(_steps(spark, sf)[1])


def _pairs(spark, sf):
    rows, steps = _steps(spark, sf)
    return ops.forecast_vs_actual(steps, rows, IDS, [KEY])


@query("forecast_vs_actual", tidy_sql(
    "SELECT * EXCLUDE (known) FROM pairs WHERE known = 24", ["y", "y_hat"], ctes=STEPS_SQL))
def forecast_vs_actual(spark, sf):
    return tidy(_pairs(spark, sf))


@query("daylight_slice", tidy_sql(
    "SELECT * EXCLUDE (known) FROM pairs WHERE known = 24 AND hour(target_ts) BETWEEN 6 AND 18",
    ["y", "y_hat"], ctes=STEPS_SQL))
def daylight_slice(spark, sf):
    return tidy(ops.daylight_slice(_pairs(spark, sf), "target_ts"))


@query("forecast_day_accuracy", tidy_sql("""SELECT event_type, prediction_date, sqrt(avg((y - y_hat) * (y - y_hat))) AS rmse,
    avg(abs(y - y_hat)) AS mae, max(y) AS actual_peak, sum(y) AS actual_energy
  FROM pairs WHERE known = 24 GROUP BY 1, 2""", ["rmse", "mae", "actual_peak", "actual_energy"], ctes=STEPS_SQL))
def forecast_day_accuracy(spark, sf):
    return tidy(ops.forecast_day_accuracy(_pairs(spark, sf), IDS))


ARRAYS_SQL = f"""WITH {HOURLY_KEY_SQL}, arrays AS (SELECT event_type, CAST(date_time AS DATE) AS prediction_date,
    list(ac_power ORDER BY date_time) AS a FROM hourly GROUP BY 1, 2)"""


@query("forecast_day_metrics", tidy_sql("""SELECT event_type, prediction_date, list_max(a) AS peak_power,
    CAST(list_position(a, list_max(a)) AS INTEGER) AS peak_hour, list_sum(a) AS total_energy,
    coalesce(list_sum(a[7:19]), 0.0) AS daylight_energy,
    coalesce(list_sum(a[1:6]), 0.0) + coalesce(list_sum(a[20:24]), 0.0) AS night_energy FROM arrays""",
    ["peak_power", "total_energy", "daylight_energy", "night_energy"], ctes=ARRAYS_SQL))
def forecast_day_metrics(spark, sf):
    arrays = ops.hourly_arrays(hourly_by_key(spark, sf), keys=[KEY])
    return tidy(ops.forecast_day_metrics(arrays).drop("forecast_24h"))


@query("forecast_validate", tidy_sql("""SELECT event_type, prediction_date, CAST(len(a) AS INTEGER) AS forecast_length,
    CAST(len(list_filter(a, lambda x: x < 0)) AS INTEGER) AS negative_predictions, list_max(a) AS max_power,
    list_max(a) > 1000 AS high_power, len(a) = 24 AS validation_passed,
    CASE WHEN len(a) <> 24 THEN 'Invalid forecast length: ' || len(a) || ', expected 24' END AS error
  FROM arrays""", ["max_power"], ctes=ARRAYS_SQL))
def forecast_validate(spark, sf):
    arrays = ops.hourly_arrays(hourly_by_key(spark, sf), keys=[KEY])
    return tidy(ops.forecast_validate(arrays).drop("forecast_24h"))
