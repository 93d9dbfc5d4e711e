from pyspark.sql import functions as F

from watthour.catalog.registry import (
    HISTORY, HOURLY_KEY_SQL, HOURLY_SQL, KEY, LAGS, LEADS_SQL, RELATIVE, ROLLING_SQL, TARGETS, WINDOWS, calendar_sql,
    hourly, hourly_by_key, lags_sql, query, readings, table, tidy, tidy_sql, windows_sql,
)
from watthour.functions.calendar import SEASONS, TEMPORAL_COLUMNS, season_flags, season_label
from watthour.operators import hourly as ops
from watthour.operators.checks import leakage_report
from watthour.operators.features import LAG_DAYS, ROLLING_DAYS, calendar_features, lag_features, lead_targets

LAG_ONLY = [c for c in HISTORY if not c.startswith("rolling")]
ROLL_ONLY = [c for c in HISTORY if c.startswith("rolling")]


@query("hourly_mean", tidy_sql("SELECT * FROM hourly", ["ac_power"], ctes=f"WITH {HOURLY_KEY_SQL}"))
def hourly_mean(spark, sf):
    return tidy(hourly_by_key(spark, sf))


@query("lag_features", tidy_sql(
    f"SELECT event_type, date_time, {lags_sql()} FROM hourly {windows_sql('event_type')}",
    LAG_ONLY, ctes=f"WITH {HOURLY_KEY_SQL}"))
def lags(spark, sf):
    rows = lag_features(hourly_by_key(spark, sf), keys=[KEY], lag_days=LAGS, rolling_days=WINDOWS)
    return tidy(rows.select(KEY, "date_time", *LAG_ONLY))


CLOCK_SQL = """span AS (SELECT event_type, min(date_time) AS lo, max(date_time) AS hi FROM hourly GROUP BY 1),
hours AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS date_time FROM span),
clock AS (SELECT g.event_type, g.date_time, h.ac_power FROM hours g
  LEFT JOIN hourly h ON h.event_type = g.event_type AND h.date_time = g.date_time)"""


@query("lag_features_by_clock", tidy_sql(
    f"SELECT event_type, date_time, ac_power, {lags_sql()} FROM clock {windows_sql('event_type')}",
    ["ac_power", *LAG_ONLY], ctes=f"WITH {HOURLY_KEY_SQL}, {CLOCK_SQL}"))
def lags_by_clock(spark, sf):
    """Lags by the clock: hours without readings are rows too."""
    filled = ops.fill_hours(hourly_by_key(spark, sf), keys=[KEY])
    rows = lag_features(filled, keys=[KEY], lag_days=LAGS, rolling_days=WINDOWS)
    return tidy(rows.select(KEY, "date_time", "ac_power", *LAG_ONLY))


# orders reach over years: a row a day serves for the default lags and windows of up to 30 days
LONG_LAGS = [f"ac_power_lag_{d}d" for d in LAG_DAYS]
LONG_WINDOWS = [f"rolling_{s}_{d}d" for d in ROLLING_DAYS for s in ("mean", "std", "max")]
LONG_SQL = ", ".join([f"lag(ac_power, {24 * d}) OVER w AS ac_power_lag_{d}d" for d in LAG_DAYS] + [
    f"CASE WHEN count(ac_power) OVER w{d} >= {12 * d} THEN {f}(ac_power) OVER w{d} END AS rolling_{s}_{d}d"
    for d in ROLLING_DAYS for s, f in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max"))])
FRAMES_SQL = "WINDOW w AS (ORDER BY date_time), " + ", ".join(
    f"w{d} AS (ORDER BY date_time ROWS BETWEEN {24 * d + 23} PRECEDING AND 24 PRECEDING)" for d in ROLLING_DAYS)


@query("long_history", tidy_sql(f"SELECT date_time, {LONG_SQL} FROM days {FRAMES_SQL}",
    [*LONG_LAGS, *LONG_WINDOWS], dict.fromkeys(LONG_WINDOWS, RELATIVE),
    """WITH days AS (SELECT date_trunc('hour', o_orderdate) AS date_time, avg(o_totalprice) AS ac_power FROM orders GROUP BY 1)"""))
def long_history(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("date_time"), F.col("o_totalprice").alias("ac_power"))
    rows = lag_features(ops.hourly_mean(orders))
    return tidy(rows.select("date_time", *LONG_LAGS, *LONG_WINDOWS), dict.fromkeys(LONG_WINDOWS, RELATIVE))


@query("rolling_features", tidy_sql(
    f"SELECT event_type, date_time, {ROLLING_SQL} FROM hourly {windows_sql('event_type')}",
    ROLL_ONLY, ctes=f"WITH {HOURLY_KEY_SQL}"))
def rolling(spark, sf):
    rows = lag_features(hourly_by_key(spark, sf), keys=[KEY], lag_days=LAGS, rolling_days=WINDOWS)
    return tidy(rows.select(KEY, "date_time", *ROLL_ONLY))


@query("lead_targets", tidy_sql(
    f"SELECT event_type, date_time, {LEADS_SQL} FROM hourly {windows_sql('event_type')}",
    TARGETS, ctes=f"WITH {HOURLY_KEY_SQL}"))
def leads(spark, sf):
    return tidy(lead_targets(hourly_by_key(spark, sf), keys=[KEY]).drop("ac_power"))


STEPS_SQL = f"""WITH {HOURLY_KEY_SQL},
steps AS (SELECT event_type, date_time, ac_power,
    row_number() OVER (PARTITION BY event_type ORDER BY date_time) - 1 AS position,
    epoch_us(date_time) / 1e6 - epoch_us(lag(date_time) OVER (PARTITION BY event_type ORDER BY date_time)) / 1e6 AS step
  FROM hourly),
tally AS (SELECT event_type, step, count(*) AS n FROM steps WHERE step IS NOT NULL GROUP BY 1, 2),
modal AS (SELECT event_type, min(step) AS modal FROM tally t
  WHERE n = (SELECT max(n) FROM tally u WHERE u.event_type = t.event_type) GROUP BY 1)"""


@query("gap_report", f"""{STEPS_SQL},
located AS (SELECT event_type, string_agg(position, ',' ORDER BY position) AS gap_locations FROM (
    SELECT event_type, position, row_number() OVER (PARTITION BY event_type ORDER BY position) AS k
    FROM steps WHERE step > 3600) AS g WHERE k <= 10 GROUP BY 1)
SELECT s.event_type, count(*) FILTER (WHERE step > 3600) AS total_gaps,
  coalesce(max(step) FILTER (WHERE step > 3600) / 3600, 0.0) AS max_gap_hours,
  coalesce(any_value(l.gap_locations), '') AS gap_locations
FROM steps s LEFT JOIN located l ON s.event_type = l.event_type GROUP BY 1""")
def gaps(spark, sf):
    report = ops.gap_report(hourly_by_key(spark, sf), keys=[KEY])
    return report.withColumn("gap_locations", F.concat_ws(",", F.col("gap_locations").cast("array<string>")))


@query("frequency_check", f"""{STEPS_SQL}
SELECT s.event_type, count(*) AS records, any_value(m.modal) AS modal_step_seconds,
  coalesce(abs(any_value(m.modal) - 3600) < 60, true) AS frequency_consistent
FROM steps s LEFT JOIN modal m ON s.event_type = m.event_type GROUP BY 1""")
def frequency(spark, sf):
    return ops.frequency_check(hourly_by_key(spark, sf), keys=[KEY])


ORDER_SQL = """SELECT event_type, count(*) AS records,
    CAST(coalesce(sum(CASE WHEN back THEN 1 ELSE 0 END), 0) AS BIGINT) AS steps_back
  FROM (SELECT event_type, lag(ts) OVER (PARTITION BY event_type ORDER BY event_id) > ts AS back FROM events) AS e
  GROUP BY 1"""


@query("order_check", f"SELECT *, steps_back = 0 AS is_sorted FROM ({ORDER_SQL}) AS o")
def order(spark, sf):
    return ops.order_check(readings(spark, sf), "date_time", "event_id", keys=[KEY])


@query("load_summary", f"""WITH {HOURLY_KEY_SQL}
SELECT h.event_type, any_value(g.n) AS generation_records, count(*) AS processed_records,
  min(h.date_time) AS "start", max(h.date_time) AS "end",
  CAST(floor((epoch_us(max(h.date_time)) - epoch_us(min(h.date_time))) / 86400e6) AS BIGINT) AS total_days,
  count(*) AS weather_records, true AS weather_available
FROM hourly h JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY 1) AS g ON g.event_type = h.event_type
GROUP BY 1""")
def summary(spark, sf):
    rows = readings(spark, sf)
    means = hourly_by_key(spark, sf)
    return ops.load_summary(rows, means, weather=means, keys=[KEY])


@query("leakage_report", f"""{STEPS_SQL}
SELECT s.event_type, count(*) AS total_records,
  count(*) FILTER (WHERE ac_power IS NULL) AS missing_values,
  count(*) FILTER (WHERE ac_power < 0) AS negative_values,
  count(*) - count(DISTINCT date_time) AS duplicate_timestamps,
  count(*) FILTER (WHERE step > 3600) AS total_gaps,
  coalesce(max(step) FILTER (WHERE step > 3600) / 3600, 0.0) AS max_gap_hours,
  min(date_time) AS "start", max(date_time) AS "end",
  any_value(o.steps_back) = 0 AS is_sorted,
  CAST(floor((epoch_us(max(date_time)) - epoch_us(min(date_time))) / 86400e6) AS BIGINT) AS total_days,
  coalesce(abs(any_value(m.modal) - 3600) < 60, true) AS frequency_consistent,
  count(*) >= 168 AS sufficient_history, count(*) >= 24 AS min_lag_availability,
  '' AS forbidden_columns, true AS only_allowed_features,
  count(*) FILTER (WHERE ac_power IS NULL) = 0 AND any_value(o.steps_back) = 0 AND count(*) >= 168 AS overall_valid
FROM steps s LEFT JOIN modal m ON s.event_type = m.event_type
JOIN ({ORDER_SQL}) AS o ON o.event_type = s.event_type GROUP BY 1""")
def leakage(spark, sf):
    order = ops.order_check(readings(spark, sf), "date_time", "event_id", keys=[KEY])
    return leakage_report(hourly_by_key(spark, sf), keys=[KEY], lag_days=LAGS, order=order)


MOMENTS_SQL = f"""WITH {HOURLY_SQL}, moments AS (
  SELECT date_time FROM hourly UNION SELECT o_orderdate AS date_time FROM orders)"""


def moments(spark, sf):
    dates = table(spark, sf, "orders").select(F.col("o_orderdate").alias("date_time"))
    return hourly(spark, sf).select("date_time").union(dates).distinct()


@query("calendar_features", tidy_sql(
    f"SELECT date_time, {calendar_sql()} FROM moments", list(TEMPORAL_COLUMNS[8:]), ctes=MOMENTS_SQL))
def calendar(spark, sf):
    return tidy(calendar_features(moments(spark, sf)))


@query("season_onehot", """WITH d AS (SELECT DISTINCT o_orderdate AS date_time FROM orders),
s AS (SELECT date_time, CASE WHEN month(date_time) IN (12, 1, 2) THEN 'winter'
    WHEN month(date_time) IN (3, 4, 5) THEN 'spring' WHEN month(date_time) IN (6, 7, 8) THEN 'summer'
    ELSE 'autumn' END AS season FROM d)
SELECT *, """ + ", ".join(f"season = '{s}' AS season_{s}" for s in SEASONS) + " FROM s")
def season(spark, sf):
    dates = table(spark, sf, "orders").select(F.col("o_orderdate").alias("date_time")).distinct()
    return dates.withColumns({"season": season_label(F.col("date_time")), **season_flags(F.col("date_time"))})


@query("forecast_calendar", """WITH last_day AS (
  SELECT event_type, date_trunc('day', max(ts)) + INTERVAL 1 DAY AS "start" FROM events GROUP BY 1)
SELECT event_type, "start", unnest(generate_series("start", "start" + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS date_time
FROM last_day""")
def forecast_calendar(spark, sf):
    next_day = F.date_add(F.to_date(F.max("date_time")), 1).cast("timestamp_ntz")
    starts = readings(spark, sf).groupBy(KEY).agg(next_day.alias("start"))
    return ops.hourly_calendar(starts, "start", 24)
