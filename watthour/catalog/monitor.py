from pyspark.sql import functions as F

from watthour.catalog.registry import (
    EVENTS_AS_OF, ORDERS_AS_OF, at, drift_log, predictions, query, table, tidy, tidy_sql,
)
from watthour.operators import monitor as ops
from watthour.operators.store import recent_predictions

LOG_SQL = """log AS (SELECT ts AS "timestamp", event_type AS feature_name, value / 50 AS drift_score,
  value > 100 AS drift_detected FROM events)"""
PREDICTIONS_SQL = """predictions AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS prediction_date,
  o_orderpriority AS model_name, o_totalprice AS peak_power, o_totalprice / 4 AS total_energy,
  o_orderdate AS created_at FROM orders)"""


def since_sql(column: str, as_of: str, days: int) -> str:
    return f"{column} >= TIMESTAMP '{as_of}' - INTERVAL {days} DAY"


WEEK_SQL = since_sql('"timestamp"', EVENTS_AS_OF, 7)
DRIFTED = "count(*) FILTER (WHERE drift_detected)"


def daily_sql(days: int, digits: int) -> str:
    return f"""SELECT CAST("timestamp" AS DATE) AS drift_date, count(*) AS total_features,
    {DRIFTED} AS drifted_features, round({DRIFTED} * 100.0 / count(*), {digits}) AS drift_rate
  FROM log WHERE {since_sql('"timestamp"', EVENTS_AS_OF, days)} GROUP BY 1"""


@query("drift_daily", f"WITH {LOG_SQL} {daily_sql(7, 1)}")
def drift_daily(spark, sf):
    return ops.drift_daily(drift_log(spark, sf), at(EVENTS_AS_OF)).orderBy(F.desc("drift_date"))


@query("panel_daily_drift", f"""WITH {LOG_SQL}
SELECT CAST(drift_date AS TIMESTAMP) AS time, * EXCLUDE (drift_date) FROM ({daily_sql(30, 2)}) AS d""")
def panel_daily_drift(spark, sf):
    return ops.panel_daily_drift(drift_log(spark, sf), at(EVENTS_AS_OF)).orderBy("time")


# the second lookback lies after the data: zero rules
RATES = ((EVENTS_AS_OF, 7), (EVENTS_AS_OF, 30), ("2025-01-01", 7))


def rate_sql(as_of: str, days: int) -> str:
    return f"""SELECT CAST({days} AS INTEGER) AS analysis_period_days, {DRIFTED} AS total_drift_events,
    count(*) AS total_feature_checks,
    CASE WHEN count(*) = 0 THEN 0.0 ELSE round({DRIFTED} * 100.0 / count(*), 2) END AS overall_drift_rate
  FROM log WHERE {since_sql('"timestamp"', as_of, days)}"""


@query("drift_rate", f"WITH {LOG_SQL} " + " UNION ALL ".join(
    f"SELECT TIMESTAMP '{a}' AS as_of, * FROM ({rate_sql(a, d)}) AS r" for a, d in RATES))
def drift_rate(spark, sf):
    log = drift_log(spark, sf)
    parts = [ops.drift_rate(log, at(a), d).withColumn("as_of", at(a)) for a, d in RATES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def top_sql(n: int) -> str:
    return f"""SELECT feature_name, count(*) AS drift_count, round(avg(drift_score), 3) AS avg_drift_score
  FROM log WHERE {WEEK_SQL} AND drift_detected GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {n}"""


@query("drift_top", f"WITH {LOG_SQL} {top_sql(5)}")
def drift_top(spark, sf):
    return ops.drift_top(drift_log(spark, sf), at(EVENTS_AS_OF))


@query("drift_top10", f"WITH {LOG_SQL} {top_sql(10)}")
def drift_top10(spark, sf):
    return ops.drift_top(drift_log(spark, sf), at(EVENTS_AS_OF), n=10)


LOOKBACKS = ((ORDERS_AS_OF, 30), (ORDERS_AS_OF, 365), ("2010-01-01", 30))


@query("prediction_stats", tidy_sql(" UNION ALL ".join(f"""SELECT TIMESTAMP '{a}' AS as_of, CAST({d} AS INTEGER) AS days,
    count(*) AS total_predictions, count(DISTINCT prediction_date) AS unique_dates,
    count(DISTINCT model_name) AS unique_models, avg(peak_power) AS avg_peak_power,
    avg(total_energy) AS avg_total_energy, min(peak_power) AS min_peak_power, max(peak_power) AS max_peak_power,
    min(prediction_date) AS earliest_date, max(prediction_date) AS latest_date
  FROM predictions WHERE {since_sql('prediction_date', a, d)}""" for a, d in LOOKBACKS),
    ["avg_peak_power", "avg_total_energy", "min_peak_power", "max_peak_power"],
    {"avg_peak_power": 4, "avg_total_energy": 4}, f"WITH {PREDICTIONS_SQL}"))
def prediction_stats(spark, sf):
    rows = predictions(spark, sf)
    parts = [ops.prediction_stats(rows, at(a), d).withColumns({"as_of": at(a), "days": F.lit(d)}) for a, d in LOOKBACKS]
    return tidy(parts[0].unionByName(parts[1]).unionByName(parts[2]), {"avg_peak_power": 4, "avg_total_energy": 4})


@query("recent_predictions", tidy_sql(
    f"SELECT * FROM predictions WHERE {since_sql('prediction_date', ORDERS_AS_OF, 30)}",
    ["peak_power", "total_energy"], ctes=f"WITH {PREDICTIONS_SQL}"))
def recent(spark, sf):
    return tidy(recent_predictions(predictions(spark, sf), at(ORDERS_AS_OF), 30, tie=["o_orderkey"]))


@query("panel_prediction_trend", tidy_sql(f"""SELECT date_trunc('day', created_at) AS time,
    avg(peak_power) AS avg_peak_power, avg(total_energy) AS avg_total_energy
  FROM predictions WHERE {since_sql('created_at', ORDERS_AS_OF, 30)} GROUP BY 1""",
    ["avg_peak_power", "avg_total_energy"], {"avg_peak_power": 4, "avg_total_energy": 4}, f"WITH {PREDICTIONS_SQL}"))
def panel_prediction_trend(spark, sf):
    rows = ops.panel_prediction_trend(predictions(spark, sf), at(ORDERS_AS_OF))
    return tidy(rows, {"avg_peak_power": 4, "avg_total_energy": 4}).orderBy("time")


@query("panel_stats", f"""WITH {LOG_SQL}, {PREDICTIONS_SQL}
SELECT 'total_predictions_24h' AS metric, CAST(count(*) AS DOUBLE) AS value FROM predictions
  WHERE {since_sql('created_at', ORDERS_AS_OF, 1)}
UNION ALL SELECT 'current_drift_rate', round({DRIFTED} * 100.0 / count(*), 2) FROM log WHERE {WEEK_SQL}
UNION ALL SELECT 'reference_models', count(*) FROM customer
UNION ALL SELECT 'total_drift_events', {DRIFTED} FROM log""")
def panel_stats(spark, sf):
    return ops.panel_stats(predictions(spark, sf), drift_log(spark, sf), table(spark, sf, "customer"),
                           at(ORDERS_AS_OF), at(EVENTS_AS_OF))


HEALTH_SQL = f"""health AS (SELECT (SELECT count(*) FROM customer) AS reference_data_records,
  (SELECT count(*) FROM part) AS performance_records, (SELECT count(*) FROM log) AS drift_records,
  (SELECT count(*) FROM predictions WHERE {since_sql('created_at', ORDERS_AS_OF, 1)}) AS recent_predictions_24h)"""


def _health(spark, sf):
    return ops.monitor_health(table(spark, sf, "customer"), table(spark, sf, "part"), drift_log(spark, sf),
                              predictions(spark, sf), at(ORDERS_AS_OF))


@query("monitor_health", f"""WITH {LOG_SQL}, {PREDICTIONS_SQL}, {HEALTH_SQL}
SELECT *, reference_data_records > 0 AS reference_data_available,
  reference_data_records > 0 AND recent_predictions_24h > 0 AS overall_healthy FROM health""")
def monitor_health(spark, sf):
    return _health(spark, sf)


ADVICE_SQL = """concat_ws('; ', CASE WHEN overall_drift_rate > 20 THEN 'high_drift_consider_retraining' END,
  CASE WHEN recent_predictions_24h = 0 THEN 'no_recent_predictions_check_daily_run' END,
  CASE WHEN reference_data_records = 0 THEN 'no_reference_run_training' END,
  CASE WHEN overall_drift_rate < 10 AND reference_data_records > 0 AND recent_predictions_24h > 0
    THEN 'operating_normally' END)"""


@query("monitor_report", f"""WITH {LOG_SQL}, {PREDICTIONS_SQL}, {HEALTH_SQL},
rate AS ({rate_sql(EVENTS_AS_OF, 7)}),
top AS ({top_sql(3)}),
joined AS (SELECT analysis_period_days, overall_drift_rate, total_drift_events,
    reference_data_records > 0 AND recent_predictions_24h > 0 AS overall_healthy,
    reference_data_records, recent_predictions_24h,
    (SELECT string_agg(feature_name || ': ' || drift_count || ' events', '; ' ORDER BY drift_count DESC, feature_name)
      FROM top) AS top_drifted_features, {ADVICE_SQL} AS recommendations FROM rate, health)
SELECT *, CASE WHEN recommendations = '' THEN 0 ELSE CAST(len(string_split(recommendations, '; ')) AS INTEGER) END
  AS recommendations_count FROM joined""")
def monitor_report(spark, sf):
    log = drift_log(spark, sf)
    return ops.monitor_report(ops.drift_rate(log, at(EVENTS_AS_OF)), _health(spark, sf),
                              ops.drift_top(log, at(EVENTS_AS_OF)))
