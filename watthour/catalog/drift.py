from pyspark.sql import functions as F

from watthour.catalog.registry import (
    EVENTS_AS_OF, HOURLY_KEY_SQL, KEY, at, hourly_by_key, query, tidy, tidy_sql,
)
from watthour.operators.drift import drift_log_rows, drift_summary, moments, score_moments

HALF = "2024-01-16"
THRESHOLDS = (2.0, 0.1)

SCORES_SQL = f"""{HOURLY_KEY_SQL},
ref AS (SELECT event_type AS feature, avg(ac_power) AS rm, stddev_samp(ac_power) AS rs FROM hourly
  WHERE date_time < TIMESTAMP '{HALF}' GROUP BY 1),
cur AS (SELECT event_type AS feature, avg(ac_power) AS cm, stddev_samp(ac_power) AS cs FROM hourly
  WHERE date_time >= TIMESTAMP '{HALF}' GROUP BY 1),
base AS (SELECT cur.feature, cm, cs, rm, CASE WHEN rs IS NULL OR rs = 0 THEN 1e-6 ELSE rs END AS d, rs
  FROM cur JOIN ref ON ref.feature = cur.feature),
scores AS (SELECT feature, t.threshold, abs(cm - rm) / d
    + 0.5 * CASE WHEN cs > 0 THEN greatest(cs / d, d / cs) - 1 ELSE 0 END AS drift_score,
    cm AS current_mean, cs AS current_std, rm AS reference_mean, rs AS reference_std
  FROM base, (SELECT CAST(unnest([2.0, 0.1]) AS DOUBLE) AS threshold) AS t)"""


def _scores(spark, sf):
    # every event type of the table is a feature, so the frame stays long
    long = hourly_by_key(spark, sf).select("date_time", F.col(KEY).alias("feature"), F.col("ac_power").alias("value"))
    before = moments(long.where(F.col("date_time") < at(HALF)))
    after = moments(long.where(F.col("date_time") >= at(HALF)))
    reference = before.select("feature", F.col("current_mean").alias("mean"), F.col("current_std").alias("std"))
    return [score_moments(after, reference, threshold=t) for t in THRESHOLDS]


@query("drift_score", tidy_sql(
    "SELECT *, drift_score > threshold AS drift_detected FROM scores",
    ["drift_score", "current_mean", "current_std", "reference_mean", "reference_std"], ctes=f"WITH {SCORES_SQL}"))
def drift_score(spark, sf):
    parts = [s.withColumn("threshold", F.lit(t)) for t, s in zip(THRESHOLDS, _scores(spark, sf))]
    return tidy(parts[0].unionByName(parts[1]))


@query("drift_summary", tidy_sql("""SELECT threshold AS drift_threshold, bool_or(drift_score > threshold) AS overall_drift_detected,
    count(*) AS features_analyzed, count(*) FILTER (WHERE drift_score > threshold) AS drifted_features_count,
    coalesce(string_agg(feature, ', ' ORDER BY feature) FILTER (WHERE drift_score > threshold), '') AS drifted_features,
    avg(drift_score) AS average_drift_score, max(drift_score) AS max_drift_score FROM scores GROUP BY 1""",
    ["average_drift_score", "max_drift_score"], ctes=f"WITH {SCORES_SQL}"))
def summary(spark, sf):
    parts = [drift_summary(s, t) for t, s in zip(THRESHOLDS, _scores(spark, sf))]
    rows = parts[0].unionByName(parts[1])
    return tidy(rows.withColumn("drifted_features", F.concat_ws(", ", "drifted_features")))


@query("drift_log", tidy_sql(f"""SELECT TIMESTAMP '{EVENTS_AS_OF}' AS "timestamp", 'events' AS dataset_name,
    feature AS feature_name, drift_score, drift_score > threshold AS drift_detected
  FROM scores WHERE threshold < 1""", ["drift_score"], ctes=f"WITH {SCORES_SQL}"))
def log(spark, sf):
    return tidy(drift_log_rows(_scores(spark, sf)[1], "events", at(EVENTS_AS_OF)))
