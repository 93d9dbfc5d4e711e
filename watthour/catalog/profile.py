from pyspark.sql import functions as F

from watthour.catalog.registry import (
    DATASET_SQL, HOURLY_KEY_SQL, LABELLED_SQL, NUMERIC, RELATIVE, TARGETS, dataset, hourly_by_key, labelled, query,
    table, tidy, tidy_sql,
)
from watthour.operators import profile as ops
from watthour.operators.correlation import (
    correlation_matrix, correlation_pairs, correlation_summary, correlation_with, high_pairs,
)
from watthour.operators.explore import gen_weather_join

# what is profiled: every numeric and text column of lineitem, and facts of documents with
# their labels, where NULLs are
NUMBERS = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
           "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double"}
TEXTS = ["l_returnflag", "l_linestatus"]
LABEL_NUMBERS = {"doc_id": "bigint", "n_chars": "bigint", "quality": "int", "toxic": "int"}
LABEL_TEXTS = ["lang", "source"]
DIGITS = {"variance": RELATIVE, "std": RELATIVE, "mean": RELATIVE, "skewness": 5, "kurtosis": 5}


def rows_sql(**columns) -> str:
    """(feature, value) rows of the columns of each source."""
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {kind.format(c=c)} AS value FROM {source}"
                              for source, (names, kind) in columns.items() for c in names)


LONG_SQL = f"{LABELLED_SQL}, long AS (" + rows_sql(
    lineitem=(NUMBERS, "CAST({c} AS DOUBLE)"), labelled=(LABEL_NUMBERS, "CAST({c} AS DOUBLE)")) + ")"
TEXT_SQL = "texts AS (" + rows_sql(lineitem=(TEXTS, "{c}"), labelled=(LABEL_TEXTS, "{c}")) + ")"
DTYPE_SQL = "CASE l.feature " + " ".join(
    f"WHEN '{c}' THEN '{kind}'" for c, kind in {**NUMBERS, **LABEL_NUMBERS}.items()) + " END"
QUARTILES_SQL = """quartiles AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
    quantile_cont(value, 0.75) AS q3 FROM long GROUP BY 1)"""


def lineitem(spark, sf):
    return table(spark, sf, "lineitem")


def each(spark, sf, operator, names=(NUMBERS, LABEL_NUMBERS)):
    """The operator over the columns of both tables."""
    one, two = operator(lineitem(spark, sf), list(names[0])), operator(labelled(spark, sf), list(names[1]))
    return one.unionByName(two)


@query("describe", tidy_sql("""SELECT feature, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std,
    min(value) AS min, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50,
    quantile_cont(value, 0.75) AS p75, max(value) AS max FROM long GROUP BY 1""",
    ["mean", "std", "min", "p25", "p50", "p75", "max"], DIGITS, f"WITH {LONG_SQL}"))
def describe(spark, sf):
    return tidy(each(spark, sf, ops.describe), DIGITS)


COLUMNS = {"lineitem": [*NUMBERS, *TEXTS, "l_shipdate"], "labelled": [*LABEL_NUMBERS, *LABEL_TEXTS]}


@query("null_counts", f"WITH {LABELLED_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS row_count FROM {source}"
    for source, columns in COLUMNS.items() for c in columns))
def null_counts(spark, sf):
    return each(spark, sf, ops.null_counts, tuple(COLUMNS.values()))


def commonest_sql(source: str) -> str:
    return f"""modes AS (SELECT feature, min(value) AS mode FROM (
      SELECT feature, value, count(*) AS n, max(count(*)) OVER (PARTITION BY feature) AS top
      FROM {source} WHERE value IS NOT NULL GROUP BY 1, 2) AS c WHERE n = top GROUP BY 1)"""


PROFILE_SQL = f"""{LONG_SQL}, {QUARTILES_SQL}, {commonest_sql('long')},
profile AS (SELECT l.feature, {DTYPE_SQL} AS dtype, count(value) AS count,
    count(*) - count(value) AS missing_count, 100.0 * (count(*) - count(value)) / count(*) AS missing_percentage,
    count(DISTINCT value) AS unique_values, count(DISTINCT value) <= 1 AS is_constant, any_value(m.mode) AS mode,
    avg(value) AS mean, any_value(q.median) AS median, stddev_samp(value) AS std, var_samp(value) AS variance,
    min(value) AS min, max(value) AS max, max(value) - min(value) AS range, any_value(q.q1) AS q1,
    any_value(q.q3) AS q3, any_value(q.q3 - q.q1) AS iqr, coalesce(skewness(value), 0) AS skewness,
    coalesce(kurtosis(value), 0) AS kurtosis,
    count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outlier_count,
    100.0 * count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) / count(value)
      AS outlier_percentage
  FROM long l JOIN quartiles q ON q.feature = l.feature JOIN modes m ON m.feature = l.feature GROUP BY 1)"""
PROFILE_DOUBLES = ["missing_percentage", "mode", *ops.NUMERIC_FIELDS, "outlier_percentage"]


@query("feature_profile", tidy_sql("SELECT * FROM profile", PROFILE_DOUBLES, DIGITS, f"WITH {PROFILE_SQL}"))
def feature_profile(spark, sf):
    return tidy(each(spark, sf, ops.profile_numeric), DIGITS)


@query("profile_strings", f"""WITH {LABELLED_SQL}, {TEXT_SQL}, {commonest_sql('texts')}
SELECT t.feature, 'string' AS dtype, count(value) AS count, count(*) - count(value) AS missing_count,
  100.0 * (count(*) - count(value)) / count(*) AS missing_percentage, count(DISTINCT value) AS unique_values,
  count(DISTINCT value) <= 1 AS is_constant, any_value(m.mode) AS mode,
  {', '.join(f'CAST(NULL AS DOUBLE) AS {c}' for c in ops.NUMERIC_FIELDS)},
  CAST(0 AS BIGINT) AS outlier_count, CAST(0.0 AS DOUBLE) AS outlier_percentage
FROM texts t JOIN modes m ON m.feature = t.feature GROUP BY 1""")
def profile_strings(spark, sf):
    return tidy(each(spark, sf, ops.profile_strings, (TEXTS, LABEL_TEXTS)))


@query("iqr_outliers", tidy_sql("""SELECT l.feature, any_value(q1 - 1.5 * (q3 - q1)) AS lower_bound,
    any_value(q3 + 1.5 * (q3 - q1)) AS upper_bound, count(value) AS count,
    count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outlier_count,
    100.0 * count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) / count(value)
      AS outlier_percentage
  FROM long l JOIN quartiles q ON q.feature = l.feature GROUP BY 1""",
    ["lower_bound", "upper_bound", "outlier_percentage"],
    ctes=f"""WITH {LONG_SQL.replace("long AS (", "long AS (SELECT 'value' AS feature, value FROM events UNION ALL ")}, {QUARTILES_SQL}"""))
def iqr_outliers(spark, sf):
    events = ops.iqr_outliers(table(spark, sf, "events"), ["value"])
    return tidy(events.unionByName(each(spark, sf, ops.iqr_outliers)))


@query("quality_summary", tidy_sql("""SELECT count(*) AS feature_count,
    count(*) FILTER (WHERE missing_count > 0) AS features_with_missing,
    count(*) FILTER (WHERE is_constant) AS features_constant,
    count(*) FILTER (WHERE outlier_percentage > 5) AS features_with_outliers,
    avg(missing_percentage) AS average_missing_percentage
  FROM (SELECT missing_count, is_constant, outlier_percentage, missing_percentage FROM profile
    UNION ALL SELECT count(*) - count(value), count(DISTINCT value) <= 1, 0.0,
      100.0 * (count(*) - count(value)) / count(*) FROM texts GROUP BY feature) AS p""",
    ["average_missing_percentage"], ctes=f"WITH {PROFILE_SQL}, {TEXT_SQL}"))
def quality_summary(spark, sf):
    profiles = ops.feature_profile(lineitem(spark, sf)).unionByName(ops.feature_profile(labelled(spark, sf)))
    return tidy(ops.quality_summary(profiles))


@query("drift_reference", tidy_sql(
    "SELECT feature, mean, std, min, max, q1, q3, median FROM profile WHERE mean IS NOT NULL",
    list(ops.DRIFT_FIELDS), DIGITS, f"WITH {PROFILE_SQL}"))
def drift_reference(spark, sf):
    return tidy(each(spark, sf, ops.drift_statistics), DIGITS)


TARGET_SQL = f"WITH {DATASET_SQL}, long AS (" + " UNION ALL ".join(
    f"SELECT CAST({h} AS INTEGER) AS horizon, {t} AS value FROM dataset" for h, t in enumerate(TARGETS, start=1)) + ")"


@query("target_stats", tidy_sql("""SELECT CAST(count(*) / 24 AS BIGINT) AS total_samples,
    CAST(24 AS INTEGER) AS forecast_horizons, count(*) AS total_predictions, count(value) AS valid_predictions,
    count(*) - count(value) AS missing_predictions, avg(value) AS overall_mean, stddev_pop(value) AS overall_std,
    min(value) AS overall_min, max(value) AS overall_max, quantile_cont(value, 0.5) AS overall_median FROM long""",
    [f"overall_{s}" for s in ("mean", "std", "min", "max", "median")], ctes=TARGET_SQL))
def target_stats(spark, sf):
    return tidy(ops.target_stats(dataset(spark, sf), TARGETS))


@query("target_stats_by_horizon", tidy_sql("""SELECT horizon, count(*) AS count, avg(value) AS mean,
    stddev_samp(value) AS std, min(value) AS min, max(value) AS max, quantile_cont(value, 0.5) AS median
  FROM long WHERE value IS NOT NULL GROUP BY 1""", ["mean", "std", "min", "max", "median"], ctes=TARGET_SQL))
def target_stats_by_horizon(spark, sf):
    return tidy(ops.target_stats_by_horizon(dataset(spark, sf), TARGETS))


def corr_sql(source: str, columns) -> str:
    """Every cell of the matrix from one pass: NULL where a side does not vary."""
    def cell(a: str, b: str) -> str:
        varies = f"min({a}) < max({a}) AND min({b}) < max({b})"
        r = "CAST(1.0 AS DOUBLE)" if a == b else f"corr({a}, {b})"
        return f"struct_pack(feature_1 := '{a}', feature_2 := '{b}', correlation := CASE WHEN {varies} THEN {r} END)"
    cells = ", ".join(cell(a, b) for a in columns for b in columns)
    return f"SELECT '{source}' AS source, c.* FROM (SELECT unnest([{cells}]) AS c FROM {source})"


CORR_SQL = f"""WITH {DATASET_SQL}, cells AS ({corr_sql('lineitem', NUMBERS)} UNION ALL {corr_sql('dataset', NUMERIC)}),
named AS (SELECT unnest({[*NUMBERS, *NUMERIC]}) AS feature, unnest(range({len(NUMBERS) + len(NUMERIC)})) AS place)"""


def _both(spark, sf, operator):
    """The operator over all numeric columns of lineitem and all numeric features of the dataset."""
    a = operator(lineitem(spark, sf), list(NUMBERS)).withColumn("source", F.lit("lineitem"))
    b = operator(dataset(spark, sf), NUMERIC, complete=True).withColumn("source", F.lit("dataset"))
    return a.unionByName(b)


@query("corr_matrix", tidy_sql("SELECT * FROM cells", ["correlation"], ctes=CORR_SQL))
def corr_matrix(spark, sf):
    return tidy(_both(spark, sf, correlation_matrix))


@query("corr_high_pairs", tidy_sql("""SELECT c.* FROM cells c JOIN named a ON a.feature = feature_1
    JOIN named b ON b.feature = feature_2 WHERE a.place < b.place AND abs(correlation) > 0.8""",
    ["correlation"], ctes=CORR_SQL))
def corr_high_pairs(spark, sf):
    return tidy(_both(spark, sf, lambda *a, **k: high_pairs(correlation_pairs(*a, **k))))


@query("corr_summary", tidy_sql("""SELECT source, count(DISTINCT feature_1) AS numeric_features_count,
    count(*) FILTER (WHERE feature_1 < feature_2 AND abs(correlation) > 0.8) AS high_correlation_count,
    CASE WHEN count(*) > count(correlation) THEN 0.0 ELSE avg(abs(correlation)) END AS average_absolute_correlation
  FROM cells GROUP BY 1""", ["average_absolute_correlation"], ctes=CORR_SQL))
def corr_summary(spark, sf):
    return tidy(_both(spark, sf, lambda *a, **k: correlation_summary(correlation_matrix(*a, **k))))


@query("corr_target", tidy_sql("""SELECT 'irradiation' AS feature, corr(g.ac_power, w.ac_power) AS correlation
  FROM hourly g JOIN hourly w ON g.date_time = w.date_time AND g.event_type = 'purchase' AND w.event_type = 'view'""",
    ["correlation"], ctes=f"WITH {HOURLY_KEY_SQL}"))
def corr_target(spark, sf):
    rows = hourly_by_key(spark, sf)
    generation = rows.where(F.col("event_type") == "purchase").select("date_time", "ac_power")
    weather = rows.where(F.col("event_type") == "view").select("date_time", F.col("ac_power").alias("irradiation"))
    return tidy(correlation_with(gen_weather_join(generation, weather), "ac_power", ["irradiation"]))


def histogram_sql(source: str, column: str, bins: int) -> str:
    return f"""SELECT '{column}' AS feature, CAST(g.bin AS INTEGER) AS bin, lo + g.bin * w AS bin_start,
      lo + (g.bin + 1) * w AS bin_end, count(x.bin) AS count
    FROM (SELECT min({column}) AS lo, (max({column}) - min({column})) / {bins} AS w FROM {source}) AS e,
      (SELECT unnest(range({bins})) AS bin) AS g
      LEFT JOIN (SELECT least(floor(({column} - s.lo) / s.w), {bins - 1}) AS bin FROM {source},
        (SELECT min({column}) AS lo, (max({column}) - min({column})) / {bins} AS w FROM {source}) AS s) AS x
      ON x.bin = g.bin
    GROUP BY 1, 2, 3, 4"""


@query("histogram", tidy_sql(
    histogram_sql("events", "value", 50) + " UNION ALL " + histogram_sql("lineitem", "l_extendedprice", 30),
    ["bin_start", "bin_end"]))
def histogram(spark, sf):
    a = ops.histogram(table(spark, sf, "events"), {"value": 50})
    b = ops.histogram(lineitem(spark, sf), {"l_extendedprice": 30})
    return tidy(a.unionByName(b))


@query("histogram_targets", tidy_sql("""SELECT g.feature, CAST(g.bin AS INTEGER) AS bin, lo + g.bin * w AS bin_start,
    lo + (g.bin + 1) * w AS bin_end, count(x.bin) AS count
  FROM (SELECT feature, lo, w, unnest(range(50)) AS bin FROM edges) AS g
    LEFT JOIN (SELECT feature, least(floor((value - lo) / w), 49) AS bin FROM powered JOIN edges USING (feature)) AS x
    ON x.feature = g.feature AND x.bin = g.bin
  GROUP BY 1, 2, 3, 4""", ["bin_start", "bin_end"], ctes=f"""{TARGET_SQL},
powered AS (SELECT 'ac_power_' || horizon || 'h' AS feature, value FROM long WHERE value > 0),
edges AS (SELECT feature, min(value) AS lo, (max(value) - min(value)) / 50 AS w FROM powered GROUP BY 1)"""))
def histogram_targets(spark, sf):
    return tidy(ops.histogram(dataset(spark, sf), dict.fromkeys(TARGETS, 50), positive=True))
