from pyspark.sql import functions as F

from watthour.catalog.registry import (
    ACCURACY_DOUBLES, DATASET_SQL, TARGETS, accuracy_sql, dataset, pairs_sql, query, tidy, tidy_sql,
)
from watthour.operators import evaluate as ops
from watthour.operators.dataset import train_test_split

P24 = [f"p24_{h}" for h in range(1, 25)]
P168 = [f"p168_{h}" for h in range(1, 25)]
DIGITS = {"mape": 4, **{f"mape_{s}": 4 for s in ("mean", "std", "min", "max", "median")}}

LONG_SQL = f"WITH {DATASET_SQL}, long AS ({pairs_sql()})"
BY_HORIZON_SQL = f"""{LONG_SQL}, by_horizon AS (SELECT horizon, {accuracy_sql((10, 20))},
    avg(y) AS true_mean, stddev_pop(y) AS true_std, avg(y_hat) AS pred_mean, stddev_pop(y_hat) AS pred_std,
    count(*) AS samples FROM long GROUP BY 1)"""
BY_HORIZON_DOUBLES = [*ACCURACY_DOUBLES, "true_mean", "true_std", "pred_mean", "pred_std"]


def _pairs(spark, sf):
    return ops.to_pairs(dataset(spark, sf, naive=True), TARGETS, P24, ["date_time"])


@query("eval_overall", tidy_sql(f"""SELECT {accuracy_sql((10, 20, 30))}, count(*) AS total_samples,
    count(DISTINCT horizon) AS forecast_horizons FROM long""",
    [*ACCURACY_DOUBLES, "predictions_within_30pct"], DIGITS, LONG_SQL))
def overall(spark, sf):
    return tidy(ops.overall_metrics(_pairs(spark, sf)), DIGITS)


@query("eval_by_horizon", tidy_sql("SELECT * FROM by_horizon", BY_HORIZON_DOUBLES, DIGITS, BY_HORIZON_SQL))
def by_horizon(spark, sf):
    return tidy(ops.horizon_metrics(_pairs(spark, sf)), DIGITS)


SUMMARY = [f"{f} AS {m}_{s}".format(m=m) for m in ops.SUMMARY_METRICS for s, f in (
    ("mean", "avg({m})"), ("std", "stddev_pop({m})"), ("min", "min({m})"), ("max", "max({m})"),
    ("median", "quantile_cont({m}, 0.5)"))]
BEST = [f"CAST((SELECT horizon FROM by_horizon ORDER BY {m} {d}, horizon LIMIT 1) AS INTEGER) AS {w}_horizon_{m}"
        for m, good in (("rmse", "ASC"), ("mae", "ASC"), ("r2", "DESC"))
        for w, d in (("best", good), ("worst", "DESC" if good == "ASC" else "ASC"))]


@query("eval_horizon_summary", tidy_sql(
    f"SELECT {', '.join(SUMMARY + BEST)} FROM by_horizon",
    [f"{m}_{s}" for m in ops.SUMMARY_METRICS for s in ("mean", "std", "min", "max", "median")], DIGITS, BY_HORIZON_SQL))
def summary(spark, sf):
    return tidy(ops.horizon_summary(ops.horizon_metrics(_pairs(spark, sf))), DIGITS)


@query("eval_key_horizons", tidy_sql(
    "SELECT * FROM by_horizon WHERE horizon IN (1, 6, 12, 24)", BY_HORIZON_DOUBLES, DIGITS, BY_HORIZON_SQL))
def keys(spark, sf):
    return tidy(ops.key_horizons(ops.horizon_metrics(_pairs(spark, sf))), DIGITS)


METRIC_ROWS = {
    "rmse_overall": "(SELECT rmse FROM o WHERE o.split = h.split)", "mae_overall": "(SELECT mae FROM o WHERE o.split = h.split)",
    "r2_overall": "(SELECT r2 FROM o WHERE o.split = h.split)",
    **{f"{m}_{k}h": f"max({m}) FILTER (WHERE horizon = {k})" for m in ("rmse", "mae") for k in ops.KEY_HORIZONS},
    "rmse_horizon_mean": "avg(rmse)", "rmse_horizon_std": "stddev_pop(rmse)",
    "mae_horizon_mean": "avg(mae)", "mae_horizon_std": "stddev_pop(mae)",
}


@query("metrics_long", tidy_sql(" UNION ALL ".join(
    f"SELECT split || '_{name}' AS metric_name, {e} AS metric_value FROM h GROUP BY split"
    for name, e in METRIC_ROWS.items()), ["metric_value"], ctes=f"""WITH {DATASET_SQL},
  placed AS (SELECT date_time, CASE WHEN row_number() OVER (ORDER BY date_time) - 1 < floor(0.8 * count(*) OVER ())
    THEN 'train' ELSE 'test' END AS split FROM dataset),
  long AS (SELECT p.split, l.* FROM ({pairs_sql()}) AS l JOIN placed p ON p.date_time = l.date_time),
  o AS (SELECT split, {accuracy_sql((10,))} FROM long GROUP BY 1),
  h AS (SELECT split, horizon, {accuracy_sql((10,))} FROM long GROUP BY 1, 2)"""))
def metrics_long(spark, sf):
    split = train_test_split(dataset(spark, sf, naive=True))
    return tidy(ops.training_metrics(ops.to_pairs(split, TARGETS, P24, ["split"])))


def _models(spark, sf):
    """Rows of three baselines: a day back, a week back, and the mean of both."""
    rows = dataset(spark, sf, naive=True)
    both = [((F.col(a) + F.col(b)) / 2) for a, b in zip(P24, P168)]
    named = (("naive_day", [F.col(c) for c in P24]), ("naive_week", [F.col(c) for c in P168]), ("mean", both))
    cells = F.array(*[
        F.struct(F.lit(n).alias("model_name"), F.lit(i).alias("model_index"), F.lit(h).alias("horizon"),
                 F.col(t).alias("y"), p.alias("y_hat"))
        for i, (n, preds) in enumerate(named) for h, (t, p) in enumerate(zip(TARGETS, preds), start=1)
    ])
    return rows.select("date_time", F.explode(cells).alias("c")).select("date_time", "c.*")


MODELS_SQL = f"""WITH {DATASET_SQL}, long AS (
  SELECT 'naive_day' AS model_name, 0 AS model_index, * FROM ({pairs_sql()}) AS a
  UNION ALL SELECT 'naive_week', 1, * FROM ({pairs_sql(prefix='p168')}) AS b
  UNION ALL SELECT 'mean', 2, a.date_time, a.horizon, a.y, (a.y_hat + b.y_hat) / 2
    FROM ({pairs_sql()}) AS a JOIN ({pairs_sql(prefix='p168')}) AS b
    ON a.date_time = b.date_time AND a.horizon = b.horizon),
m AS (SELECT model_name, model_index, {accuracy_sql((10, 20, 30))} FROM long GROUP BY 1, 2)"""


def _best_sql(metric: str, way: str) -> str:
    return f"(SELECT model_name FROM m ORDER BY {metric} {way}, model_index LIMIT 1)"


@query("model_compare", tidy_sql(f"""SELECT count(*) AS models,
    {_best_sql('rmse', 'ASC')} AS best_rmse, {_best_sql('mae', 'ASC')} AS best_mae, {_best_sql('r2', 'DESC')} AS best_r2,
    {_best_sql('mape', 'ASC')} AS best_mape,
    {_best_sql('predictions_within_10pct', 'DESC')} AS best_predictions_within_10pct,
    min(rmse) AS rmse_min, max(rmse) AS rmse_max, (max(rmse) - min(rmse)) / max(rmse) * 100 AS rmse_improvement,
    min(mae) AS mae_min, max(mae) AS mae_max, (max(mae) - min(mae)) / max(mae) * 100 AS mae_improvement,
    {_best_sql('rmse', 'ASC')} AS recommendation FROM m""",
    [f"{m}_{s}" for m in ("rmse", "mae") for s in ("min", "max", "improvement")], ctes=MODELS_SQL))
def model_compare(spark, sf):
    metrics = ops.overall_metrics(_models(spark, sf), ["model_name", "model_index"])
    return tidy(ops.compare_models(metrics))


@query("predictions_close", tidy_sql("""SELECT l.model_name, count(*) AS compared,
    count(*) FILTER (WHERE abs(l.y_hat - b.p) <= 1e-8 + 1e-5 * abs(b.p)) AS close,
    bool_and(abs(l.y_hat - b.p) <= 1e-8 + 1e-5 * abs(b.p)) AS all_close, max(abs(l.y_hat - b.p)) AS max_difference
  FROM long l JOIN (SELECT date_time, horizon, y_hat * (1 + 1e-7) AS p FROM long WHERE model_name = 'naive_day') AS b
    ON b.date_time = l.date_time AND b.horizon = l.horizon GROUP BY 1""", ["max_difference"], ctes=MODELS_SQL))
def predictions_close(spark, sf):
    rows = _models(spark, sf).select("model_name", "date_time", "horizon", "y_hat")
    day = rows.where(F.col("model_name") == "naive_day").drop("model_name")
    names = F.array(*[F.lit(n) for n in ("naive_day", "naive_week", "mean")])
    nudged = day.withColumns({"y_hat": F.col("y_hat") * (1 + 1e-7), "model_name": F.explode(names)})
    return tidy(ops.predictions_close(rows, nudged, ["model_name", "date_time", "horizon"], ["model_name"]))
