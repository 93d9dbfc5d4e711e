from pyspark.sql import functions as F

from watthour.catalog.registry import (
    CUT, DATASET_COLUMNS, DATASET_DOUBLES, DATASET_SQL, HISTORY, LAGS, NUMERIC, SEASON_FLAGS,
    TARGETS, WINDOWS, at, dataset, pairs_sql, query, readings, tidy, tidy_sql,
)
from watthour.operators import dataset as ops
from watthour.operators.evaluate import cv_summary, to_pairs
from watthour.operators.scaling import apply_scaler, fit_scaler
from watthour.plans.training import fit_dataset, transform

P24 = [f"p24_{h}" for h in range(1, 25)]
COLUMNS = ", ".join(DATASET_COLUMNS)


@query("forecast_dataset", tidy_sql(f"SELECT {COLUMNS} FROM dataset", DATASET_DOUBLES, ctes=f"WITH {DATASET_SQL}"))
def forecast_dataset(spark, sf):
    return tidy(dataset(spark, sf))


def scaled_sql(method: str, fit_where: str, rows: str, apply_where: str, keep: list[str]) -> str:
    shift, spread = ("avg", "stddev_pop({0})") if method == "standard" else ("min", "max({0}) - min({0})")
    fit = ", ".join(
        f"{shift}({c}) AS s_{c}, CASE WHEN {spread.format(c)} = 0 THEN 1 ELSE {spread.format(c)} END AS d_{c}"
        for c in NUMERIC)
    out = ", ".join(f"({c} - s_{c}) / d_{c} AS {c}" for c in NUMERIC)
    inner = f"SELECT date_time, {out}, {', '.join(keep)} FROM {rows}, params WHERE {apply_where}"
    doubles = NUMERIC + [c for c in keep if c in TARGETS]
    return tidy_sql(inner, doubles, ctes=f"WITH {DATASET_SQL}, params AS (SELECT {fit} FROM dataset WHERE {fit_where})")


@query("fit_dataset", scaled_sql("standard", "true", "dataset", "true", SEASON_FLAGS + TARGETS))
def fit(spark, sf):
    rows, _ = fit_dataset(readings(spark, sf), lag_days=LAGS, rolling_days=WINDOWS)
    return tidy(rows)


def _scaled(spark, sf, method):
    rows = dataset(spark, sf)
    params = fit_scaler(rows.where(F.col("date_time") < at(CUT)), NUMERIC)
    later = rows.where(F.col("date_time") >= at(CUT)).drop(*TARGETS)
    return tidy(apply_scaler(later, params, method))


SPLIT = (f"date_time < TIMESTAMP '{CUT}'", f"date_time >= TIMESTAMP '{CUT}'")


@query("scale_standard", scaled_sql("standard", SPLIT[0], "dataset", SPLIT[1], SEASON_FLAGS))
def scale_standard(spark, sf):
    return _scaled(spark, sf, "standard")


@query("scale_minmax", scaled_sql("minmax", SPLIT[0], "dataset", SPLIT[1], SEASON_FLAGS))
def scale_minmax(spark, sf):
    return _scaled(spark, sf, "minmax")


HAVE = " AND ".join(f"{c} IS NOT NULL" for c in HISTORY)


@query("transform_apply", scaled_sql("standard", SPLIT[0], "full_rows", f"{SPLIT[1]} AND {HAVE}", SEASON_FLAGS))
def transform_apply(spark, sf):
    rows = readings(spark, sf)
    _, fitted = fit_dataset(rows, lag_days=LAGS, rolling_days=WINDOWS, fit_rows=F.col("date_time") < at(CUT))
    return tidy(transform(rows, fitted).where(F.col("date_time") >= at(CUT)))


@query("train_test_split", f"""WITH {DATASET_SQL}
SELECT date_time, CASE WHEN row_number() OVER (ORDER BY date_time) - 1 < floor(0.8 * count(*) OVER ())
  THEN 'train' ELSE 'test' END AS split FROM dataset""")
def split(spark, sf):
    return ops.train_test_split(dataset(spark, sf)).select("date_time", "split")


FOLDS_SQL = f"""WITH {DATASET_SQL},
placed AS (SELECT *, row_number() OVER (ORDER BY date_time) - 1 AS pos, count(*) OVER () AS n FROM dataset),
folds AS (SELECT p.*, CAST(k.fold AS INTEGER) AS fold,
    CASE WHEN pos < n - (4 - k.fold) * 7 THEN 'train' ELSE 'test' END AS role
  FROM placed p, (SELECT unnest([1, 2, 3]) AS fold) AS k
  WHERE pos < n - (4 - k.fold) * 7 + 7)"""


@query("cv_folds", f"{FOLDS_SQL} SELECT date_time, fold, role FROM folds")
def folds(spark, sf):
    return ops.cv_folds(dataset(spark, sf)).select("date_time", "fold", "role")


@query("cv_summary", tidy_sql("""
  SELECT count(*) AS folds, avg(rmse) AS cv_rmse_mean, stddev_pop(rmse) AS cv_rmse_std,
    avg(mae) AS cv_mae_mean, stddev_pop(mae) AS cv_mae_std, avg(r2) AS cv_r2_mean, stddev_pop(r2) AS cv_r2_std
  FROM (SELECT fold, sqrt(avg((y - y_hat) * (y - y_hat))) AS rmse, avg(abs(y - y_hat)) AS mae,
      1 - sum((y - y_hat) * (y - y_hat)) / (var_pop(y) * count(*)) AS r2 FROM long GROUP BY fold) AS f""",
    [f"cv_{m}_{s}" for m in ("rmse", "mae", "r2") for s in ("mean", "std")],
    ctes=f"{FOLDS_SQL}, long AS ({pairs_sql('fold').replace('FROM dataset', 'FROM folds')
         .replace('UNION ALL', 'WHERE role = ' + chr(39) + 'test' + chr(39) + ' UNION ALL')} WHERE role = 'test')"))
def cv(spark, sf):
    tests = ops.cv_folds(dataset(spark, sf, naive=True)).where(F.col("role") == "test")
    return tidy(cv_summary(to_pairs(tests, TARGETS, P24, ["fold"])))
