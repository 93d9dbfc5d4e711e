"""Where queries are registered, and the stand-in frames and SQL they share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watthour.functions.calendar import SEASONS, TEMPORAL_COLUMNS
from watthour.operators.dataset import forecast_dataset
from watthour.operators.features import SAME_HOUR, target_names
from watthour.operators.forecast import naive_predictions
from watthour.operators.hourly import hourly_mean

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The events cover 30 days, so the 30-day lag and window are left out here.
LAGS, WINDOWS = (1, 2, 3, 7), (7,)
KEY = "event_type"
TARGETS = target_names()
HISTORY = [f"ac_power_lag_{d}d" for d in LAGS] + [f"rolling_{s}_7d" for s in ("mean", "std", "max")] + list(SAME_HOUR)
SEASON_FLAGS = [f"season_{s}" for s in SEASONS]
NUMERIC = HISTORY + list(TEMPORAL_COLUMNS)
INTEGERS = TEMPORAL_COLUMNS[:8]
EVENTS_AS_OF, ORDERS_AS_OF = "2024-01-31", "2001-08-01"
CUT = "2024-01-24"


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return register


# --- frames -----------------------------------------------------------------

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", KEY, F.col("ts").alias("date_time"), F.col("value").alias("ac_power"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_mean(readings(spark, sf_dir))


def hourly_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_mean(readings(spark, sf_dir), keys=[KEY])


def dataset(spark: SparkSession, sf_dir: str, naive: bool = False) -> DataFrame:
    """Features and targets of the keyless series; with ``naive``, baseline predictions too."""
    def extra(w):
        day = {f"p24_{h}": c for h, c in enumerate(naive_predictions(w), start=1)}
        week = {f"p168_{h}": c for h, c in enumerate(naive_predictions(w, season=168), start=1)}
        return {**day, **week}
    return forecast_dataset(hourly(spark, sf_dir), lag_days=LAGS, rolling_days=WINDOWS, extra=extra if naive else None)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the role of stored predictions."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("prediction_date"),
        F.col("o_orderpriority").alias("model_name"), F.col("o_totalprice").alias("peak_power"),
        (F.col("o_totalprice") / 4).alias("total_energy"), F.col("o_orderdate").alias("created_at"))


def drift_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the role of a drift log."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"), F.col(KEY).alias("feature_name"),
        (F.col("value") / 50).alias("drift_score"), (F.col("value") > 100).alias("drift_detected"))


def midnights(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """First and last midnight within the events."""
    day = F.to_date("ts")
    first, last = table(spark, sf_dir, "events").agg(F.min(F.date_add(day, 1)), F.max(day)).first()
    return first, last


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of all documents with their labels, which some lack."""
    facts = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    return facts.join(table(spark, sf_dir, "labels"), "doc_id", "left")


def at(moment: str):
    return F.lit(moment).cast("timestamp_ntz")


RELATIVE = None  # ten significant digits in place of a number of decimals


def r(expression: str, digits: int | None = 6) -> str:
    """SQL text, for both engines, of a rounded double.

    Means of short decimals often end in an exact half, where the engines' last bits
    decide; a nudge far below the last kept digit settles it.  -0.0 becomes 0.0.
    """
    if digits is RELATIVE:
        return (f"CASE WHEN {expression} = 0 THEN CAST(0 AS DOUBLE) WHEN {expression} IS NOT NULL "
                f"THEN CAST(printf('%.9e', {expression} * (1 + 1.23e-13)) AS DOUBLE) END")
    short = f"round({expression} + {1.23 * 10 ** -(digits + 3):.3e}, {digits})"
    return f"CASE WHEN {short} = 0 THEN CAST(0 AS DOUBLE) ELSE {short} END"


def tidy(df: DataFrame, digits: dict[str, int | None] | None = None) -> DataFrame:
    """Round every double, so that both engines print the same number."""
    digits = digits or {}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.selectExpr(*[
        f"{r(f'`{c}`', digits.get(c, 6))} AS `{c}`" if isinstance(t, T.DoubleType) else f"`{c}`"
        for c, t in kinds.items()
    ])


# --- SQL --------------------------------------------------------------------

def tidy_sql(inner: str, doubles: Sequence[str], digits: dict[str, int | None] | None = None, ctes: str = "") -> str:
    digits = digits or {}
    swaps = ", ".join(f"{r(c, digits.get(c, 6))} AS {c}" for c in doubles)
    return f"{ctes} SELECT * REPLACE ({swaps}) FROM ({inner}) AS t"


LABELLED_SQL = """labelled AS (SELECT d.doc_id, n_chars, lang, source, quality, toxic
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
HOURLY_SQL = """hourly AS (
  SELECT date_trunc('hour', ts) AS date_time, avg(value) AS ac_power FROM events GROUP BY 1)"""
HOURLY_KEY_SQL = """hourly AS (
  SELECT event_type, date_trunc('hour', ts) AS date_time, avg(value) AS ac_power FROM events GROUP BY 1, 2)"""


def lags_sql(window: str = "w") -> str:
    lags = [f"lag(ac_power, {24 * d}) OVER {window} AS ac_power_lag_{d}d" for d in LAGS]
    weeks = [f"lag(ac_power, {168 * n}) OVER {window} AS {name}" for name, n in zip(SAME_HOUR, (1, 2, 1))]
    return ", ".join(lags + weeks)


ROLLING_SQL = ", ".join(
    f"CASE WHEN count(ac_power) OVER roll >= 84 THEN {f}(ac_power) OVER roll END AS rolling_{n}_7d"
    for n, f in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max")))
LEADS_SQL = ", ".join(f"lead(ac_power, {h}) OVER w AS ac_power_{h}h" for h in range(1, 25))


def windows_sql(partition: str = "") -> str:
    by = f"PARTITION BY {partition} " if partition else ""
    return (f"WINDOW w AS ({by}ORDER BY date_time), "
            f"roll AS ({by}ORDER BY date_time ROWS BETWEEN 191 PRECEDING AND 24 PRECEDING)")


def calendar_sql(ts: str = "date_time") -> str:
    hour, dow, doy = f"hour({ts})", f"(isodow({ts}) - 1)", f"dayofyear({ts})"
    ints = {
        "hour_of_day": hour, "day_of_week": dow, "day_of_year": doy,
        "month": f"month({ts})", "quarter": f"quarter({ts})",
        "is_daylight": f"CASE WHEN {hour} BETWEEN 6 AND 18 THEN 1 ELSE 0 END",
        "is_peak_solar": f"CASE WHEN {hour} BETWEEN 10 AND 14 THEN 1 ELSE 0 END",
        "is_weekend": f"CASE WHEN {dow} >= 5 THEN 1 ELSE 0 END",
    }
    turn = {"hour": (hour, 24), "day_of_year": (doy, 365), "day_of_week": (dow, 7)}
    doubles = {f"{n}_{f}": f"{f}(2 * pi() * {x} / {p})" for n, (x, p) in turn.items() for f in ("sin", "cos")}
    doubles["solar_elevation_proxy"] = f"sin(2 * pi() * {hour} / 24) * sin(2 * pi() * {doy} / 365)"
    months = {"autumn": "9, 10, 11", "spring": "3, 4, 5", "summer": "6, 7, 8", "winter": "12, 1, 2"}
    flags = {f"season_{s}": f"month({ts}) IN ({m})" for s, m in months.items()}
    parts = [f"CAST({e} AS INTEGER) AS {n}" for n, e in ints.items()]
    parts += [f"{e} AS {n}" for n, e in {**doubles, **flags}.items()]
    return ", ".join(parts)


P24_SQL = ", ".join(
    f"{f'lag(ac_power, {24 - h}) OVER w' if h < 24 else 'ac_power'} AS p24_{h}" for h in range(1, 25))
P168_SQL = ", ".join(f"lag(ac_power, {168 - h}) OVER w AS p168_{h}" for h in range(1, 25))

DATASET_SQL = f"""{HOURLY_SQL},
windowed AS (SELECT date_time, ac_power, {lags_sql()}, {ROLLING_SQL}, {LEADS_SQL}, {P24_SQL}, {P168_SQL}
  FROM hourly {windows_sql()}),
full_rows AS (SELECT date_time, {', '.join(HISTORY)}, {calendar_sql()}, {', '.join(TARGETS)},
    {', '.join(f'p24_{h}, p168_{h}' for h in range(1, 25))} FROM windowed),
dataset AS (SELECT * FROM full_rows WHERE {' AND '.join(f'{c} IS NOT NULL' for c in HISTORY + TARGETS)})"""
DATASET_COLUMNS = ["date_time", *HISTORY, *TEMPORAL_COLUMNS, *SEASON_FLAGS, *TARGETS]
DATASET_DOUBLES = [c for c in [*NUMERIC, *TARGETS] if c not in INTEGERS]


def pairs_sql(extra: str = "date_time", prefix: str = "p24") -> str:
    """Long (horizon, y, y_hat) rows of the dataset."""
    return " UNION ALL ".join(
        f"SELECT {extra}, CAST({h} AS INTEGER) AS horizon, ac_power_{h}h AS y, {prefix}_{h} AS y_hat FROM dataset"
        for h in range(1, 25))


def accuracy_sql(within: Sequence[int]) -> str:
    n = "count(*)"
    shares = ", ".join(
        f"100.0 * count(*) FILTER (WHERE abs(y - y_hat) / (y + 1e-8) * 100 <= {p}) / {n} AS predictions_within_{p}pct"
        for p in within)
    return f"""sqrt(avg((y - y_hat) * (y - y_hat))) AS rmse, avg(abs(y - y_hat)) AS mae,
      CASE WHEN var_pop(y) = 0 THEN CASE WHEN sum((y - y_hat) * (y - y_hat)) = 0 THEN 1.0 ELSE 0.0 END
           ELSE 1 - sum((y - y_hat) * (y - y_hat)) / (var_pop(y) * {n}) END AS r2,
      avg(abs((y - y_hat) / (y + 1e-8))) * 100 AS mape,
      avg(y - y_hat) AS residual_mean, stddev_pop(y - y_hat) AS residual_std, {shares}"""


ACCURACY_DOUBLES = ["rmse", "mae", "r2", "mape", "residual_mean", "residual_std",
                    "predictions_within_10pct", "predictions_within_20pct"]
