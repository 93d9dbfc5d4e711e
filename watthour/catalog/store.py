from functools import reduce

from pyspark.sql import functions as F

from watthour.catalog.registry import (
    HOURLY_KEY_SQL, KEY, ORDERS_AS_OF, RELATIVE, at, hourly_by_key, predictions, query, table, tidy, tidy_sql,
)
from watthour.operators import store as ops
from watthour.operators.forecast import hourly_arrays

ORDER_KEY = ["o_custkey", "o_orderpriority"]
NEWEST = ["o_orderdate", "o_orderkey"]
COLUMNS = ["o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey", "o_totalprice"]

SIDES_SQL = """ranked AS (SELECT o_custkey, o_orderpriority, o_orderdate, o_orderkey, o_totalprice, side,
    row_number() OVER (PARTITION BY side, o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS k
  FROM (SELECT *, 'old' AS side FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'
    UNION ALL SELECT *, 'new' FROM orders WHERE o_orderdate >= TIMESTAMP '2000-07-01') AS s),
existing AS (SELECT * EXCLUDE (side, k) FROM ranked WHERE side = 'old' AND k = 1),
incoming AS (SELECT * EXCLUDE (side, k) FROM ranked WHERE side = 'new' AND k = 1)"""


def _sides(spark, sf):
    orders = table(spark, sf, "orders").select(*COLUMNS)
    old = orders.where(F.col("o_orderdate") < at("2001-01-01"))
    new = orders.where(F.col("o_orderdate") >= at("2000-07-01"))
    return ops.latest_by(old, ORDER_KEY, NEWEST), ops.latest_by(new, ORDER_KEY, NEWEST)


@query("append_dedup", tidy_sql("""SELECT * FROM incoming i WHERE NOT EXISTS (SELECT 1 FROM existing e
  WHERE e.o_custkey = i.o_custkey AND e.o_orderpriority = i.o_orderpriority)""",
    ["o_totalprice"], ctes=f"WITH {SIDES_SQL}"))
def append_dedup(spark, sf):
    existing, incoming = _sides(spark, sf)
    return tidy(ops.append_dedup(existing, incoming, ORDER_KEY))


@query("upsert_latest", tidy_sql("""SELECT * FROM incoming UNION ALL SELECT * FROM existing e
  WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE e.o_custkey = i.o_custkey AND e.o_orderpriority = i.o_orderpriority)""",
    ["o_totalprice"], ctes=f"WITH {SIDES_SQL}"))
def upsert_latest(spark, sf):
    existing, incoming = _sides(spark, sf)
    return tidy(ops.upsert(existing, incoming, ORDER_KEY))


@query("retention_split", f"""SELECT
  count(*) FILTER (WHERE CAST(o_orderdate AS DATE) >= DATE '{ORDERS_AS_OF}' - INTERVAL 90 DAY) AS kept,
  count(*) FILTER (WHERE CAST(o_orderdate AS DATE) < DATE '{ORDERS_AS_OF}' - INTERVAL 90 DAY) AS dropped FROM orders""")
def retention_split(spark, sf):
    return ops.retention_split(predictions(spark, sf), at(ORDERS_AS_OF))


@query("latest_profile", tidy_sql("""SELECT o_custkey, o_orderpriority, o_orderdate, o_orderkey, o_totalprice FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) AS r
  WHERE k = 1""", ["o_totalprice"]))
def latest_profile(spark, sf):
    return tidy(ops.latest_by(table(spark, sf, "orders").select(*COLUMNS), ["o_orderpriority"], NEWEST))


@query("list_profiles", """SELECT o_orderpriority AS model_name, CAST(o_orderkey AS VARCHAR) AS model_version,
  o_orderdate AS "timestamp" FROM orders""")
def list_profiles(spark, sf):
    return ops.list_profiles(_profiles(spark, sf))


def _profiles(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("model_name"), F.col("o_orderkey").cast("string").alias("model_version"),
        F.col("o_orderdate").alias("timestamp"))


@query("select_profile", """SELECT p.* FROM (SELECT DISTINCT o_orderpriority AS priority FROM orders) AS m,
  LATERAL (SELECT o_orderpriority AS model_name, CAST(o_orderkey AS VARCHAR) AS model_version, o_orderdate AS "timestamp"
    FROM orders WHERE o_orderpriority = m.priority ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC LIMIT 1) AS p""")
def select_profile(spark, sf):
    """The newest profile of each model, looked up model by model as a reader does."""
    profiles = _profiles(spark, sf)
    models = sorted(row[0] for row in profiles.select("model_name").distinct().collect())
    return reduce(lambda a, b: a.unionByName(b), [ops.select_profile(profiles, m) for m in models])


@query("metrics_unpivot", tidy_sql(" UNION ALL ".join(
    f"SELECT o_orderpriority, '{m}' AS metric_name, CAST({f}(o_totalprice) AS DOUBLE) AS metric_value FROM orders GROUP BY 1"
    for m, f in (("mean", "avg"), ("top", "max"), ("rows", "count"))), ["metric_value"], {"metric_value": RELATIVE}))
def metrics_unpivot(spark, sf):
    wide = table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.avg("o_totalprice").alias("mean"), F.max("o_totalprice").alias("top"), F.count("o_totalprice").alias("rows"))
    return tidy(ops.metrics_long(wide, ["mean", "top", "rows"], ["o_orderpriority"]), {"metric_value": RELATIVE})


@query("keep_latest_n", """SELECT o_custkey, o_orderpriority, o_orderdate, o_orderkey, o_orderstatus,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) > 3
    AND o_orderstatus <> 'P' AS to_archive FROM orders""")
def keep_latest_n(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey", "o_orderstatus")
    return ops.keep_latest_n(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderstatus", 3, ("P",))


@query("forecast_json", tidy_sql("""SELECT event_type, prediction_date, CAST(i AS INTEGER) AS position, a[i + 1] AS power
  FROM (SELECT event_type, CAST(date_time AS DATE) AS prediction_date, list(ac_power ORDER BY date_time) AS a
      FROM hourly GROUP BY 1, 2) AS d, unnest(range(len(a))) AS u(i)""", ["power"], ctes=f"WITH {HOURLY_KEY_SQL}"))
def forecast_json(spark, sf):
    text = ops.forecast_json(hourly_arrays(hourly_by_key(spark, sf), keys=[KEY]))
    back = ops.forecast_from_json(text)
    return tidy(back.select(KEY, "prediction_date", F.posexplode("forecast_24h").alias("position", "power")))
