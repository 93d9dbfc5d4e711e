"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

from oracle import connect, differences
from watthour.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("WATTHOUR_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in plan for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF"))
    assert differences(df, con, ORACLES[name]) == []


@pytest.mark.parametrize("name", ["drift_score", "drift_summary", "drift_log"])
def test_drift_scores_every_event_type(spark, tmp_path, name):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    sixth = events.where("event_type = 'view'").withColumn("event_type", F.lit("a.sixth")).withColumn("value", F.col("value") * 3)
    events.unionByName(sixth).coalesce(1).write.parquet(str(tmp_path / "all"))
    next((tmp_path / "all").glob("*.parquet")).rename(tmp_path / "events.parquet")
    df = QUERIES[name](spark, str(tmp_path))
    assert differences(df, connect(str(tmp_path)), ORACLES[name]) == []
    if name == "drift_score":
        assert df.where("feature = 'a.sixth'").count() == 2


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    assert rows and all(value is not None for row in rows for value in row)
