"""A third of all rows under one key, time and user; joins shuffled instead of broadcast."""

import duckdb
import pytest

import check
from __spark_entry__ import queries

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
}
QUERIES = [
    "vw1_location_summary", "vw1f_location_summary_fanout", "vw2_hourly_profile", "vw2f_hourly_profile_fanout",
    "vw5_weather_risk", "dim5_date_keys", "dim5_fact_keys", "dim8_fact_accident", "dq3_orphan_dates",
    "snk1_parquet_overwrite", "snk2_idempotent_append", "mlp4_stratified_split", "mlp7_metrics", "str3_alarm",
    "str3_alarm_stream", "str4_alarm_two_periods",
]


@pytest.fixture(scope="module")
def skewed(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name in ("region", "nation", "customer"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    orders = orders.selectExpr("* EXCEPT (o_custkey)", "IF(o_orderkey % 3 = 0, 7L, o_custkey) AS o_custkey")
    orders.repartition(8).write.parquet(f"{folder}/orders.parquet")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    hot = "event_id % 3 = 0"
    events = events.selectExpr(
        "* EXCEPT (ts, user_id)", f"IF({hot}, 4L, user_id) AS user_id",
        f"IF({hot}, timestamp_ntz'2024-01-03 05:00:00', ts) AS ts",
    )
    events.write.parquet(f"{folder}/events.parquet")
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield folder
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


@pytest.fixture(scope="module")
def con(skewed):
    connection = duckdb.connect()
    for table in ("region", "nation", "customer", "orders", "events"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{skewed}/{table}.parquet/*.parquet'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_results_hold_under_skew(spark, con, skewed, name):
    assert check.compare(spark, con, skewed, name).startswith("ok")


def test_hot_join_key_is_split(spark, skewed):
    frame = queries()["kpi4_risk_score"](spark, skewed)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
