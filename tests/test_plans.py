"""Plans stay free of Python workers, products and one-task windows, and scans stay narrow."""

import re

import pytest

from cityflow.catalog import queries as Q
from cityflow.operators import star
from cityflow.plans import lake, views
from cityflow.sources import driver_tables as source

NATIVE = [
    "kpi1_congestion_index", "kpi4_risk_score", "kpi10_vehicle_class", "dim7_fact_traffic", "dim8_fact_accident",
    "vw1_location_summary", "vw1f_location_summary_fanout", "vw2_hourly_profile", "vw2f_hourly_profile_fanout",
    "vw3_monthly_trend", "vw4_congestion_hotspots", "vw5_weather_risk", "vw6_severity_by_location",
    "vw7_road_condition_risk", "vw8_ml_location_risk", "adh1_hazard_distribution", "adh5_headline",
    "adh6_peak_hour", "mlp1_features", "mlp4_hash_split", "mlp5_standardise", "mlp7_metrics", "mlp10_comparison", "str3_alarm",
]


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_and_no_products(spark, sf_dir, name):
    plan = plan_of(Q.QUERIES[name](spark, sf_dir))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_dimensions_are_broadcast_unasked(spark, sf_dir):
    plan = plan_of(Q.warehouse_of(spark, sf_dir).accidents)
    assert "SortMergeJoin" not in plan
    assert plan.count("LocalTableScan") == 2 and plan.count("BroadcastExchange") >= 3


def test_scans_read_only_what_a_query_needs(spark, sf_dir):
    plan = plan_of(lake.traffic_by_location(Q.sensor(spark, sf_dir)))
    read = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert any("user_id" in columns and "value" in columns for columns in read)
    assert not any("props" in columns or "event_type" in columns for columns in read)


def test_filters_reach_the_scan(spark, sf_dir):
    plan = plan_of(source.table(spark, sf_dir, "events").filter("event_type = 'error'"))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan


def test_fanout_view_joins_no_facts(spark, sf_dir):
    built = Q.warehouse_of(spark, sf_dir)
    plan = plan_of(views.hourly_profile_fanout(built.accidents, built.traffic))
    assert "Union" in plan
    assert "date_id" not in " ".join(re.findall(r"Join \[[^]]*\]", plan))


def test_date_keys_need_no_join_or_global_sort(spark, sf_dir):
    plan = plan_of(star.dim_date(Q.sensor(spark, sf_dir), Q.accident(spark, sf_dir)))
    assert "Sort" not in plan and "Window" not in plan and "SinglePartition" not in plan


def test_large_sides_are_shuffled_not_broadcast(spark, sf_dir):
    """With the size limit below the tables' sizes, the same plan turns to sort-merge joins."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plan = plan_of(source.accident_raw(spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
