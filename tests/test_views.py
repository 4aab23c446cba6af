"""Views against the literal SQL and each other, on the smallest benchmark tables."""

import pytest
from pyspark.sql import functions as F

from cityflow.catalog import queries as Q
from cityflow.plans import views


@pytest.fixture(scope="module")
def built(spark, sf_dir):
    return Q.warehouse_of(spark, sf_dir)


def rounded(rows):
    return sorted(tuple(round(float(v), 6) if isinstance(v, (int, float)) else str(v) for v in r) for r in rows)


def test_fanout_equals_the_literal_join(spark, built):
    views.register(spark, built.tables())
    literal = spark.sql(
        """
        SELECT l.location_name, count(DISTINCT a.accident_pk), sum(a.casualties), sum(a.is_fatal_or_severe),
               sum(t.vehicle_count), round(avg(t.vehicle_count), 1), max(a.risk_score)
        FROM fact_accident a JOIN dim_location l ON a.location_id = l.location_id
        LEFT JOIN fact_traffic t ON a.location_id = t.location_id GROUP BY l.location_name
        """
    )
    fast = views.location_summary_fanout(built.accidents, built.traffic, built.location).select(
        "location_name", "total_accidents", "total_casualties", "fatal_severe_count", "total_vehicles",
        "avg_vehicles_per_reading", "max_risk_score",
    )
    assert rounded(fast.collect()) == rounded(literal.collect())


def test_hourly_fanout_equals_the_literal_join(spark, built):
    views.register(spark, built.tables())
    literal = spark.sql(
        """
        SELECT d.hour, count(DISTINCT t.traffic_pk), count(DISTINCT a.accident_pk), sum(a.casualties),
               max(t.vehicle_count), sum(a.is_fatal_or_severe)
        FROM dim_date d LEFT JOIN fact_traffic t ON d.date_id = t.date_id
        LEFT JOIN fact_accident a ON d.date_id = a.date_id GROUP BY d.hour
        """
    )
    fast = views.hourly_profile_fanout(built.accidents, built.traffic).select(
        "hour", "sensor_reading_count", "accident_count", "total_casualties", "peak_vehicles", "fatal_severe_count"
    )
    assert rounded(fast.collect()) == rounded(literal.collect())


def test_corrected_views_count_each_row_once(built):
    n = built.accidents.count()
    summary = views.location_summary(built.accidents, built.traffic, built.location)
    assert summary.agg(F.sum("total_accidents")).first()[0] == n
    assert summary.filter("fatal_severe_pct > 100").isEmpty()
    hours = views.hourly_profile(built.accidents, built.traffic)
    assert hours.agg(F.sum("accident_count")).first()[0] == n
    assert hours.count() == 24


def test_shares_add_up(built):
    shares = views.severity_by_location(built.accidents, built.location).groupBy("location_name").agg(
        F.sum("pct_of_location_total").alias("s")
    )
    assert all(abs(r.s - 100) < 0.3 for r in shares.collect())


def test_presentation_order(built):
    rows = views.ordered("vw_severity_by_location", views.severity_by_location(built.accidents, built.location)).take(4)
    assert [r.accident_severity for r in rows] == ["Fatal", "Severe", "Moderate", "Minor"]
    risks = [r.avg_risk_score for r in views.ordered("vw_weather_risk", views.weather_risk(built.accidents, built.weather)).collect()]
    assert risks == sorted(risks, reverse=True)


def test_rating_uses_the_unrounded_average(spark):
    rows = [("at", 0.505), ("below", 0.5049), ("mixed", 0.5), ("mixed", 0.5101)]
    risk = spark.createDataFrame(rows, "location_name string, predicted_risk_prob double").selectExpr(
        "*", "1 AS predicted_class", "0 AS actual_fatal_severe", "'High Risk' AS risk_tier"
    )
    ratings = {r.location_name: r.safety_rating for r in views.ml_location_risk(risk).collect()}
    assert ratings == {"at": "Dangerous", "below": "Caution", "mixed": "Dangerous"}
