"""The whole pipeline on hand-written files."""

import pytest

from cityflow.operators import training
from cityflow.plans import jobs
from cityflow.plans.warehouse import open_tables, open_views

SENSOR = """Sensor_ID,Location,Date_Time,Vehicle_Count,Average_Speed,Congestion_Level
a1,Downtown,2024-01-01 08:00:00,494,20,High
a2,Highway,2024-01-01 23:00:00,100,79,Low
a3,Atlantis,2024-01-02 06:00:00,50,40,Low
"""
HEADER = (
    "Accident_ID,Location,Date_Time,Vehicle_Type,Weather_Condition,Road_Condition,Accident_Severity,"
    "Number_of_Vehicles,Casualties,Traffic_Density\n"
)


def accident_text(n=200):
    zones, kinds = ("Downtown", "Highway", "Suburbs"), ("Car", "Bus", "Bicycle", "Truck", "Motorcycle")
    rows = [
        f"x{i},{zones[i % 3]},2024-{1 + i % 7:02d}-{1 + i % 28:02d} {i % 24:02d}:00:00,{kinds[i % 5]},"
        f"{('Clear', 'Fog', 'Rain')[i % 3]},{('Dry', 'Icy')[i % 2]},{('Minor', 'Fatal')[i % 24 >= 12]},"
        f"{1 + i % 4},{i % 10},{('Low', 'Moderate', 'High')[i % 3]}"
        for i in range(n)
    ]
    return HEADER + "\n".join(rows) + "\n"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    (root / "sensor.csv").write_text(SENSOR)
    (root / "accident.csv").write_text(accident_text())
    assert jobs.sensor_job(spark, str(root / "sensor.csv"), str(root / "sensor")) == 3
    assert jobs.accident_job(spark, str(root / "accident.csv"), str(root / "accident")) == 200
    for _ in range(2):
        jobs.load_job(spark, str(root / "sensor"), str(root / "accident"), str(root / "warehouse"))
    return root


def test_loading_twice_equals_once(spark, lake):
    tables = open_tables(spark, str(lake / "warehouse"))
    assert tables["fact_accident"].count() == 200
    assert tables["fact_traffic"].count() == 2
    assert tables["fact_accident"].select("accident_pk").distinct().count() == 200
    rejects = spark.read.parquet(str(lake / "warehouse" / "reject_traffic")).collect()
    assert [(r.Sensor_ID, r.failed) for r in rejects] == [("a3", ["location_id"])]
    report = spark.read.parquet(str(lake / "warehouse" / "quality_report"))
    assert report.filter("broken > 0").isEmpty() and report.count() > 60


def test_keys_are_counted_on_request(spark, lake, tmp_path):
    jobs.load_job(spark, str(lake / "sensor"), str(lake / "accident"), str(tmp_path), numbered=True)
    keys = sorted(r.accident_pk for r in open_tables(spark, str(tmp_path))["fact_accident"].collect())
    assert keys == list(range(1, 201))


DIRTY = (
    HEADER
    + """x1,Downtown,2024-01-01 08:00:00,Car,Fog,Dry,Minor,1,0,Low
x2,Downtown,2024-01-01 09:00:00,Car,Fog,Dry,Fatal,1,0,Low
x2,Highway,2024-01-01 09:00:00,Bus,Fog,Dry,Fatal,2,1,Low
x3,Downtown,2024-01-01 08:00:00,Car,Fog,,,1,0,Low
x4,Downtown,2024-01-01 08:00:00,Car,Fog,Dry,Minor,many,0,Low
,Downtown,2024-01-01 08:00:00,Car,Fog,Dry,Minor,1,0,Low
x5,Downtown,soon,Car,Fog,Dry,Minor,1,0,Low
x6,Nowhere,2024-01-01 08:00:00,Rickshaw,Fog,Dry,Minor,1,0,Low
x7,Suburbs,2024-01-01 22:00:00,Car,Snow,Dry,Minor,1,0,
"""
)
DIRTY_SENSOR = """Location,Sensor_ID,Date_Time,Average_Speed,Vehicle_Count,Congestion_Level
Downtown,a1,2024-01-01 08:00:00,20,494,High
Downtown,a2,2024-01-01 08:00:00,20,many,High
Downtown,,2024-01-01 08:00:00,20,5,High
Highway,a4,2024-01-01 03:00:00,20,5,
"""


def test_rows_that_break_a_constraint_become_rejects(spark, tmp_path):
    (tmp_path / "sensor.csv").write_text(DIRTY_SENSOR)
    (tmp_path / "accident.csv").write_text(DIRTY)
    jobs.sensor_job(spark, str(tmp_path / "sensor.csv"), str(tmp_path / "s"))
    jobs.accident_job(spark, str(tmp_path / "accident.csv"), str(tmp_path / "a"))
    out = str(tmp_path / "w")
    jobs.load_job(spark, str(tmp_path / "s"), str(tmp_path / "a"), out)
    tables = open_tables(spark, out)
    assert [r.accident_id for r in tables["fact_accident"].collect()] == ["x1"]
    assert [r.sensor_id for r in tables["fact_traffic"].collect()] == ["a1"]
    failed = {}
    for r in spark.read.parquet(f"{out}/reject_accident").collect():
        failed.setdefault(r.Accident_ID, []).append(set(r.failed))
    assert failed["x2"] == [{"repeated accident_id"}] * 2
    assert {"road_condition", "accident_severity"} <= failed["x3"][0]
    assert {"number_of_vehicles", "malformed row"} <= failed["x4"][0]
    assert failed[None] == [{"accident_id"}]
    assert "date_id" in failed["x5"][0] and {"location_id", "vehicle_id"} <= failed["x6"][0]
    assert failed["x7"] == [{"traffic_density"}]
    readings = {r.Sensor_ID: set(r.failed) for r in spark.read.parquet(f"{out}/reject_traffic").collect()}
    assert {"vehicle_count", "congestion_index", "malformed row"} <= readings["a2"]
    assert readings[None] == {"sensor_id"} and readings["a4"] == {"congestion_level"}
    # hours that only rejected rows have are listed, as the date dimension has them
    hours = {r.hour: r.accident_count for r in open_views(spark, out)["vw_hourly_profile"].collect()}
    assert {8: 1, 9: 0, 22: 0, 3: 0}.items() <= hours.items()
    names = {r.view_name: r.row_count for r in spark.sql("SELECT * FROM vw_row_counts").collect()}
    assert names["vw_monthly_trend"] == 1
    assert spark.sql("SELECT * FROM vw_location_summary_fanout").count() == 1


def test_a_second_load_leaves_keys_as_they_are(spark, lake, tmp_path):
    out = str(tmp_path / "w")
    jobs.load_job(spark, str(lake / "sensor"), str(lake / "accident"), out)
    before = {r.accident_id: tuple(r) for r in open_tables(spark, out)["fact_accident"].collect()}
    more = HEADER + "y1,Highway,2024-03-03 03:00:00,Car,Ash,Dry,Minor,1,0,Low\nx7,Highway,2024-03-03 03:00:00,Car,Fog,Dry,Minor,1,0,Low\n"
    (tmp_path / "more.csv").write_text(more)
    jobs.accident_job(spark, str(tmp_path / "more.csv"), str(tmp_path / "more"))
    for _ in range(2):
        jobs.append_job(spark, str(lake / "sensor"), str(tmp_path / "more"), out)
    tables = open_tables(spark, out)
    after = {r.accident_id: tuple(r) for r in tables["fact_accident"].collect()}
    assert tables["fact_accident"].count() == 201 and tables["fact_traffic"].count() == 2
    assert {k: v for k, v in after.items() if k in before} == before
    weather = {r.weather_condition: r.weather_id for r in tables["dim_weather"].collect()}
    assert weather == {"Clear": 1, "Fog": 2, "Rain": 3, "Ash": 4}
    assert tables["dim_date"].count() == tables["dim_date"].select("date_id").distinct().count()


def test_views_answer_sql(spark, lake):
    open_views(spark, str(lake / "warehouse"))
    row = spark.sql("SELECT sum(total_accidents) AS n, sum(total_vehicles) AS v FROM vw_location_summary").first()
    assert (row.n, row.v) == (200, 594)
    assert spark.sql("SELECT * FROM vw_monthly_trend").count() == 7
    assert spark.sql("SELECT * FROM vw_hourly_profile").count() == 24


def test_severity_job_scores_every_accident(spark, lake):
    def chosen(n):
        picked = training.candidates(n)
        picked["Random Forest"].estimator.setNumTrees(3)
        picked["Gradient Boosting"].estimator.setMaxIter(2)
        return picked

    paths = [str(lake / name) for name in ("warehouse", "model", "runs")]
    comparison = jobs.severity_job(spark, *paths, chosen=chosen).collect()
    assert len(comparison) == 3 and sum(r.selected for r in comparison) == 1
    assert all(0 <= r.cv_f1_mean <= 1 for r in comparison)
    risk = open_tables(spark, str(lake / "warehouse"))["ml_accident_risk"]
    assert risk.count() == 200
    assert {r.location_name for r in risk.select("location_name").distinct().collect()} == {"Downtown", "Highway", "Suburbs"}
    zones = open_views(spark, str(lake / "warehouse"))["vw_ml_location_risk"]
    assert sum(r.total_accidents for r in zones.collect()) == 200
    assert spark.read.parquet(str(lake / "runs")).count() == 1
    published = {n: spark.read.parquet(str(lake / "warehouse" / n)) for n in (
        "ml_model_comparison", "ml_feature_importance", "ml_risk_tiers", "ml_class_balance",
    )}
    assert published["ml_model_comparison"].count() == 3 and published["ml_feature_importance"].count() == 13
    for name, column in (("ml_risk_tiers", "count"), ("ml_class_balance", "row_count")):
        assert published[name].agg({column: "sum"}).first()[0] == 200
