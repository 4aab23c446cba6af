"""Batches loaded again, out of order, by halves and under a name; what plans read of a stored warehouse."""

import re

import pytest

from cityflow.catalog import queries as Q
from cityflow.operators import star
from cityflow.plans import jobs, loads, views
from cityflow.plans.warehouse import open_audit, open_rejects, open_tables, open_views
from test_jobs import HEADER, SENSOR

READINGS = "Sensor_ID,Location,Date_Time,Vehicle_Count,Average_Speed,Congestion_Level\n"
TABLES = ("dim_date", "dim_weather", "fact_traffic", "fact_accident")


def accidents(*rows):
    return HEADER + "".join(f"{i},{zone},{day} 08:00:00,Car,{weather},Dry,Minor,1,{n},Low\n" for i, zone, day, weather, n in rows)


@pytest.fixture(scope="module")
def batches(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("batches")
    texts = {
        "one": (SENSOR, accidents(("x1", "Downtown", "2024-01-01", "Fog", 1), ("x2", "Highway", "2024-02-01", "Clear", 2))),
        "two": (
            READINGS + "a9,Highway,2024-03-01 08:00:00,7,30,Low\n" * 2 + "a9,Atlantis,2024-03-01 08:00:00,7,30,Low\n",
            accidents(
                ("x2", "Highway", "2024-02-01", "Clear", 2), ("x3", "Suburbs", "2024-03-02", "Ash", 3),
                ("x4", "Suburbs", "2024-03-02", "Ash", 3), ("x4", "Suburbs", "2024-03-02", "Ash", 4),
            ),
        ),
        "three": (READINGS + "b1,Downtown,2024-03-05 08:00:00,9,30,Low\n", accidents(("x5", "Downtown", "2024-03-05", "Hail", 1))),
    }
    paths = {}
    for name, (sensor, accident) in texts.items():
        (root / f"{name}-s.csv").write_text(sensor)
        (root / f"{name}-a.csv").write_text(accident)
        paths[name] = str(root / f"{name}-s"), str(root / f"{name}-a")
        jobs.sensor_job(spark, f"{paths[name][0]}.csv", paths[name][0])
        jobs.accident_job(spark, f"{paths[name][1]}.csv", paths[name][1])
    return paths


def state(spark, path):
    """All rows to be seen, as readers see them."""
    rows = {name: sorted(map(str, df.collect())) for name, df in open_tables(spark, path).items() if name in TABLES}
    for name in ("reject_traffic", "reject_accident"):
        rows[name] = sorted(str(r) for r in open_rejects(spark, path, name).drop("load_id").collect())
    rows["audit"] = sorted(str(r) for r in open_audit(spark, path).drop("load_id").collect())
    return rows


@pytest.fixture(scope="module")
def warehouse(spark, batches, tmp_path_factory):
    """Two batches. Appending to an empty warehouse is a load."""
    out = str(tmp_path_factory.mktemp("warehouse"))
    jobs.append_job(spark, *batches["one"], out, check=False)
    jobs.append_job(spark, *batches["two"], out, check=False)
    return out


def test_two_batches(spark, warehouse):
    tables = open_tables(spark, warehouse)
    assert tables["fact_traffic"].filter("sensor_id = 'a9'").count() == 2
    assert {r.accident_id for r in tables["fact_accident"].collect()} == {"x1", "x2", "x3"}
    failed = sorted((r.Accident_ID, *r.failed) for r in open_rejects(spark, warehouse, "reject_accident").collect())
    assert failed == [("x2", "stored accident_id"), ("x4", "repeated accident_id"), ("x4", "repeated accident_id")]
    for fact, pk in (("fact_traffic", "traffic_pk"), ("fact_accident", "accident_pk")):
        assert tables[fact].count() == tables[fact].select(pk).distinct().count()
    counted = {}
    for r in open_audit(spark, warehouse).collect():
        counted[r.table_name, r.measure] = counted.get((r.table_name, r.measure), 0) + r.row_count
    assert counted["fact_traffic", "rows read"] == 6 and counted["fact_traffic", "location_id"] == 2
    assert counted["fact_accident", "rows rejected"] == 3 and counted["fact_accident", "stored accident_id"] == 1
    assert counted["fact_accident", "repeated accident_id"] == 2 and counted["fact_accident", "casualties"] == 0


def test_a_month_is_all_that_is_read(spark, warehouse):
    tables = open_tables(spark, warehouse)
    open_views(spark, warehouse)
    rows = spark.sql("SELECT * FROM vw_monthly_trend WHERE year = 2024 AND month = 3")
    assert rows.count() == 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"FileScan parquet [^\n]*PartitionFilters: \[[^]]*month_start", plan)
    joined = spark.sql(
        "SELECT count(*) FROM fact_accident f JOIN dim_date d ON f.date_id = d.date_id AND f.month_start = d.month_start "
        "WHERE d.month = 3"
    )
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.first()[0] == tables["fact_accident"].filter("month(month_start) = 3").count() == 1


def test_views_of_cells_equal_views_of_facts(spark, warehouse):
    tables = open_tables(spark, warehouse)
    others = [tables[name] for name in ("dim_location", "dim_weather", "ml_accident_risk", "dim_date")]
    facts = views.all_views(tables["fact_accident"], tables["fact_traffic"], *others)
    merged = open_views(spark, warehouse)
    for name, view in facts.items():
        assert merged[name].dtypes == view.dtypes, name
        assert sorted(map(str, merged[name].collect())) == sorted(map(str, view.collect())), name
    plan = merged["vw_monthly_trend"]._jdf.queryExecution().executedPlan().toString()
    assert "cells_accident" in plan and "fact_accident" not in plan
    counts = {name: view.count() for name, view in facts.items()}
    assert {r.view_name: r.row_count for r in spark.sql("SELECT * FROM vw_row_counts").collect()} == counts


def test_a_batch_again_or_a_load_that_fails_changes_nothing(spark, batches, warehouse, monkeypatch):
    once = state(spark, warehouse)
    jobs.append_job(spark, *batches["two"], warehouse, check=False)
    assert state(spark, warehouse) == once

    def broken_write(df, path, by=(), write=jobs.write_replace):
        if "/reject_accident/" in path:
            raise OSError("lost")
        write(df, path, by)

    def broken_commit(*_):
        raise OSError("lost")

    for owner, name, broken in ((jobs, "write_replace", broken_write), (loads, "commit", broken_commit)):
        with monkeypatch.context() as m:
            m.setattr(owner, name, broken)
            with pytest.raises(OSError):
                jobs.append_job(spark, *batches["three"], warehouse, check=False)
        assert state(spark, warehouse) == once
    loads.clean(spark, warehouse)
    assert state(spark, warehouse) == once
    kept = {load.load_id for load in loads.visible(spark, warehouse)}
    left = spark.read.parquet(f"{warehouse}/fact_traffic").select("load_id").distinct().collect()
    assert {r.load_id for r in left} == {k for k in kept if k.startswith("traffic")}


def test_a_named_batch_may_change(spark, batches, warehouse):
    before = open_tables(spark, warehouse)
    weather = {r.weather_condition: r.weather_id for r in before["dim_weather"].collect()}
    jobs.append_job(spark, *batches["three"], warehouse, batch="tuesday", check=False)
    tables = open_tables(spark, warehouse)
    assert {r.accident_id for r in tables["fact_accident"].collect()} == {"x1", "x2", "x3", "x5"}
    assert {r.weather_condition: r.weather_id for r in tables["dim_weather"].collect()} == {**weather, "Hail": 4}
    jobs.append_job(spark, batches["three"][0], batches["one"][1], warehouse, batch="tuesday")
    tables = open_tables(spark, warehouse)
    assert {r.accident_id for r in tables["fact_accident"].collect()} == {"x1", "x2", "x3"}
    assert tables["fact_traffic"].filter("sensor_id = 'b1'").count() == 1
    failed = open_rejects(spark, warehouse, "reject_accident").filter("failed = array('stored accident_id')")
    assert sorted(r.Accident_ID for r in failed.collect()) == ["x1", "x2", "x2"]
    assert {r.weather_condition: r.weather_id for r in tables["dim_weather"].collect()} == {**weather, "Hail": 4}
    assert tables["dim_date"].count() == tables["dim_date"].select("date_id").distinct().count() == 7
    report = spark.read.parquet(f"{warehouse}/quality_report")
    assert report.filter("broken > 0").isEmpty()
    assert {("fact_traffic", "traffic_pk"), ("fact_accident", "accident_pk")} <= {
        (r.table_name, r.column_name) for r in report.filter("constraint_name = 'unique'").collect()
    }


def test_batches_are_known_by_their_contents(spark):
    one = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "v int, s string")
    assert loads.batch_of(one) == loads.batch_of(one.repartition(3).select("s", "v"))
    others = [one.distinct(), one.limit(0), one.selectExpr("v + 1 AS v", "s")]
    assert len({loads.batch_of(df) for df in [one, *others]}) == 4


def scans(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan, [set(re.findall(r"(\w+)#", columns)) for columns in re.findall(r"FileScan parquet \[([^]]*)\]", plan)]


def test_views_read_their_own_columns(spark, sf_dir):
    plan, read = scans(Q.QUERIES["vw7_road_condition_risk"](spark, sf_dir))
    assert "Join" not in plan and len(read) == 1 and len(read[0]) <= 10
    assert not read[0] & {"location_id", "weather_id", "vehicle_id", "accident_id"}
    plan, read = scans(Q.QUERIES["vw4_congestion_hotspots"](spark, sf_dir))
    assert len(re.findall(r"\w*Join \[", plan)) == 1 and not any(columns & {"sensor_id", "weather_id"} for columns in read)


def test_row_counts_read_each_fact_once(spark, sf_dir):
    plan, read = scans(Q.QUERIES["vw9_row_counts"](spark, sf_dir))
    assert sum("road_condition" in columns for columns in read) == 1  # accidents
    assert sum({"location_id", "date_id"} <= columns for columns in read) == 2  # and readings
    assert Q.stored_star(spark, sf_dir).accidents.columns[-1] == star.MONTH
