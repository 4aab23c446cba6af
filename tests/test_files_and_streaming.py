import datetime as dt

import pytest
from pyspark.sql import types as T

from cityflow import session
from cityflow.schemas import CORRUPT, RAW_SENSOR
from cityflow.sources import files
from cityflow.streaming import alarms, ingest

SENSOR_CSV = "Sensor_ID,Location,Date_Time,Vehicle_Count,Average_Speed,Congestion_Level\n"
ACCIDENT_CSV = (
    "Accident_ID,Location,Date_Time,Vehicle_Type,Weather_Condition,Road_Condition,Accident_Severity,"
    "Number_of_Vehicles,Casualties,Traffic_Density\n"
)


def test_csv_is_typed_and_keeps_malformed_rows(spark, tmp_path):
    path = tmp_path / "sensor.csv"
    path.write_text(SENSOR_CSV + "001234,Downtown,2024-01-01 00:00:00,90,59,High\nab,Highway,2024-01-01 01:00:00,many,73,Low\n")
    rows = files.read_csv(spark, str(path), RAW_SENSOR).orderBy("Sensor_ID").collect()
    assert rows[0].Sensor_ID == "001234" and rows[0].Vehicle_Count == 90 and rows[0][CORRUPT] is None
    assert rows[1].Vehicle_Count is None and "many" in rows[1][CORRUPT]


def test_missing_prefix_is_an_empty_frame(spark, tmp_path):
    frame = files.read_parquet(spark, str(tmp_path / "none"), RAW_SENSOR)
    assert frame.count() == 0 and frame.columns == RAW_SENSOR.fieldNames()


def test_nested_files_under_a_prefix(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType())])
    spark.range(3).write.parquet(str(tmp_path / "p" / "a"))
    spark.range(4).write.parquet(str(tmp_path / "p" / "b" / "c"))
    assert files.read_parquet(spark, str(tmp_path / "p"), schema, recursive=True).count() == 7


def test_replace_and_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(10).selectExpr("id", "id % 2 AS part")
    for _ in range(2):
        files.write_replace(frame, path, partition_by=["part"])
    assert spark.read.parquet(path).count() == 10
    assert (tmp_path / "t" / "part=1").is_dir()


def test_append_twice_equals_once(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_replace(spark.range(5), path)
    for _ in range(2):
        files.write_append(files.append_new(spark.range(3, 9), spark.read.parquet(path), "id"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(9))


def test_rows_are_counted_on_the_way(spark, tmp_path):
    counted, observation = files.observed(spark.range(7), "n")
    files.write_replace(counted, str(tmp_path / "t"))
    assert observation.get["row_count"] == 7


def test_scratch_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = session.scratch_path(spark, "a"), session.scratch_path(spark, "a")
    assert first.startswith(shared) and first != second


@pytest.mark.parametrize(
    "key,routes",
    [
        ("raw/Road_SENSOR_data.csv", ["sensor"]), ("raw/accident.csv", ["accident"]),
        ("raw/sensor_ACCIDENT.csv", ["sensor", "accident"]), ("raw/notes.csv", []), ("sensor/notes.csv", ["sensor"]),
    ],
)
def test_routes(spark, key, routes):
    frame = spark.createDataFrame([(key,)], "k string")
    assert frame.selectExpr(ingest.routes_of("k")).first()[0] == routes


@pytest.mark.parametrize(
    "path,root,key",
    [
        ("file:///data/accidents/raw/a.csv", "/data/accidents/raw", "a.csv"),
        ("s3://bucket/raw/x/b.csv", "s3://bucket/raw/", "x/b.csv"),
        ("s3://other/raw/b.csv", "s3://bucket/raw", "s3://other/raw/b.csv"),
    ],
)
def test_object_key_is_below_the_watched_folder(spark, path, root, key):
    frame = spark.createDataFrame([(path,)], "p string")
    assert frame.selectExpr(ingest.object_key("p", root)).first()[0] == key


def test_ingest_takes_each_file_once(spark, tmp_path):
    root = tmp_path / "accident-lake" / "raw"
    root.mkdir(parents=True)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        for job in ingest.ingest_all(spark, str(root), out, checkpoint, (494, 79)):
            job.awaitTermination()

    sensor_row = "a1,Downtown,2024-01-01 08:00:00,494,79,High\n"
    (root / "Sensor_1.csv").write_text(SENSOR_CSV + sensor_row)
    (root / "notes.csv").write_text("Some text\nof no job\n")
    run()
    sensors = spark.read.parquet(f"{out}/sensor").collect()
    assert [(r.Sensor_ID, r.congestion_index, r.time_of_day) for r in sensors] == [("a1", 0.6, "Morning Peak")]
    (root / "sensor_2.csv").write_text(SENSOR_CSV + sensor_row.replace("a1", "a2"))
    (root / "accident.csv").write_text(
        ACCIDENT_CSV + "x1,Downtown,2024-01-01 08:00:00,Car,Fog,Icy,Fatal,4,9,Low\n"
    )
    run()
    run()
    assert sorted(r.Sensor_ID for r in spark.read.parquet(f"{out}/sensor").collect()) == ["a1", "a2"]
    assert [r.risk_score for r in spark.read.parquet(f"{out}/accident").collect()] == [38.3663]


def metric_rows(spark, pairs):
    rows = [(dt.datetime(2024, 1, 1, h, m), "job", v) for h, m, v in pairs]
    return spark.createDataFrame(rows, "ts timestamp, name string, failed int")


def test_alarm_threshold_and_period(spark):
    frame = metric_rows(spark, [(0, 0, 1), (0, 4, 0), (0, 5, 0), (0, 10, 2)])
    states = alarms.alarm(frame, "ts", "name", "failed").orderBy("period_start").collect()
    assert [(s.total, s.state) for s in states] == [(1, "ALARM"), (0, "OK"), (2, "ALARM")]
    strict = alarms.alarm(frame, "ts", "name", "failed", threshold=2).orderBy("period_start").collect()
    assert [s.state for s in strict] == ["OK", "OK", "ALARM"]


def test_gaps_are_ok_and_break_a_run(spark):
    frame = metric_rows(spark, [(0, 0, 1), (0, 5, 1), (0, 15, 1), (0, 20, 1), (0, 25, 1)])
    states = alarms.alarm(frame, "ts", "name", "failed")
    one = [s.state for s in alarms.alarm_filled(states).orderBy("period_start").collect()]
    assert one == ["ALARM", "ALARM", "OK", "ALARM", "ALARM", "ALARM"]
    two = [s.state for s in alarms.alarm_filled(states, 2).orderBy("period_start").collect()]
    assert two == ["OK", "ALARM", "OK", "OK", "ALARM", "ALARM"]


def test_filled_periods_cross_days(spark):
    rows = [(dt.datetime(2024, 1, 1, 23, 50), "job", 1), (dt.datetime(2024, 1, 4, 0, 10), "job", 1)]
    frame = spark.createDataFrame(rows, "ts timestamp, name string, failed int")
    filled = alarms.alarm_filled(alarms.alarm(frame, "ts", "name", "failed"))
    expected = (dt.datetime(2024, 1, 4, 0, 10) - dt.datetime(2024, 1, 1, 23, 50)) // dt.timedelta(minutes=5) + 1
    assert filled.count() == expected == filled.select("period_start").distinct().count()


def test_status_lists_the_latest_state(spark):
    frame = metric_rows(spark, [(0, 0, 1), (0, 10, 0)])
    states = alarms.alarm(frame, "ts", "name", "failed")
    assert [tuple(r) for r in alarms.alarm_status(states, "jo").collect()] == [("job", "OK")]
    assert alarms.alarm_status(states, "other").isEmpty()


def test_stream_equals_batch_for_closed_periods(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    frame = metric_rows(spark, [(h, m, int((h + m) % 3 == 0)) for h in range(3) for m in range(0, 60, 2)])
    frame.write.parquet(source)
    stream = alarms.alarm_stream(spark.readStream.schema(frame.schema).parquet(source), "ts", "name", "failed")
    (
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    closed = alarms.alarm(frame, "ts", "name", "failed").filter("period_end <= timestamp'2024-01-01 02:48:00'")
    got = spark.read.parquet(out)
    assert got.count() == closed.count() > 0
    assert got.exceptAll(closed).isEmpty()


def test_silent_alarms_do_not_stay(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0), "silent", 1), (dt.datetime(2024, 1, 1, 3, 0), "other", 1)]
    frame = spark.createDataFrame(rows, "ts timestamp, name string, failed int")
    states = alarms.alarm(frame, "ts", "name", "failed")
    assert {tuple(r) for r in alarms.alarm_status(states).collect()} == {("silent", "OK"), ("other", "ALARM")}
    assert [tuple(r) for r in alarms.alarm_status(states, "silent").collect()] == [("silent", "OK")]
    filled = alarms.alarm_filled(states)
    assert filled.filter("alarm_name = 'silent'").count() == 37
    at_first = alarms.alarm_status(states, as_of="2024-01-01 00:04:00")
    assert [tuple(r) for r in at_first.collect()] == [("silent", "ALARM")]
    later = alarms.alarm_status(states, as_of="2024-01-01 09:00:00")
    assert {r.state for r in later.collect()} == {"OK"}
    last = alarms.alarm_filled(states, as_of="2024-01-01 04:00:00").groupBy("alarm_name").agg({"period_start": "max"})
    assert {r[1] for r in last.collect()} == {dt.datetime(2024, 1, 1, 4, 0)}


def test_csv_columns_are_found_by_name(spark, tmp_path):
    from cityflow.schemas import CORRUPT, RAW_SENSOR
    from cityflow.sources import files

    (tmp_path / "a.csv").write_text(
        "Congestion_Level,Extra,Average_Speed,Sensor_ID,Vehicle_Count,Location,Date_Time\nHigh,e,20,s,7,Downtown,2024-01-01 08:00:00\n"
        "Low,e,fast,t,8,Highway,2024-01-01 08:00:00\n"
    )
    rows = files.read_csv(spark, str(tmp_path / "a.csv"), RAW_SENSOR).collect()
    assert [tuple(r)[:6] for r in rows] == [
        ("s", "Downtown", "2024-01-01 08:00:00", 7, 20, "High"), ("t", "Highway", "2024-01-01 08:00:00", 8, None, "Low"),
    ]
    assert rows[0][CORRUPT] is None and "fast" in rows[1][CORRUPT]
    (tmp_path / "b.csv").write_text("Sensor_ID,Location\ns,Downtown\n")
    with pytest.raises(ValueError, match="Vehicle_Count"):
        files.read_csv(spark, str(tmp_path / "b.csv"), RAW_SENSOR)


def test_a_stream_refuses_another_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "sensor.csv").write_text("Location,Sensor_ID,Date_Time,Vehicle_Count,Average_Speed,Congestion_Level\nx,y,z,1,2,w\n")
    from cityflow.schemas import RAW_SENSOR

    job = ingest.ingest(spark, str(folder), "sensor", RAW_SENSOR, lambda r: r, str(tmp_path / "o"), str(tmp_path / "c"))
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        job.awaitTermination()


def test_routing_below_a_folder_with_a_space(spark, tmp_path):
    folder = tmp_path / "sensor drop é"
    folder.mkdir()
    (folder / "accident_1.csv").write_text("a\n1\n")
    frame = spark.read.text(str(folder)).selectExpr("_metadata.file_path AS p")
    key = ingest.object_key("p", str(folder))
    assert [r.k for r in frame.selectExpr(f"{key} AS k").distinct().collect()] == ["accident_1.csv"]


def test_scratch_is_cleared(spark, monkeypatch):
    monkeypatch.setattr(session, "_made", [])
    path = session.scratch_path(spark, "gone")
    files.stored(spark.range(3), path)
    session.clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_append_leaves_out_repeats_and_rows_without_key(spark):
    from cityflow.sources import files

    batch = spark.createDataFrame([(1, "b"), (1, "a"), (None, "x"), (2, "c"), (3, None)], "k int, v string")
    existing = spark.createDataFrame([(2, "old")], "k int, v string")
    assert {tuple(r) for r in files.append_new(batch, existing, "k").collect()} == {(1, "a"), (3, None)}
    assert [tuple(r) for r in files.without_key(batch, "k").collect()] == [(None, "x")]
