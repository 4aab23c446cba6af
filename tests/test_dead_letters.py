"""Files that do not fit, batches that run again, maxima that follow, and alarms that change."""

import datetime as dt
import gzip
import time

import pandas as pd
import pytest

from cityflow.plans.features import sensor_features
from cityflow.schemas import CORRUPT, RAW_SENSOR
from cityflow.sources.files import read_csv
from cityflow.streaming import dead_letters, transitions

NAMES = RAW_SENSOR.fieldNames()


def csv(rows, names=NAMES):
    return ",".join(names) + "\n" + "".join(",".join(str(r[n]) for n in names) + "\n" for r in rows)


def reading(i, vehicles=100, speed=40):
    return dict(zip(NAMES, (f"s{i}", "Downtown", "2024-01-01 08:00:00", vehicles, speed, "Low")))


def drain(query):
    query.awaitTermination()


def test_good_files_arrive_once_and_bad_ones_are_listed_once(spark, tmp_path):
    root, out, checkpoint = tmp_path / "drop é", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    root.mkdir()
    (root / "sensor-1.csv").write_text(csv([reading(1), reading(1)]))
    (root / "sensor-2.csv").write_text("﻿" + csv([reading(2, 200)], NAMES[::-1]))
    (root / "sensor-3.csv").write_text(csv([reading(3, "many")], [*NAMES[3:], *NAMES[:3]]))
    (root / "sensor-lacks.csv").write_text(csv([reading(4)], NAMES[1:]))
    (root / "sensor-twice.csv").write_text(csv([reading(4)], [*NAMES, "Location"]))
    (root / "sensor-blank.csv").write_text("\n")
    (root / "sensor-torn.csv.gz").write_bytes(gzip.compress(csv([reading(i) for i in range(9000)]).encode())[:2000])
    (root / "sensor-fine.csv.gz").write_bytes(gzip.compress(csv([reading(5)]).encode()))
    (root / "other.csv").write_text("not,of,this,job\n")
    drain(dead_letters.ingest_sensor(spark, str(root), out, checkpoint, 3))
    (root / "sensor-late.csv").write_text(csv([reading(6, 400, 80)]))
    for _ in range(2):
        drain(dead_letters.ingest_sensor(spark, str(root), out, checkpoint, 3))
    rows = dead_letters.read_sensor(spark, out)
    assert sorted(r.Sensor_ID for r in rows.collect()) == ["s1", "s1", "s2", "s3", "s5", "s6"]
    assert rows.filter(f"{CORRUPT} IS NOT NULL").select("Sensor_ID").collect() == [("s3",)]
    bad = dead_letters.read_quarantine(spark, f"{out}/quarantine-sensor").collect()
    reasons = {r.path.rsplit("/", 1)[1]: r.reason for r in bad}
    assert len(bad) == 4 and reasons.pop("sensor-torn.csv.gz").startswith("unreadable")
    assert reasons == {
        "sensor-lacks.csv": "lacks Sensor_ID", "sensor-twice.csv": "repeats Location", "sensor-blank.csv": "no header",
    }
    # the index is that of all rows at once, though the largest volume came last
    paths = [str(root / f"sensor-{n}") for n in ("1.csv", "late.csv", "fine.csv.gz")]
    whole = {r.Sensor_ID: r.congestion_index for r in sensor_features(read_csv(spark, paths, RAW_SENSOR)).collect()}
    assert {r.Sensor_ID: r.congestion_index for r in rows.filter("Sensor_ID <> 's2' AND Sensor_ID <> 's3'").collect()} == whole


def test_a_batch_that_runs_again_replaces_its_rows(spark, tmp_path):
    """As after a failure between the rows and the stream's own record."""
    root, out = tmp_path / "drop", str(tmp_path / "out")
    root.mkdir()
    (root / "sensor-1.csv").write_text(csv([reading(1)]))
    (root / "sensor-2.csv").write_text("x\n")
    for run in range(2):
        drain(dead_letters.ingest_sensor(spark, str(root), out, str(tmp_path / f"checkpoint{run}")))
    assert dead_letters.read_sensor(spark, out).count() == 1
    assert dead_letters.read_quarantine(spark, f"{out}/quarantine-sensor").count() == 1
    assert dead_letters.maxima_so_far(spark, out).first() == (100, 40)


class State:
    """A group's state and clock, in place of the stream's."""

    def __init__(self):
        self.value, self.watermark, self.timer = None, 0, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def getCurrentWatermarkMs(self):
        return self.watermark * 1000

    def setTimeoutTimestamp(self, ms):
        assert ms > self.watermark * 1000 or ms == self.watermark * 1000 + 1
        self.timer = ms


@pytest.mark.parametrize("periods", [1, 2])
def test_changes_do_not_depend_on_the_batches(periods):
    """Any split of the rows into batches, timers included, gives the changes of the filled calendar."""
    import random

    rng = random.Random(periods)
    for _ in range(60):
        times = sorted(rng.sample(range(40), rng.randint(1, 12)))
        rows = [(300 * t + rng.randrange(300), rng.choice((0, 1))) for t in times for _ in range(rng.randint(1, 3))]
        rows.sort()
        end = 300 * (max(times) + 2)
        run, last, wanted = 0, None, []
        for at in range(300 * min(times), end, 300):
            total = sum(v for t, v in rows if at <= t < at + 300)
            run = run + 1 if total >= 1 else 0
            now = "ALARM" if run >= periods else "OK"
            if now != last:
                wanted.append((at, now))
            last = now
        state, step, found = State(), transitions.closing(300, 1, periods), []

        def feed(part):
            frame = pd.DataFrame([(t // 300 * 300, float(v)) for t, v in part], columns=["at", "total"])
            for changes in step(("a",), iter([frame]), state):
                found.extend((int(t.timestamp()), s) for t, s in zip(changes["changed_at"], changes["state"]))

        while rows:
            n = rng.randint(1, len(rows))
            feed(rows[:n])
            state.watermark = max(state.watermark, rows[n - 1][0] - 600)
            rows = rows[n:]
            if rng.random() < 0.5:
                feed([])
        state.watermark = end
        feed([])
        assert found == wanted


def test_a_stream_of_changes(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "ts timestamp, name string, failed int"

    def arrive(*rows):
        stamped = [(dt.datetime(2024, 1, 1, h, m), name, v) for h, m, name, v in rows]
        spark.createDataFrame(stamped, schema).coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)  # files are taken by age

    arrive((0, 0, "a", 1), (0, 4, "a", 0), (0, 5, "a", 0), (0, 10, "a", 2), (0, 1, "silent", 1))
    arrive((0, 20, "a", 0), (0, 12, "a", 0), (0, 31, "a", 5))
    arrive((3, 0, None, 0))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    changes = transitions.alarm_changes(stream, "ts", "name", "failed")
    drain(
        changes.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start()
    )
    found = [(r.alarm_name, r.changed_at.hour * 60 + r.changed_at.minute, r.state) for r in spark.read.parquet(out).collect()]
    assert sorted(found) == [
        ("a", 0, "ALARM"), ("a", 5, "OK"), ("a", 10, "ALARM"), ("a", 15, "OK"), ("a", 30, "ALARM"), ("a", 35, "OK"),
        ("silent", 0, "ALARM"), ("silent", 5, "OK"),
    ]
