"""A stored model meets rows that came after it."""

import pytest
from pyspark.ml import PipelineModel

from cityflow import fixed_values as V
from cityflow.operators import model_data, training
from cityflow.plans import jobs
from cityflow.plans.warehouse import open_tables
from test_jobs import HEADER, SENSOR, accident_text


def linear(n):
    return {name: c for name, c in training.candidates(n).items() if name == "Logistic Regression"}


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("scoring")
    (root / "s.csv").write_text(SENSOR)
    (root / "a.csv").write_text(accident_text(120))
    later = "".join(f"y{i},Downtown,2024-05-01 08:00:00,Car,{w},Dry,Minor,1,0,Low\n" for i, w in enumerate(("Ash", "Fog", "Zephyr")))
    (root / "later.csv").write_text(HEADER + later)
    jobs.sensor_job(spark, str(root / "s.csv"), str(root / "s"))
    for name in ("a", "later"):
        jobs.accident_job(spark, str(root / f"{name}.csv"), str(root / name))
    jobs.load_job(spark, str(root / "s"), str(root / "a"), str(root / "w"), check=False)
    jobs.severity_job(spark, str(root / "w"), str(root / "model"), str(root / "runs"), chosen=linear)
    jobs.append_job(spark, str(root / "s"), str(root / "later"), str(root / "w"), check=False)
    return root


def scores(spark, root):
    return {r.accident_id: r.predicted_risk_prob for r in open_tables(spark, str(root / "w"))["ml_accident_risk"].collect()}


def test_later_accidents_are_scored_once(spark, trained):
    before = scores(spark, trained)
    assert len(before) == 120
    assert jobs.score_job(spark, str(trained / "w"), str(trained / "model")) == 3
    assert jobs.score_job(spark, str(trained / "w"), str(trained / "model")) == 0
    after = scores(spark, trained)
    assert len(after) == 123 and {k: v for k, v in after.items() if k in before} == before
    # a condition that sorts before all others shifts nothing: all rows score as they did
    assert jobs.score_job(spark, str(trained / "w"), str(trained / "model"), again=True) == 123
    assert scores(spark, trained) == after and after["y0"] == after["y2"]
    tiers = spark.read.parquet(str(trained / "w" / "ml_risk_tiers"))
    assert tiers.agg({"count": "sum"}).first()[0] == 123


def test_codes_of_labels_the_model_does_not_know(spark, trained):
    model = training.load(str(trained / "model"))
    names = (*V.CATEGORICAL_FEATURES, "n")
    rows = [("Downtown", "Clear", "Dry", "Bus", 1), ("Downtown", "Ash", "Dry", "Car", 2), (None, None, "Wet", "Tram", 3)]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} {'int' if n == 'n' else 'string'}" for n in names))
    coded = PipelineModel(model.stages[:2]).transform(frame).orderBy("n").select(*V.CATEGORICAL_FEATURES).collect()
    assert [tuple(r) for r in coded] == [(0, 0, 0, 1), (0, 3, 0, 2), (3, 3, 2, 5)]
    fields = PipelineModel(model.stages[:2]).transform(frame).schema
    assert all(not fields[c].metadata for c in V.CATEGORICAL_FEATURES)


def test_a_stream_is_scored_as_a_table_is(spark, trained, tmp_path):
    tables = open_tables(spark, str(trained / "w"))
    rows = model_data.features(
        tables["fact_accident"], tables["dim_location"], tables["dim_vehicle"], tables["dim_weather"]
    ).selectExpr("*", "location_name AS zone")
    rows.write.parquet(str(tmp_path / "in"))
    model = training.load(str(trained / "model"))
    stream = training.score(model, spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    (
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    found = {r.accident_id: r.predicted_risk_prob for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found == {r.accident_id: r.predicted_risk_prob for r in training.score(model, rows).collect()} and len(found) == 123


def test_runs_are_told_apart(spark, trained, tmp_path):
    run = training.Trained("Logistic Regression", None, {"accuracy": 0.5, "f1_score": 0.5, "roc_auc": 0.5}, 0.5)
    first, second = (training.log_run(spark, run, 1, str(tmp_path)) for _ in range(2))
    rows = spark.read.parquet(str(tmp_path)).collect()
    assert {r.run_id for r in rows} == {first, second} and all(r.logged_at for r in rows)
