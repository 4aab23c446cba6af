"""Run a job: ``spark-submit`` or ``python -m cityflow JOB PATH ...``.

sensor RAW OUT                       raw sensor CSV to features
accident RAW OUT                     raw accident CSV to features
load SENSOR ACCIDENT WAREHOUSE       features to the star schema
append SENSOR ACCIDENT WAREHOUSE [BATCH]    further features into a stored star schema; a batch again replaces itself
severity WAREHOUSE MODEL RUNS        train, compare, score
score WAREHOUSE MODEL                score accidents loaded since with the stored model
ingest RAW OUT CHECKPOINT            new files, routed by name; files that do not fit are set aside
ingest RAW OUT CHECKPOINT MAX_VOLUME MAX_SPEED    the same with given maxima; a file that does not fit stops it
index OUT SENSOR                     ingested readings to features, with the maxima of all so far
sql WAREHOUSE TEXT                   query over the tables and views
"""

import sys

from cityflow.plans import jobs
from cityflow.plans.warehouse import open_views
from cityflow.session import build, clear_scratch
from cityflow.sources.files import write_replace
from cityflow.streaming import dead_letters
from cityflow.streaming.ingest import ingest_all


def main(arguments: list[str]) -> None:
    if len(arguments) < 3:
        raise SystemExit(__doc__)
    job, *paths = arguments
    spark = build(f"cityflow {job}")
    if job == "sensor":
        print(f"rows written: {jobs.sensor_job(spark, *paths)}")
    elif job == "accident":
        print(f"rows written: {jobs.accident_job(spark, *paths)}")
    elif job == "load":
        jobs.load_job(spark, *paths)
    elif job == "append":
        jobs.append_job(spark, *paths[:3], batch=paths[3] if len(paths) > 3 else None)
    elif job == "severity":
        jobs.severity_job(spark, *paths).show()
    elif job == "score":
        print(f"rows scored: {jobs.score_job(spark, *paths)}")
    elif job == "ingest" and len(paths) == 3:
        running = [dead_letters.ingest_sensor(spark, *paths), dead_letters.ingest_accident(spark, *paths)]
        for query in running:
            query.awaitTermination()
        for kind in ("sensor", "accident"):
            dead_letters.read_quarantine(spark, f"{paths[1]}/quarantine-{kind}").show(truncate=False)
    elif job == "ingest":
        raw, out, checkpoint, volume, speed = paths
        for query in ingest_all(spark, raw, out, checkpoint, (float(volume), float(speed))):
            query.awaitTermination()
    elif job == "index":
        write_replace(dead_letters.read_sensor(spark, paths[0]), paths[1])
    elif job == "sql":
        open_views(spark, paths[0])
        spark.sql(paths[1]).show(truncate=False)
    else:
        raise SystemExit(__doc__)
    clear_scratch(spark)


if __name__ == "__main__":
    main(sys.argv[1:])
