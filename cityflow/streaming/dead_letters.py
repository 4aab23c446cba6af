"""New-file ingest by whole files: columns by name per file, files that do not fit set aside, maxima kept.

The stream is one of file names. A batch takes the new files that are routed to the job, reads the
first line of each, and puts files with equal headers together; their columns are found by name. A file that
lacks a column, has no header or cannot be read is listed in the quarantine with the reason, and the stream
goes on. A batch writes folders of its own, so a batch that is run again after a failure replaces
what it wrote: rows arrive once and a bad file is listed once.

The congestion index refers to the largest volume and speed of all data, which a stream cannot know ahead.
Measures are therefore stored as they are, with each batch's maxima in a small table beside them, and the
index is computed when the rows are read (:func:`read_sensor`).
"""

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cityflow.functions import kpi
from cityflow.plans.features import accident_features, sensor_measures
from cityflow.schemas import QUARANTINE, RAW_ACCIDENT, RAW_SENSOR
from cityflow.session import first_line
from cityflow.sources.files import read_csv, read_parquet, write_replace
from cityflow.streaming.ingest import object_key, routed_to

# the condition under which Spark reports a file that cannot be read, whatever the reason
_UNREADABLE = "FAILED_READ_FILE"

Writer = Callable[[DataFrame, str], None]


def new_files(spark: SparkSession, root: str, word: str, files_per_batch: int = 1000) -> DataFrame:
    """An unbounded frame of the addresses of all files routed by ``word``; no content is read."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
    )
    return files.select("path").filter(routed_to(object_key("path", root), word))


def by_header(spark: SparkSession, paths: Sequence[str], wanted: Sequence[str]) -> tuple[dict[str, list[str]], list[tuple]]:
    """Files by their header line, and (path, reason, header) of those that lack one of the columns.

    The driver reads one line of each file of a batch, as it lists them.
    """
    fitting: dict[str, list[str]] = {}
    bad = []
    for path in paths:
        try:
            header = first_line(spark, path)
        except Exception as error:  # whatever the store or the codec says
            bad.append((path, f"unreadable: {type(error).__name__}", None))
            continue
        names = [n.strip().strip('"') for n in header.lstrip("﻿").split(",")]
        lacking = [n for n in wanted if n not in names]
        twice = [n for n in wanted if names.count(n) > 1]
        if not header.strip():
            bad.append((path, "no header", header))
        elif lacking or twice:
            bad.append((path, f"lacks {', '.join(lacking)}" if lacking else f"repeats {', '.join(twice)}", header[:1000]))
        else:
            fitting.setdefault(header, []).append(path)
    return fitting, bad


def ingest_files(
    spark: SparkSession,
    root: str,
    word: str,
    schema: T.StructType,
    write: Writer,
    out: str,
    quarantine: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Process the files that are new since the last run, then stop.

    ``write`` stores the rows of files with one header under a folder; it may be called again for the same
    folder and then replaces it. Where a group cannot be read, its files are tried one by one.
    """

    def store(paths: list[str], folder: str) -> list[tuple]:
        try:
            write(read_csv(spark, paths, schema), folder)
            return []
        except (PySparkException, Py4JJavaError) as error:
            if _UNREADABLE not in str(error):
                raise  # not the files' fault
            if len(paths) == 1:
                return [(paths[0], "unreadable content", None)]
        return [bad for k, path in enumerate(paths) for bad in store([path], f"{folder}-{k}")]

    def batch(files: DataFrame, number: int) -> None:
        paths = sorted(r["path"] for r in files.select("path").distinct().collect())  # files_per_batch at most
        fitting, bad = by_header(spark, paths, schema.fieldNames())
        for k, header in enumerate(sorted(fitting)):
            bad += store(fitting[header], f"{out}/batch_id={number}/part={k}")
        if bad:
            listed = spark.createDataFrame(sorted(bad, key=lambda b: b[0]), "path string, reason string, header string")
            write_replace(listed.coalesce(1), f"{quarantine}/batch_id={number}")

    query = new_files(spark, root, word, files_per_batch).writeStream.foreachBatch(batch)
    return query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_ingested(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    return read_parquet(spark, out, schema, recursive=True)


def read_quarantine(spark: SparkSession, quarantine: str) -> DataFrame:
    """path, reason, header and batch of the files set aside."""
    return read_parquet(spark, quarantine, QUARANTINE)


# ---------------------------------------------------------------- the two jobs


def _with_maxima(out: str) -> Writer:
    """Store measures, and the maxima of the same rows beside them."""

    def write(rows: DataFrame, folder: str) -> None:
        write_replace(sensor_measures(rows), f"{folder}/rows")
        stored = rows.sparkSession.read.parquet(f"{folder}/rows")
        write_replace(kpi.maxima_of(stored).coalesce(1), folder.replace(out, f"{out}-maxima", 1))

    return write


def ingest_sensor(spark: SparkSession, root: str, out: str, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    folder = f"{out}/sensor"
    return ingest_files(
        spark, root, "sensor", RAW_SENSOR, _with_maxima(folder), folder, f"{out}/quarantine-sensor", f"{checkpoint}/sensor-files", files_per_batch
    )


def ingest_accident(spark: SparkSession, root: str, out: str, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    def write(rows: DataFrame, folder: str) -> None:
        write_replace(accident_features(rows), folder)

    return ingest_files(
        spark, root, "accident", RAW_ACCIDENT, write, f"{out}/accident", f"{out}/quarantine-accident", f"{checkpoint}/accident-files", files_per_batch
    )


def maxima_so_far(spark: SparkSession, out: str) -> DataFrame:
    """One row: the largest volume and speed of all batches, from a row per batch and header."""
    rows = read_parquet(spark, f"{out}/sensor-maxima", T.StructType([T.StructField(c, T.IntegerType()) for c in ("max_volume", "max_speed")]), recursive=True)
    return rows.selectExpr("max(max_volume) AS max_volume", "max(max_speed) AS max_speed")


def read_sensor(spark: SparkSession, out: str) -> DataFrame:
    """The ingested readings with the index that the maxima so far give: whatever the batches were, as if
    all rows had come in one."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(f"{out}/sensor")
    return kpi.with_congestion_index(rows, maxima=maxima_so_far(spark, out))
