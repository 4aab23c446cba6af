"""New-file ingest: every file is read once and routed by the words in its key."""

import re
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cityflow import fixed_values as V
from cityflow.functions.text import literal
from cityflow.plans.features import accident_features, sensor_features
from cityflow.schemas import CORRUPT, RAW_ACCIDENT, RAW_SENSOR
from cityflow.sources.files import csv_schema


def object_key(path: str, root: str) -> str:
    """The part of a file's address below the watched folder; names above it route nothing.

    Addresses are percent-encoded, plain folder names are not, so both are decoded.
    """
    plain = re.sub(r"^[A-Za-z0-9]+:/*", "", root)
    folder = (plain if plain == root else unquote(plain)).strip("/") + "/"
    path = f"coalesce(try_url_decode(replace({path}, '+', '%2B')), {path})"
    below = f"locate({literal(folder)}, {path})"
    return f"IF({below} > 0, substr({path}, {below} + {len(folder)}), {path})"


def routed_to(key: str, word: str) -> str:
    return f"contains(lower({key}), {literal(word)})"


def routes_of(key: str, words: Sequence[str] = V.ROUTES) -> str:
    """Every route a key takes: one, several or none."""
    taken = ", ".join(f"IF({routed_to(key, w)}, {literal(w)}, NULL)" for w in words)
    return f"array_compact(array({taken}))"


def new_rows(
    spark: SparkSession, root: str, word: str, schema: T.StructType, files_per_batch: int = 1000
) -> DataFrame:
    """An unbounded frame of the rows of all files routed by ``word``.

    The filter is on the file's address alone, so Spark skips the other files unread. A backlog is
    worked off in batches of at most ``files_per_batch`` files, each committed on its own. A file whose
    header has other names or another order than the schema fails the batch.
    """
    rows = (
        spark.readStream.schema(csv_schema(schema))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(root)
    )
    return rows.filter(routed_to(object_key("_metadata.file_path", root), word))


def ingest(
    spark: SparkSession,
    root: str,
    word: str,
    schema: T.StructType,
    transform: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Process the files that are new since the last run, then stop.

    The checkpoint and the file sink's log make it exactly once, also after a failure.
    """
    return (
        transform(new_rows(spark, root, word, schema, files_per_batch))
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def sensor_kpis(rows: DataFrame, maxima: DataFrame | tuple[float, float]) -> DataFrame:
    """Sensor features of an unbounded frame.

    A running maximum would change rows already written, so the maxima are given: constants, or a
    one-row frame kept from a calibration run.
    """
    return sensor_features(rows, maxima=maxima)


def ingest_all(
    spark: SparkSession,
    root: str,
    out: str,
    checkpoint: str,
    maxima: DataFrame | tuple[float, float],
    files_per_batch: int = 1000,
) -> list[StreamingQuery]:
    """The sensor and the accident job over one folder; a key with both words feeds both."""
    return [
        ingest(
            spark, root, "sensor", RAW_SENSOR, lambda rows: sensor_kpis(rows, maxima),
            f"{out}/sensor", f"{checkpoint}/sensor", files_per_batch,
        ),
        ingest(
            spark, root, "accident", RAW_ACCIDENT, accident_features,
            f"{out}/accident", f"{checkpoint}/accident", files_per_batch,
        ),
    ]
