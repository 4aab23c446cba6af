"""Small helpers shared by the operators."""

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text):
    """A-Z in lower case, every other character as it is (``lower`` would change É as well)."""
    return F.translate(text, UPPER, UPPER.lower())


def saved(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage is cut and a lost executor
    costs no recomputation, as the files outlive it."""
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def located(docs: DataFrame, landing: str | None = None, **expressions: str) -> DataFrame:
    """``doc`` (all columns of ``docs``, whatever their names), ``at`` (file and row number) and SQL
    expressions over ``docs`` of every row.

    A frame that does not come straight from Parquet files is written to the shared folder first, or to
    ``landing``, so that a retried task finds every row at the same place.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    further = [F.expr(text).alias(name) for name, text in expressions.items()]

    def placed(rows: DataFrame) -> DataFrame:
        file = rows.metadataColumn("_metadata")  # also beside a column of that name
        at = F.struct(file.getField("file_path").alias("file"), file.getField("row_index").alias("row"))
        return rows.select(whole, at.alias("at"), *further)

    try:
        return placed(docs)
    except AnalysisException:
        return placed(saved(docs, "landed", landing))


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """SQL settings for the length of a block."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def columns_of(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(name)).to_pylist() for name in names]


def per_batch(
    rows: Callable[[pa.RecordBatch], dict[str, pa.Array | list]], schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` from one that gives the output columns of a batch."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = rows(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    c if isinstance(c, pa.Array) else pa.array(c, type=field.type)
                    for field, c in ((f, columns[f.name]) for f in schema)
                ],
                schema=schema,
            )

    return apply


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers where it is not on their path already.

    Workers take PYTHONPATH and the working folder over; a cluster job names the package in
    ``--py-files``. A session started elsewhere gets a zip of it, once.
    """
    root = Path(__file__).resolve().parents[2]
    reached = [Path.cwd(), *(Path(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p)]
    if any(p.resolve() == root for p in reached) or not root.is_dir() or getattr(spark.sparkContext, "_cityflow", False):
        return
    # the driver serves the file as long as it lives
    folder = tempfile.mkdtemp(prefix="cityflow-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/cityflow.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted((root / "cityflow").rglob("*.py")):
            archive.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(path)
    spark.sparkContext._cityflow = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
