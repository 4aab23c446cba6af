"""Which rows of the warehouse are to be seen: loads, their batches, and the list that commits them.

Every load of a batch writes its rows into folders of its own, ``TABLE/load_id=.../``, and becomes visible
by one row of the table ``loads`` that is written last. Until then, and after a failure between two
tables, readers see the warehouse as it was. Loading a batch again writes a new load that takes the place
of the batch's earlier one in all tables alike. A batch is known by its contents unless it is given a name.
"""

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.schemas import LOADS
from cityflow.session import children, delete
from cityflow.sources.files import read_parquet, write_append

LOAD = "load_id"
VERSIONED = (
    "dim_weather", "dim_date", "fact_traffic", "fact_accident", "reject_traffic", "reject_accident", "load_audit",
    "cells_traffic", "cells_accident",
)


@dataclass(frozen=True)
class Load:
    """A load: of which batch of which source, and the largest key it gave. ``whole`` ones hide all earlier ones."""

    version: int
    load_id: str
    source: str
    batch_id: str
    whole: bool
    last_key: int


def new_load(source: str, batch_id: str, whole: bool) -> Load:
    return Load(0, f"{source}-{uuid.uuid4().hex}", source, batch_id, whole, 0)


def batch_of(rows: DataFrame) -> str:
    """A name for the rows' contents, whatever their order and files: their number, and the sum and
    exclusive or of their hashes."""
    hashed = rows.selectExpr(f"xxhash64({', '.join(f'`{c}`' for c in sorted(rows.columns))}) AS h")
    n, total, mixed = hashed.agg(
        F.count("*"), F.expr("coalesce(sum(CAST(h AS DECIMAL(38,0))), 0)"), F.expr("coalesce(bit_xor(h), 0L)")
    ).first()
    return f"{n}-{int(total) % 2**64:016x}{mixed % 2**64:016x}"


def visible(spark: SparkSession, path: str) -> list[Load]:
    """The latest load of every batch since the last whole one, by version."""
    rows = [Load(**r.asDict()) for r in read_parquet(spark, f"{path}/loads", LOADS).collect()]
    since = max((r.version for r in rows if r.whole), default=0)
    latest = {}
    for row in sorted((r for r in rows if r.version >= since), key=lambda r: r.version):
        latest[row.source, row.batch_id] = row
    return sorted(latest.values(), key=lambda r: (r.version, r.load_id))


def commit(spark: SparkSession, path: str, made: list[Load]) -> None:
    """Make loads visible together, by one file."""
    rows = read_parquet(spark, f"{path}/loads", LOADS)
    version = 1 + rows.agg(F.expr("coalesce(max(version), 0L)")).first()[0]
    rows = [tuple(vars(replace(load, version=version)).values()) for load in made]
    write_append(spark.createDataFrame(rows, LOADS).coalesce(1), f"{path}/loads")


def of_loads(df: DataFrame, loads: list[Load]) -> DataFrame:
    """The rows of these loads; other folders are not read."""
    if LOAD not in df.columns:
        return df
    return df.filter(F.col(LOAD).isin([load.load_id for load in loads])) if loads else df.limit(0)


def folder(path: str, table: str, load: Load) -> str:
    return f"{path}/{table}/{LOAD}={load.load_id}"


def clean(spark: SparkSession, path: str) -> None:
    """Delete what no visible load needs: replaced loads and those that failed. Not while a load runs."""
    kept = {f"{LOAD}={load.load_id}" for load in visible(spark, path)}
    for table in VERSIONED:
        for child in children(spark, f"{path}/{table}"):
            if child.rsplit("/", 1)[-1] not in kept:
                delete(spark, child)
