"""Exact deduplication as a stream with keyed state on disk.

Texts are equal when they are the same after lower-casing A-Z. Every row becomes a digest, its
``doc_id`` and a locator (file and row number of the content). A streaming aggregation keyed by the
digest keeps, in RocksDB on the executors' disks and without expiry, the identifier and locator of
the row that stays and the number of rows seen. Rows whose digest has been seen more than once are
hits: their full bytes are fetched by locator and compared with the retained row's. Rows that share
a digest but not the bytes are grouped by the bytes themselves.

Defined cases: a null text counts as empty; of equal texts the largest ``doc_id`` stays, a null
``doc_id`` only if there is no other; repeated rows with the same ``doc_id`` count each in
``group_size`` and the one at the last file and row stays; no input rows give no output rows;
further columns are ignored.
"""

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.llm.common import ascii_lower, columns_of, located, per_batch, saved, settings
from cityflow.session import children, scratch_path

FILES_PER_BATCH = 1000
_STATE = "spark.sql.streaming.stateStore."
# State on disk. Many small stores would each reserve some MB ahead of need, so that is turned off.
_SETTINGS = {
    f"{_STATE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}rocksdb.allowFAllocate": "false",
}
_SHARES = 16
_AT = "struct<file: string, row: bigint>"


def sha256(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


def digested(rows: DataFrame, digest: Callable[[bytes], bytes]) -> DataFrame:
    """doc_id, digest of the normalised text and locator of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("file", pa.string()), ("row", pa.int64())])

    def columns(batch: pa.RecordBatch) -> dict:
        (texts,) = columns_of(batch, "text")
        # bytes.lower() touches A-Z only
        return {name: batch.column(name) for name in ("doc_id", "file", "row")} | {
            "digest": [digest((t or b"").lower()) for t in texts]
        }

    bare = rows.selectExpr("CAST(doc.doc_id AS bigint) doc_id", "CAST(doc.text AS binary) text", "at.file file", "at.row row")
    return bare.mapInArrow(per_batch(columns, schema), "doc_id bigint, digest binary, file string, row bigint").selectExpr(
        "doc_id", "digest", "struct(file, row) at"
    )


def retained(spark: SparkSession, intake: str, checkpoint: str, files_per_batch: int) -> DataFrame:
    """digest, keep (doc_id and locator of the row that stays) and rows seen, read from the state.

    The stream takes the intake files in batches of ``files_per_batch`` and commits each one in
    ``checkpoint``, where it goes on behind the last batch. Its sink discards: the state is the result.
    """
    with settings(spark, _SETTINGS):
        query = (
            spark.readStream.schema(f"doc_id bigint, digest binary, at {_AT}")
            .option("maxFilesPerTrigger", files_per_batch)
            .parquet(intake)
            .groupBy("digest")
            .agg(F.max(F.struct("doc_id", "at")).alias("keep"), F.count(F.lit(1)).alias("seen"))
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    if not children(spark, f"{checkpoint}/state"):
        return spark.createDataFrame([], f"digest binary, keep struct<doc_id: bigint, at: {_AT}>, seen bigint")
    state = spark.read.format("statestore").load(checkpoint)
    keep, seen = state.schema["value"].dataType.names
    return state.select("key.digest", F.col(f"value.`{keep}`").alias("keep"), F.col(f"value.`{seen}`").alias("seen"))


def _texts(rows: DataFrame) -> DataFrame:
    """Locator and normalised text, of which it takes part in comparisons as bytes."""
    return rows.select("at", ascii_lower(F.coalesce("doc.text", F.lit(""))).alias("text"))


def collided(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Digests under which not all rows have the same bytes: the hits' texts are fetched by locator,
    and the smallest and the largest text of a digest must be one.

    They are combined within a task, then among a share of the tasks, then altogether, so a digest that all
    tasks have seen sends a few texts to each of several tasks.
    """
    hits = members.filter("seen > 1").select("digest", "at")
    extremes = [F.min("first").alias("first"), F.max("last").alias("last")]
    return (
        hits.join(_texts(rows), "at")
        .selectExpr("digest", "text AS first", "text AS last", f"spark_partition_id() % {_SHARES} AS share")
        .groupBy("digest", "share")
        .agg(*extremes)
        .groupBy("digest")
        .agg(*extremes)
        .filter("first <> last")
        .select("digest")
    )


def _arrive(rows: DataFrame, digest: Callable[[bytes], bytes], intake: str) -> DataFrame:
    """Add rows of files that have not arrived before; returns all that have."""
    spark, schema = rows.sparkSession, f"doc_id bigint, digest binary, at {_AT}"
    if children(spark, intake):
        before = spark.read.schema(schema).parquet(intake).select(F.col("at.file").alias("file")).distinct()
        rows = rows.join(before, F.col("at.file") == F.col("file"), "left_anti")
    digested(rows, digest).write.mode("append").parquet(intake)
    return spark.read.schema(schema).parquet(intake)


def deduplicate(
    docs: DataFrame,
    digest: Callable[[bytes], bytes] = sha256,
    files_per_batch: int = FILES_PER_BATCH,
    folder: str | None = None,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, at, keep_id, group_size, kept, digest.

    ``folder`` (in the store that the cluster shares) keeps digests and state. Given again with further
    documents, the stream goes on from there and the result covers the documents of all calls; files
    that arrived before are not taken twice. Without it every call starts anew.
    """
    return _deduplicated(located(docs, folder and f"{folder}/landed"), digest, files_per_batch, folder)


def _deduplicated(rows: DataFrame, digest: Callable[[bytes], bytes], files_per_batch: int, folder: str | None) -> DataFrame:
    spark = rows.sparkSession
    home = folder or scratch_path(spark, "exact-dedup")
    arrived = _arrive(rows, digest, f"{home}/intake")
    if folder:
        files = [r["file"] for r in arrived.select("at.file").distinct().collect()]  # names, as a reader lists them
        if files:
            rows = located(spark.read.parquet(*files))
    state = retained(spark, f"{home}/intake", f"{home}/checkpoint", files_per_batch)
    members = saved(arrived.join(state, "digest"), "exact-dedup-members")
    clash = saved(collided(rows, members), "exact-dedup-clash")
    result = ["doc_id", "at", "keep.doc_id AS keep_id", "seen AS group_size", "at <=> keep.at AS kept", "digest"]
    if clash.isEmpty():
        return members.selectExpr(*result)
    unlike = arrived.join(clash, "digest", "left_semi").join(_texts(rows), "at")
    groups = unlike.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "at")).alias("keep"), F.count(F.lit(1)).alias("seen")
    )
    return (
        members.join(clash, "digest", "left_anti")
        .selectExpr(*result)
        .unionByName(unlike.join(groups, ["digest", "text"]).selectExpr(*result))
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    rows = located(docs)
    kept = _deduplicated(rows, sha256, FILES_PER_BATCH, None).filter("kept").select("at")
    return rows.join(kept, "at", "left_semi").select("doc.*")
