"""Reading and writing files and tables."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow.schemas import CORRUPT
from cityflow.session import found


def csv_schema(schema: T.StructType) -> T.StructType:
    """The schema with a further column that keeps the text of a malformed row."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Header CSV as typed columns, found by their names in the header, in whatever order.

    The header is the first file's; a file with another one fails rather than being read wrongly. A
    malformed row is kept: values that are not of their column's type are null, and the last column
    has the row's text.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    lacking = [f.name for f in schema.fields if f.name not in raw.columns]
    if lacking:
        raise ValueError(f"the header of {path} lacks {', '.join(lacking)}")
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    typed = {c: f"try_cast({c} AS {kind})" for c, kind in kinds.items()}
    wrong = " OR ".join(f"({c} IS NOT NULL AND {typed[c]} IS NULL)" for c, kind in kinds.items() if kind != "string")
    text = "concat_ws(',', " + ", ".join(f"coalesce(`{c}`, '')" for c in raw.columns) + ")"
    corrupt = f"IF({wrong or 'false'}, {text}, NULL) AS {CORRUPT}"
    return raw.selectExpr(*[f"{typed[c]} AS {c}" for c in kinds], corrupt)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written and read again. Files survive lost executors, and their size lets Spark choose
    how to join them."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType, recursive: bool = False
) -> DataFrame:
    """All Parquet files under a folder; an empty frame of that schema if there is none.

    ``recursive`` takes files at any depth, as a key prefix does, instead of partition folders.
    """
    if not found(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", recursive).parquet(path)


def read_table(spark: SparkSession, text: str) -> DataFrame:
    """Rows of a SQL text over registered tables and views."""
    return spark.sql(text)


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Rows of a SQL text run by a database. Credentials and partitioning come as options.

    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` make it a parallel
    read; with them Spark needs the query as a derived table.
    """
    return spark.read.format("jdbc").options(url=url, dbtable=f"({query}) AS q", **options).load()


def write_replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the files under ``path``; a rerun gives the same table.

    With ``partition_by`` rows are first rebalanced on those columns: adaptive execution merges
    small and splits large partitions, so a hot month neither becomes one task nor, spread over
    all tasks, thousands of small files.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_new(batch: DataFrame, existing: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key ``existing`` lacks, so that appending twice equals once.

    Of rows with one key the batch's smallest by its other columns is taken. Rows without a complete
    key can not be told from those stored and are left out, see :func:`without_key`. The keys already present are found with the batch as the right side of a semi join. A batch
    is small next to the table it is appended to, so Spark can broadcast it and scan the table
    without shuffling it; a large batch is shuffled.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in batch.columns if c not in keys]
    single = batch.dropna(subset=keys).groupBy(*keys).agg(F.min(F.struct(*rest, *keys)).alias("__row"))
    single = single.select(*[F.col(c) if c in keys else F.col("__row").getField(c).alias(c) for c in batch.columns])
    present = existing.select(*keys).join(single.select(*keys), keys, "left_semi")
    return single.join(present, keys, "left_anti")


def without_key(batch: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of which a key column is null."""
    keys = [key] if isinstance(key, str) else list(key)
    return batch.filter(" OR ".join(f"{k} IS NULL" for k in keys))


def observed(df: DataFrame, name: str, measures: Mapping[str, str] | None = None) -> tuple[DataFrame, Observation]:
    """Count rows on the way through, and further aggregates given as SQL text, without a further job;
    read them after an action."""
    observation = Observation(name)
    counted = [F.expr(f"{text} AS `{alias}`") for alias, text in (measures or {}).items()]
    return df.observe(observation, F.count(F.lit(1)).alias("row_count"), *counted), observation
