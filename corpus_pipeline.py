"""The corpus pipeline: toxic and low-quality documents go, one of each group of equal and of near-equal
texts stays, and what is left is packed into training sequences.

Every stage is (name, function); a function takes (spark, docs, sf_dir) and returns a frame, which is
written as Parquet and read again as the next one's ``docs``. All but the last return rows of ``docs``
with its columns. An empty frame passes through every stage; the cases of single rows are those of the
operators.
"""

from pyspark.sql import DataFrame, SparkSession

from cityflow.llm import bestfit, exact_dedup, quality, simhash, toxicity
from cityflow.llm.common import saved, table
from cityflow.llm.queries import WORD_BPE


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bestfit.pack(docs, WORD_BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_low_quality),
    ("exact dedup", drop_equal),
    ("SimHash near-dedup", drop_near),
    ("best-fit packing", pack),
]

# trained models and a tokenizer: no SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
