"""Removal of boilerplate lines, told by the number of distinct sites they stand on. SQL functions alone.

1. Every line (trimmed, not blank) is known by its hash. One aggregation gives each a HyperLogLog
   sketch of its sites; sketches are merged per task before the shuffle and after it.
2. Estimates clear of the threshold by ``MARGIN`` decide at once. Lines nearer to it get their distinct
   sites counted exactly.
3. Lines on ``SITES`` sites or more are boilerplate and go from every document; other lines, blank ones
   included, stay in place and order.

Defined cases: a null text has no lines and stays null, an empty text stays empty; a null site is no site;
a line that occurs several times in a document goes each time; repeated rows are rows of their own, and
repeat no site; a text that is boilerplate throughout becomes empty; no rows give no rows; further columns
are ignored.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import located, saved

SITES = 10
MARGIN = 0.3
SKETCH_BITS = 10


def lines_of(rows: DataFrame) -> DataFrame:
    """at, pos, line key and site of every line of located rows; the key of a blank line is null.

    The key is 96 bits of two unrelated hashes.
    """
    return (
        rows.selectExpr("at", "CAST(site AS string) AS site", "posexplode(split(doc.text, '\\n', -1)) AS (pos, whole)")
        .selectExpr("*", "trim(whole) AS line")
        .selectExpr("at", "pos", "site", "IF(line = '', NULL, struct(xxhash64(line) AS h, crc32(line) AS c)) AS key")
    )


def boilerplate(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """Keys of the lines (key, site) that stand on ``sites`` distinct sites or more."""
    keyed = lines.filter("key IS NOT NULL").select("key.h", "key.c", "site")
    estimated = saved(
        keyed.groupBy("h", "c")
        .agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"))
        .select("h", "c", F.hll_sketch_estimate("sketch").alias("n"))
        .filter(F.col("n") >= sites * (1 - MARGIN)),
        "line-estimates",
    )
    far = sites * (1 + MARGIN)
    near = estimated.filter(F.col("n") < far).select("h", "c")
    exact = (
        keyed.join(near, ["h", "c"], "left_semi")
        .groupBy("h", "c")
        .agg(F.count_distinct("site").alias("n"))
        .filter(F.col("n") >= sites)
    )
    return saved(estimated.filter(F.col("n") >= far).select("h", "c").unionByName(exact.select("h", "c")), "line-boilerplate")


def clean(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """doc_id, text without boilerplate lines, lines before and lines removed, of every row.

    The lines to go are joined with the lines of the documents; of documents that lose none nothing is listed.
    """
    rows = located(docs, site=site)
    lines = saved(lines_of(rows), "lines")
    gone = boilerplate(lines, sites)
    marks = (
        lines.selectExpr("at", "pos", "key.h", "key.c")
        .join(gone, ["h", "c"])
        .groupBy("at")
        .agg(F.collect_list("pos").alias("gone"))
        .withColumnRenamed("at", "of")
    )
    return (
        rows.selectExpr("CAST(doc.doc_id AS bigint) doc_id", "doc.text", "at")
        .join(marks, F.col("at") == F.col("of"), "left")
        .selectExpr("doc_id", "text", "gone", "split(text, '\\n', -1) AS parts")
        .selectExpr(
            "doc_id",
            "IF(gone IS NULL, text, array_join(transform(array_except(sequence(0, size(parts) - 1), gone), i -> parts[i]), '\\n')) AS text",
            "CAST(coalesce(size(parts), 0) AS bigint) AS n_lines",
            "CAST(coalesce(size(gone), 0) AS bigint) AS n_removed",
        )
    )
