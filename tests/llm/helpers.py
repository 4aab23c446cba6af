"""Frames of edge cases, and files to hold them."""

from pyspark.sql import types as T

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# names that operators use inside, as further columns
CLASHING = DOCUMENTS + ", fp bigint, at string, file string, `row` bigint, key string, digest string, host string, component_id bigint, gone boolean, __at string, _metadata string, __kept_at int, __gone int, __host string, doc string, site string, `of` int"

LONG = " ".join(f"word{i % 977} plain{i % 13}" for i in range(60_000))
EDGES = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, "  \n\t ", None, None, None),
    (4, "one", "en", "b", 3),
    (5, "Same words stand here, once and again.", "en", "b", 38),
    (6, "same words stand here, once AND again.", "en", None, 38),
    (7, "Same words stand here, once and again.", "en", "b", 38),
    (7, "Same words stand here, once and again.", "en", "b", 38),
    (8, LONG, "en", "c", len(LONG)),
    (9, "É é ẞ ﬁ İ İ́ 日本語 👍🏽 <|endoftext|> </s>[INST]", None, "c", 1),
    (None, "a row without an id", "en", "c", 1),
]


def stored(spark, tmp_path, rows, schema=DOCUMENTS, parts=3):
    """The rows as files, read again."""
    path = str(tmp_path / f"rows{len(list(tmp_path.iterdir()))}")
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def clashing(rows):
    return [(*row, 1, "x", "y", 2, "k", "d", "h", 3, True, "a", "m", 1, 2, "h", "d", "s", 3) for row in rows]
