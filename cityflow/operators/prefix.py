"""Running totals and row numbers over a whole table, without a one-task window.

A window with no partition columns sends every row to one task. Here rows are grouped by a
``bucket`` that rises with the sort order: bucket totals are summed up over the few buckets, and
rows are ordered within their bucket only. The two add up to the exact running total.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_running_total(df: DataFrame, value: str, order_by: str, bucket: str, out: str) -> DataFrame:
    """Add the sum of ``value`` over all rows up to and including this one.

    ``value``, ``order_by`` and ``bucket`` are SQL expressions; ``order_by`` must be unique. The
    number of buckets must be small (days, ranges of a score): it is all that one task sorts. A null
    bucket is one of its own and comes first, as nulls sort first.
    """
    bucketed = df.selectExpr("*", f"{bucket} AS __bucket", f"{value} AS __value")
    earlier = "OVER (ORDER BY __bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    before = (
        bucketed.groupBy("__bucket")
        .agg(F.sum("__value").alias("__total"))
        .selectExpr("__bucket", f"coalesce(sum(__total) {earlier}, 0) AS __before")
    )
    inside = bucketed.selectExpr(
        "*",
        f"sum(__value) OVER (PARTITION BY __bucket ORDER BY {order_by} ROWS UNBOUNDED PRECEDING) AS __inside",
    )
    before = before.withColumnRenamed("__bucket", "__of")
    return inside.join(before, F.expr("__bucket <=> __of")).selectExpr(
        "* EXCEPT (__bucket, __of, __value, __inside, __before)", f"__inside + __before AS {out}"
    )
