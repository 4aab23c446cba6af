"""Connected components of a graph given by its links, by alternating star contraction.

A round links every node's larger neighbours to its smallest one, then every node's smaller
neighbours to the smallest of them. Both keep the components and never add links; the number of
rounds grows with the logarithm of the longest path. The links of a hub are never gathered: a round
takes minima per node, combined before the shuffle, and joins them back. Each round is written to the
shared folder, so a lost executor repeats one round at most.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import saved


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def star_round(links: DataFrame) -> DataFrame:
    """``links`` (u, v) with v < u, contracted once."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    rest = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root of every node that has a link: root is the smallest node it is connected with.

    ``links`` has two columns of one orderable type; direction, repeats and self-links are ignored,
    links with a null end as well.
    """
    a, b = links.columns
    links = saved(
        links.filter(f"{a} <> {b}").selectExpr(f"greatest({a}, {b}) AS u", f"least({a}, {b}) AS v").distinct(), "links"
    )
    state = _state(links)
    while state[0]:
        links = saved(star_round(links), "links")
        before, state = state, _state(links)
        if before == state:
            break
    nodes = links.selectExpr("u AS node", "v AS root")
    return nodes.unionByName(links.selectExpr("v AS node", "v AS root").distinct())
