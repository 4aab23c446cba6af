"""Data-quality checks in place of a database's constraints."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.functions.text import columns as expressions
from cityflow.functions.text import one_of
from cityflow.session import scratch_path
from cityflow.sources.files import stored


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column, in one pass over the table."""
    counts = df.agg(*expressions(f"count_if({c} IS NULL) AS {c}" for c in columns))
    pairs = ", ".join(f"struct('{c}' AS column_name, {c} AS null_count)" for c in columns)
    return counts.selectExpr(f"inline(array({pairs}))")


def duplicates(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts. Null keys are not compared."""
    keys = [key] if isinstance(key, str) else list(key)
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.expr("count(*) AS row_count"))
    return counts.filter("row_count > 1")


def orphans(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Child keys without a parent and their row counts. Null keys refer to nothing.

    Child rows are counted per key first, so a key held by a third of the rows reaches the join
    as a single row.
    """
    keys = list(on)
    counts = child.dropna(subset=keys).groupBy(*keys).agg(F.expr("count(*) AS row_count"))
    known = parent.selectExpr(*[f"{p} AS {c}" for c, p in on.items()])
    return counts.join(known, keys, "left_anti")


def bad_values(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Values outside a documented domain, with their counts."""
    strange = df.filter(f"NOT {one_of(column, allowed)}").selectExpr(f"{column} AS value")
    return strange.groupBy("value").agg(F.expr("count(*) AS row_count"))


def key_counts(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """table_name, column_name, value (as text) and the rows that have it, of several columns per table.

    A table is read once for all of its columns. Partial counts come before the shuffle, so a value held
    by a third of the rows reaches it as a row per task.
    """
    found = []
    for name, columns in keys.items():
        pairs = ", ".join(f"struct('{c}' AS column_name, CAST({c} AS STRING) AS value)" for c in columns)
        counts = tables[name].selectExpr(f"inline(array({pairs}))").groupBy("column_name", "value")
        found.append(counts.agg(F.expr("count(*) AS n")).selectExpr(f"'{name}' AS table_name", "*"))
    return reduce(DataFrame.unionByName, found)


def quality_report(
    tables: Mapping[str, DataFrame],
    required: Mapping[str, Sequence[str]],
    unique: Mapping[str, Sequence[str]],
    references: Mapping[tuple[str, str], tuple[str, str]],
) -> DataFrame:
    """table_name, constraint_name, column_name and rows that break it, for every declared constraint.

    ``required`` and ``unique`` list columns by table; ``references`` maps (table, column) to the
    (table, column) it must be found in. A table is read twice, for its nulls and for its keys; the counts of
    the keys are stored, and uniqueness and references are told from them.
    """
    spark = next(iter(tables.values())).sparkSession
    names = ["table_name", "constraint_name", "column_name"]
    nulls = reduce(
        DataFrame.unionByName,
        [
            null_counts(tables[name], list(columns)).selectExpr(
                f"'{name}' AS table_name", "'not null' AS constraint_name", "column_name", "null_count AS broken"
            )
            for name, columns in required.items()
        ],
    )
    keys: dict[str, list[str]] = {}
    for name, column in [(n, c) for n, cs in unique.items() for c in cs] + [*references, *references.values()]:
        if column not in keys.setdefault(name, []):
            keys[name].append(column)
    counts = stored(key_counts(tables, keys), scratch_path(spark, "key-counts")).filter("value IS NOT NULL")
    declared = [(n, "unique", c, None, None) for n, cs in unique.items() for c in cs]
    declared += [(*child, *parent) for child, parent in (((n, "reference", c), p) for (n, c), p in references.items())]
    listed = spark.createDataFrame(declared, "table_name string, constraint_name string, column_name string, parent string, parent_key string")
    of_keys = F.broadcast(listed).join(counts, ["table_name", "column_name"])  # a row per declared constraint
    repeated = of_keys.filter("constraint_name = 'unique' AND n > 1")
    parents = counts.selectExpr("table_name AS parent", "column_name AS parent_key", "value")
    orphaned = of_keys.filter("constraint_name = 'reference'").join(parents, ["parent", "parent_key", "value"], "left_anti")
    broken = repeated.select(*names, "n").unionByName(orphaned.select(*names, "n")).groupBy(*names).agg(F.expr("sum(n) AS broken"))
    told = listed.select(*names).join(F.broadcast(broken), names, "left").fillna(0, ["broken"])
    return nulls.unionByName(told)


def domain_report(df: DataFrame, domains: Mapping[str, Sequence]) -> DataFrame:
    """:func:`bad_values` of several columns, in one pass over the table."""
    marks = ", ".join(
        f"IF(NOT {one_of(c, allowed)}, struct('{c}' AS column_name, CAST({c} AS STRING) AS value), NULL)"
        for c, allowed in domains.items()
    )
    found = df.selectExpr(f"inline(array_compact(array({marks})))")
    return found.groupBy("column_name", "value").agg(F.expr("count(*) AS row_count"))
