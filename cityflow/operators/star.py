"""Star schema: dimensions, surrogate keys, key lookup and fact tables."""

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow import fixed_values as V
from cityflow.functions import kpi
from cityflow.functions.temporal import calendar
from cityflow.operators.prefix import with_running_total
from cityflow.schemas import CORRUPT, FACT_ACCIDENT, FACT_TRAFFIC

CORRUPT_ROW, REPEATED, STORED = "malformed row", "repeated", "stored"

TRAFFIC_NAMES, ACCIDENT_NAMES = V.TRAFFIC_NAMES, V.ACCIDENT_NAMES


def conform(df: DataFrame, renames: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    """Rename, then keep the target columns in order."""
    return df.withColumnsRenamed(dict(renames)).select(*columns)


def dim_from_map(
    spark: SparkSession, mapping: Mapping[str, str], id_name: str, key: str, attribute: str
) -> DataFrame:
    """A dimension written out as literals, keyed 1.. in the order given.

    Built from Arrow, it is a local relation of known size, so joins broadcast it unasked.
    """
    rows = pa.table(
        {
            id_name: pa.array(range(1, len(mapping) + 1), pa.int64()),
            key: pa.array(list(mapping), pa.string()),
            attribute: pa.array(list(mapping.values()), pa.string()),
        }
    )
    return spark.createDataFrame(rows)


def dim_location(spark: SparkSession, zones: Mapping[str, str] = V.ZONE_TYPES) -> DataFrame:
    return dim_from_map(spark, zones, "location_id", "location_name", "zone_type")


def dim_vehicle(spark: SparkSession, classes: Mapping[str, str] = V.VEHICLE_CLASSES) -> DataFrame:
    return dim_from_map(spark, classes, "vehicle_id", "vehicle_type", "vehicle_class")


def with_key(dim: DataFrame, order_by: str, key: str, bucket: str | None = None) -> DataFrame:
    """Consecutive keys 1.. in the sort order.

    Without ``bucket`` the rows are numbered in one task, which suits the few rows of a small
    dimension. A large one passes a bucket that rises with ``order_by``.
    """
    if bucket is None:
        return dim.selectExpr("*", f"CAST(row_number() OVER (ORDER BY {order_by}) AS BIGINT) AS {key}")
    return with_running_total(dim, "1L", order_by, bucket, key)


def with_row_keys(df: DataFrame, unique: Sequence[str], key: str, buckets: int = 2**16) -> DataFrame:
    """Consecutive keys 1.. for the rows of a fact table, in no particular order.

    Rows are numbered within hash buckets of their unique columns and each bucket starts where the
    one before ends. Rows without any of those values, and repeats of them, are spread by a hash of
    the whole row.
    """
    names, whole = ", ".join(unique), ", ".join(f"`{c}`" for c in df.columns)
    return with_running_total(df, "1L", f"{names}, xxhash64({whole})", f"pmod(xxhash64({whole}), {buckets})", key)


def with_natural_keys(df: DataFrame, key: str) -> DataFrame:
    """A key from the row's own values: the same row has the same key in every load, and new rows
    leave the keys of old ones as they are. Rows alike in every column share it."""
    return df.selectExpr("*", f"xxhash64({', '.join(f'`{c}`' for c in sorted(df.columns))}) AS {key}")


def dim_weather(accidents: DataFrame, column: str = "Weather_Condition") -> DataFrame:
    """Distinct conditions in sorted order with the adverse flag.

    The rows are reduced to their distinct conditions in parallel; what one task orders, to count
    them 1.., is the dimension's members. Store the dimension before facts refer to it: a file has a
    size, so Spark can decide how to join it.
    """
    distinct = accidents.selectExpr(f"{column} AS weather_condition").filter("weather_condition IS NOT NULL").distinct()
    flagged = distinct.selectExpr(
        "weather_condition", f"{kpi.flag_in('weather_condition', V.ADVERSE_WEATHER)} AS is_adverse"
    )
    return with_key(flagged, "weather_condition", "weather_id").select("weather_id", "weather_condition", "is_adverse")


def date_key(ts: str) -> str:
    """Key of a timestamp: its seconds since 1970. It needs no lookup, sort or shared counter."""
    return f"unix_seconds(CAST({ts} AS TIMESTAMP))"


def key_time(date_id: str = "date_id") -> str:
    return f"timestamp_seconds({date_id})"


def distinct_times(*facts: DataFrame, ts: str = "DateTime") -> DataFrame:
    """Distinct timestamps of all frames, to the second as their key is; each partition drops its
    repeats before the shuffle."""
    times = [f.selectExpr(f"timestamp_seconds({date_key(ts)}) AS full_datetime") for f in facts]
    return reduce(DataFrame.unionAll, times).filter("full_datetime IS NOT NULL").distinct()


def dim_date(*facts: DataFrame, ts: str = "DateTime") -> DataFrame:
    """One row per distinct timestamp with its calendar attributes."""
    times = distinct_times(*facts, ts=ts)
    return times.selectExpr(
        f"{date_key('full_datetime')} AS date_id", "full_datetime", *calendar("full_datetime")
    )


def dim_date_sequential(*facts: DataFrame, ts: str = "DateTime") -> DataFrame:
    """The same, keyed 1.. in time order instead; only where consecutive keys are asked for."""
    numbered = with_key(distinct_times(*facts, ts=ts), "full_datetime", "date_id", "to_date(full_datetime)")
    return numbered.selectExpr("date_id", "full_datetime", *calendar("full_datetime"))


def look_up(fact: DataFrame, dim: DataFrame, fact_column: str, dim_column: str, key: str) -> DataFrame:
    """Add a surrogate key; null where the dimension has no match."""
    names = dim.selectExpr(f"{dim_column} AS {fact_column}", key)
    return fact.join(names, fact_column, "left")


def resolve(
    fact: DataFrame, dim: DataFrame, on: Mapping[str, str], key: str
) -> tuple[DataFrame, DataFrame]:
    """Look up a surrogate key. Returns the rows found and, apart, the rows without a match.

    ``on`` maps fact columns to natural key columns of the dimension.
    """
    names = dim.selectExpr(*[f"{d} AS {f}" for f, d in on.items()], key)
    return fact.join(names, list(on)), fact.join(names, list(on), "left_anti")


def _with_keys(features: DataFrame, lookups: Sequence[tuple[DataFrame, str, str, str]]) -> DataFrame:
    keyed = features.selectExpr("*", f"{date_key('DateTime')} AS date_id")
    for dim, fact_column, dim_column, key in lookups:
        keyed = look_up(keyed, dim, fact_column, dim_column, key)
    return keyed


def _typed(renames: Mapping[str, str], schema: T.StructType) -> list[str]:
    raw_names = {target: raw for raw, target in renames.items()}
    return [
        f"CAST({raw_names.get(f.name, f.name)} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in schema.fields
    ]


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; rows are counted before anything is shuffled."""
    counts = df.filter(f"{column} IS NOT NULL").groupBy(column).agg(F.expr("count(*) AS n"))
    return counts.filter("n > 1").select(column)


def checked(
    keyed: DataFrame,
    renames: Mapping[str, str],
    required: Sequence[str],
    repeated: DataFrame | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Rows with ``failed``: the constraints they break. Empty for rows that may be stored.

    The columns of a table that must not be null, by the table's names; rows that came malformed from
    their file; and values of a column that must be unique but, as ``repeated`` lists, are not, or as
    ``stored`` lists, are in the table already. None of the rows with a repeated value is known to be the
    right one; of a stored value the stored row is.
    """
    raw_names = {target: raw for raw, target in renames.items()}
    marks = [f"IF({raw_names.get(c, c)} IS NULL, '{c}', NULL)" for c in required]
    if CORRUPT in keyed.columns:
        marks.append(f"IF({CORRUPT} IS NOT NULL, '{CORRUPT_ROW}', NULL)")
    for listed, word in ((repeated, REPEATED), (stored, STORED)):
        if listed is not None:
            (name,) = listed.columns
            keyed = keyed.join(listed.selectExpr(name, f"true AS __{word}"), name, "left")
            marks.append(f"IF(__{word}, '{word} {renames.get(name, name)}', NULL)")
    return keyed.selectExpr("*", f"array_compact(array({', '.join(marks)})) AS failed").drop(f"__{REPEATED}", f"__{STORED}")


def constraints(renames: Mapping[str, str], required: Sequence[str], unique: str | None = None) -> list[str]:
    """The names that :func:`checked` may give."""
    return [*required, CORRUPT_ROW, *([f"{word} {renames.get(unique, unique)}" for word in (REPEATED, STORED)] if unique else [])]


def complete(keyed: DataFrame, renames: Mapping[str, str], required: Sequence[str]) -> DataFrame:
    """The rows that break none of the constraints on single rows. A plain condition, so that a reader
    of few columns leaves the others unread."""
    raw_names = {target: raw for raw, target in renames.items()}
    conditions = [f"{raw_names.get(c, c)} IS NOT NULL" for c in required]
    if CORRUPT in keyed.columns:
        conditions.append(f"{CORRUPT} IS NULL")
    return keyed.filter(" AND ".join(conditions))


TRAFFIC_REQUIRED = tuple(c for c in FACT_TRAFFIC.fieldNames() if c != "traffic_pk")
ACCIDENT_REQUIRED = tuple(c for c in FACT_ACCIDENT.fieldNames() if c != "accident_pk")


def _keyed_traffic(features: DataFrame, location: DataFrame) -> DataFrame:
    return _with_keys(features, [(location, "Location", "location_name", "location_id")])


def _keyed_accidents(features: DataFrame, location: DataFrame, vehicle: DataFrame, weather: DataFrame) -> DataFrame:
    return _with_keys(
        features,
        [
            (location, "Location", "location_name", "location_id"),
            (vehicle, "Vehicle_Type", "vehicle_type", "vehicle_id"),
            (weather, "Weather_Condition", "weather_condition", "weather_id"),
        ],
    )


def checked_traffic(features: DataFrame, location: DataFrame) -> DataFrame:
    return checked(_keyed_traffic(features, location), TRAFFIC_NAMES, TRAFFIC_REQUIRED)


def checked_accidents(
    features: DataFrame,
    location: DataFrame,
    vehicle: DataFrame,
    weather: DataFrame,
    repeated: DataFrame | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """``repeated``: accident ids that occur more than once, see :func:`repeated_values`; ``stored``: ids
    that the table has already. Both are written to files first."""
    return checked(_keyed_accidents(features, location, vehicle, weather), ACCIDENT_NAMES, ACCIDENT_REQUIRED, repeated, stored)


def rejects_of(marked: DataFrame) -> DataFrame:
    """The rows that break a constraint, with the constraints' names."""
    return marked.filter("size(failed) > 0")


def _traffic(rows: DataFrame, pk: str) -> DataFrame:
    return rows.selectExpr(*_typed({**TRAFFIC_NAMES, pk: "traffic_pk"}, FACT_TRAFFIC))


def _accidents(rows: DataFrame, pk: str) -> DataFrame:
    return rows.selectExpr(*_typed({**ACCIDENT_NAMES, pk: "accident_pk"}, FACT_ACCIDENT))


def traffic_of(marked: DataFrame, pk: str = "traffic_pk") -> DataFrame:
    return _traffic(marked.filter("size(failed) = 0"), pk)


def accidents_of(marked: DataFrame, pk: str = "accident_pk") -> DataFrame:
    return _accidents(marked.filter("size(failed) = 0"), pk)


def fact_traffic(features: DataFrame, location: DataFrame, pk: str = "traffic_pk") -> DataFrame:
    """Traffic facts: the readings that keep every constraint."""
    return _traffic(complete(_keyed_traffic(features, location), TRAFFIC_NAMES, TRAFFIC_REQUIRED), pk)


def traffic_rejects(features: DataFrame, location: DataFrame) -> DataFrame:
    """The other readings, with the constraints they break."""
    return rejects_of(checked_traffic(features, location))


def fact_accident(
    features: DataFrame,
    location: DataFrame,
    vehicle: DataFrame,
    weather: DataFrame,
    pk: str = "accident_pk",
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Accident facts: the accidents that keep every constraint.

    A risk score is null only where the number of vehicles is, which is asked for; a condition on the
    score itself would be computed a second time, below the columns.
    """
    keyed = _keyed_accidents(features, location, vehicle, weather)
    if repeated is not None:
        keyed = keyed.join(repeated, repeated.columns, "left_anti")
    return _accidents(complete(keyed, ACCIDENT_NAMES, [c for c in ACCIDENT_REQUIRED if c != "risk_score"]), pk)


def accident_rejects(features: DataFrame, location: DataFrame, vehicle: DataFrame, weather: DataFrame) -> DataFrame:
    """The other accidents, with the constraints they break."""
    return rejects_of(checked_accidents(features, location, vehicle, weather))


MONTH = "month_start"


def with_month(fact: DataFrame) -> DataFrame:
    """A fact's rows with the first day of their month, by which facts are partitioned."""
    return fact.selectExpr("*", f"CAST(trunc({key_time()}, 'month') AS DATE) AS {MONTH}")
