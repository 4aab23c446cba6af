"""The warehouse from end to end: feature tables, star schema and views."""

from collections.abc import Callable, Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cityflow import fixed_values as V
from cityflow.operators import quality, star
from cityflow.operators.star import MONTH
from cityflow.plans import loads, views
from cityflow.schemas import (
    ACCIDENT_RISK,
    DIM_DATE,
    DIM_LOCATION,
    DIM_VEHICLE,
    DIM_WEATHER,
    FACT_ACCIDENT,
    FACT_TRAFFIC,
    LOAD_AUDIT,
)
from cityflow.sources.files import read_parquet, write_replace

SCHEMAS = {
    "dim_location": DIM_LOCATION,
    "dim_vehicle": DIM_VEHICLE,
    "dim_weather": DIM_WEATHER,
    "dim_date": DIM_DATE,
    "fact_traffic": FACT_TRAFFIC,
    "fact_accident": FACT_ACCIDENT,
    "ml_accident_risk": ACCIDENT_RISK,
}


FACTS = ("fact_traffic", "fact_accident")


class Star:
    """The star schema over two feature tables. Each frame is lazy and built when first asked for.

    ``weather``: how to get the dimension, if it is stored already. ``repeated``: accident ids that
    are not unique, stored too; facts without it are checked for all constraints but that one. ``known``:
    accident ids that the warehouse has already.
    """

    def __init__(
        self,
        spark: SparkSession,
        sensor: DataFrame,
        accident: DataFrame,
        zones: Mapping[str, str] = V.ZONE_TYPES,
        weather: Callable[[], DataFrame] | None = None,
        repeated: DataFrame | None = None,
        known: DataFrame | None = None,
    ):
        self._spark, self._sensor, self._accident, self._zones = spark, sensor, accident, zones
        self._weather, self._repeated, self._known = weather, repeated, known

    @cached_property
    def location(self) -> DataFrame:
        return star.dim_location(self._spark, self._zones)

    @cached_property
    def vehicle(self) -> DataFrame:
        return star.dim_vehicle(self._spark)

    @cached_property
    def weather(self) -> DataFrame:
        return self._weather() if self._weather else star.dim_weather(self._accident)

    @cached_property
    def date(self) -> DataFrame:
        return star.dim_date(self._sensor, self._accident)

    @cached_property
    def checked_traffic(self) -> DataFrame:
        return star.checked_traffic(self._sensor, self.location)

    @cached_property
    def checked_accidents(self) -> DataFrame:
        return star.checked_accidents(
            self._accident, self.location, self.vehicle, self.weather, self._repeated, self._known
        )

    @cached_property
    def traffic(self) -> DataFrame:
        return star.fact_traffic(self._sensor, self.location)

    @cached_property
    def accidents(self) -> DataFrame:
        return star.fact_accident(self._accident, self.location, self.vehicle, self.weather, repeated=self._repeated)

    def dimensions(self) -> dict[str, DataFrame]:
        return {
            "dim_location": self.location,
            "dim_vehicle": self.vehicle,
            "dim_weather": self.weather,
            "dim_date": self.date,
        }

    def tables(self) -> dict[str, DataFrame]:
        return {**self.dimensions(), "fact_traffic": self.traffic, "fact_accident": self.accidents}


def store(tables: Mapping[str, DataFrame], path: str) -> None:
    """Write each table to its own folder, replacing what is there; facts by month."""
    for name, df in tables.items():
        if name in FACTS:
            write_replace(star.with_month(df), f"{path}/{name}", [MONTH])
        else:
            write_replace(df, f"{path}/{name}")


def stored_schema(name: str) -> T.StructType:
    """A table's columns and those of its folders."""
    folders = [T.StructField(MONTH, T.DateType())] if name in FACTS else []
    return T.StructType([*SCHEMAS[name].fields, *folders])


def open_tables(spark: SparkSession, path: str, seen: Sequence[loads.Load] | None = None) -> dict[str, DataFrame]:
    """The stored tables; one that was never written is empty.

    Of tables that were loaded in batches the rows of visible loads, or of those given. Facts have the first
    day of their month as a further column, which is the name of a folder: filters on it leave the others
    unread. The dates have it too, so that a join on both columns does so as well.
    """
    in_batches = seen is not None
    if seen is None:
        seen = loads.visible(spark, path)
        in_batches = bool(seen)
    tables = {}
    for name in SCHEMAS:
        schema = stored_schema(name)
        if in_batches and name in loads.VERSIONED:
            schema = schema.add(loads.LOAD, T.StringType())
        rows = read_parquet(spark, f"{path}/{name}", schema)
        tables[name] = loads.of_loads(rows, seen).drop(loads.LOAD)
    tables["dim_date"] = tables["dim_date"].selectExpr("*", f"CAST(trunc(full_datetime, 'month') AS DATE) AS {MONTH}")
    return tables


def open_rejects(spark: SparkSession, path: str, name: str) -> DataFrame:
    """``reject_traffic`` or ``reject_accident``: the rows that visible loads kept out of the facts."""
    return loads.of_loads(spark.read.parquet(f"{path}/{name}"), loads.visible(spark, path))


def report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows that break a declared constraint, over the six tables."""
    required = {name: SCHEMAS[name].fieldNames() for name in tables}
    unique = {
        "dim_location": ["location_id", "location_name"], "dim_vehicle": ["vehicle_id", "vehicle_type"],
        "dim_weather": ["weather_id", "weather_condition"], "dim_date": ["date_id", "full_datetime"],
        "fact_traffic": ["traffic_pk"], "fact_accident": ["accident_pk", "accident_id"],
    }
    parents = {"location_id": "dim_location", "date_id": "dim_date", "vehicle_id": "dim_vehicle", "weather_id": "dim_weather"}
    references = {
        (fact, key): (parent, key)
        for fact in FACTS for key, parent in parents.items() if key in SCHEMAS[fact].fieldNames()
    }
    return quality.quality_report(tables, required, unique, references)


def open_audit(spark: SparkSession, path: str) -> DataFrame:
    """What was counted while the visible loads were written, see ``jobs.load_job``."""
    return loads.of_loads(read_parquet(spark, f"{path}/load_audit", LOAD_AUDIT), loads.visible(spark, path))


def open_cells(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame] | None:
    """Cells of accidents and readings of the visible loads, written with each of them; none if there are no loads."""
    seen = loads.visible(spark, path)
    if not seen:
        return None
    accidents, traffic = (loads.of_loads(spark.read.parquet(f"{path}/cells_{name}"), seen) for name in ("accident", "traffic"))
    return accidents.drop(loads.LOAD), traffic.drop(loads.LOAD)


def open_views(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Register the stored tables, the eight views and the two as-written ones over them, in their
    presentation order, and the audit of the views' row counts, for ``spark.sql``.

    Where the warehouse was loaded in batches, views merge the cells that every load left, so their cost
    follows the number of cells and not of facts; the as-written ones need the facts.
    """
    tables = open_tables(spark, path)
    accidents, traffic, location = tables["fact_accident"], tables["fact_traffic"], tables["dim_location"]
    basis = open_cells(spark, path) or (accidents, traffic)
    others = location, tables["dim_weather"], tables["ml_accident_risk"], tables["dim_date"]
    over = views.all_views(*basis, *others)
    counts = {"vw_row_counts": views.all_row_counts(*basis, *others)}
    literal = {
        "vw_location_summary_fanout": views.location_summary_fanout(accidents, traffic, location),
        "vw_hourly_profile_fanout": views.hourly_profile_fanout(accidents, traffic),
    }
    found = {name: views.ordered(name, view) for name, view in over.items()}
    views.register(spark, {**tables, **found, **literal, **counts})
    return found
