"""Adapter: benchmark tables in the shapes of the raw sensor and accident records.

``events`` stands in for sensor readings, ``orders`` for accidents and the five regions for the
city's zones. No join is hinted: Spark broadcasts a side whose files are small and otherwise
shuffles it, where adaptive execution splits hot keys.
"""

from pyspark.sql import DataFrame, SparkSession

from cityflow.functions.text import case

# Zone types of the stand-in zones.
REGION_ZONES = {
    "AFRICA": "Urban Core",
    "AMERICA": "Highway",
    "ASIA": "Residential",
    "EUROPE": "Industrial",
    "MIDDLE EAST": "Suburban",
}

# Stand-ins for the record labels.
_CONGESTION = {"error": "High", "purchase": "High", "signup": "Low"}
_VEHICLES = {"1-URGENT": "Truck", "2-HIGH": "Bus", "3-MEDIUM": "Car", "4-NOT SPECIFIED": "Motorcycle"}
_WEATHER = {"AUTOMOBILE": "Clear", "BUILDING": "Rain", "FURNITURE": "Fog", "HOUSEHOLD": "Snow"}
_ROADS = {0: "Dry", 1: "Wet", 2: "Icy"}
_SEVERITIES = {0: "Minor", 1: "Moderate", 2: "Severe"}
_DENSITIES = {"P": "Low", "F": "Moderate"}

_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_linenumber INT",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, since a stream takes no single file; it fits a file and a folder of that name.
    return spark.readStream.schema(_SCHEMAS["events"]).parquet(f"{sf_dir}/[e]vents.parquet")


def readings_of(events: DataFrame, region: DataFrame) -> DataFrame:
    """Sensor records of ``events``, which may be a stream."""
    readings = events.selectExpr(
        "event_id AS traffic_pk",
        "CAST(user_id AS STRING) AS Sensor_ID",
        "CAST(user_id % 5 AS INT) AS region_key",
        "date_trunc('hour', ts) AS Date_Time",
        "CAST(floor(value) AS INT) AS Vehicle_Count",
        "CAST(20 + user_id % 60 AS INT) AS Average_Speed",
        f"{case('event_type', _CONGESTION, 'Moderate')} AS Congestion_Level",
    )
    zones = region.selectExpr("r_regionkey AS region_key", "r_name AS Location")
    return readings.join(zones, "region_key").select(
        "traffic_pk", "Sensor_ID", "Location", "Date_Time", "Vehicle_Count", "Average_Speed",
        "Congestion_Level",
    )


def sensor_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_of(table(spark, sf_dir, "events"), table(spark, sf_dir, "region"))


def accident_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The small tables are joined first, so the large one is joined once.
    nations = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey", "n_regionkey AS r_regionkey")
    customers = table(spark, sf_dir, "customer").join(nations, "c_nationkey")
    places = customers.join(table(spark, sf_dir, "region"), "r_regionkey").selectExpr(
        "c_custkey AS o_custkey", "c_mktsegment", "r_name AS Location"
    )
    return (
        table(spark, sf_dir, "orders")
        .join(places, "o_custkey")
        .selectExpr(
            "o_orderkey AS accident_pk",
            "CAST(o_orderkey AS STRING) AS Accident_ID",
            "Location",
            "TIMESTAMP '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST(o_orderkey % 5000 AS INT)) AS Date_Time",
            f"{case('o_orderpriority', _VEHICLES, 'Bicycle')} AS Vehicle_Type",
            f"{case('c_mktsegment', _WEATHER, 'Storm')} AS Weather_Condition",
            f"{case('o_orderkey % 4', _ROADS, 'Under Construction')} AS Road_Condition",
            f"{case('floor(o_totalprice) % 4', _SEVERITIES, 'Fatal')} AS Accident_Severity",
            "CAST(1 + floor(o_totalprice / 1000) % 4 AS INT) AS Number_of_Vehicles",
            "CAST(o_custkey % 10 AS INT) AS Casualties",
            f"{case('o_orderstatus', _DENSITIES, 'High')} AS Traffic_Density",
        )
    )
