"""Registered queries: every operator over the whole benchmark tables.

Each takes ``(spark, sf_dir)`` and returns a frame. Keys start with the operator's id.
"""

from collections.abc import Callable
from functools import lru_cache, reduce
from types import SimpleNamespace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow import fixed_values as V
from cityflow import schemas
from cityflow.functions import kpi, temporal
from cityflow.functions.numeric import units
from cityflow.functions.text import case, columns
from cityflow.operators import evaluation, model_data, quality, star, training
from cityflow.plans import features, jobs, lake, views, warehouse
from cityflow.session import configure, scratch_path
from cityflow.sources import driver_tables as source
from cityflow.sources import files
from cityflow.streaming import alarms, dead_letters, ingest, transitions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


# ---------------------------------------------------------------- inputs


def sensor_raw(spark, sf_dir):
    return source.sensor_raw(spark, sf_dir)


def accident_raw(spark, sf_dir):
    return source.accident_raw(spark, sf_dir)


def sensor(spark, sf_dir):
    return features.sensor_features(sensor_raw(spark, sf_dir))


def accident(spark, sf_dir):
    return features.accident_features(accident_raw(spark, sf_dir))


@lru_cache(maxsize=4)
def stored_star(spark: SparkSession, sf_dir: str) -> SimpleNamespace:
    """The star schema as a load leaves it: dimensions first, then the facts that refer to them, by month.
    Written once per folder; views, model and reports read it."""
    path = scratch_path(spark, "star")
    plain = warehouse.Star(spark, sensor(spark, sf_dir), accident(spark, sf_dir), source.REGION_ZONES)
    warehouse.store(plain.dimensions(), path)
    dims = warehouse.open_tables(spark, path)
    facts = warehouse.Star(
        spark, sensor(spark, sf_dir), accident(spark, sf_dir), source.REGION_ZONES, lambda: dims["dim_weather"]
    )
    warehouse.store({"fact_traffic": facts.traffic, "fact_accident": facts.accidents}, path)
    tables = warehouse.open_tables(spark, path)
    return SimpleNamespace(
        location=tables["dim_location"], vehicle=tables["dim_vehicle"], weather=tables["dim_weather"], date=tables["dim_date"],
        traffic=tables["fact_traffic"], accidents=tables["fact_accident"],
    )


def warehouse_of(spark, sf_dir) -> warehouse.Star:
    """The star schema derived from the raw records, with the stored weather dimension."""
    return warehouse.Star(
        spark, sensor(spark, sf_dir), accident(spark, sf_dir), source.REGION_ZONES,
        lambda: stored_star(spark, sf_dir).weather,
    )


def _partial_location(spark):
    """All zones but one, to give the lookups and checks something to find."""
    known = {name: zone for name, zone in source.REGION_ZONES.items() if name != "ASIA"}
    return star.dim_location(spark, known)


def _probability(multiplier: int) -> str:
    """Deterministic stand-in for a model's probability."""
    return f"accident_pk * {multiplier} % 1000 / 1000D"


def risk(spark, sf_dir):
    """Score fixture in the shape of the scored table; needs no training."""
    rows = accident(spark, sf_dir).selectExpr(
        "Accident_ID AS accident_id", "Location AS location_name", V.TARGET, f"{_probability(37)} AS p"
    )
    return evaluation.risk_table(rows, "p", "IF(p >= 0.5, 1, 0)")


def _as_csv(raw: DataFrame, schema: T.StructType) -> DataFrame:
    text = f"date_format(Date_Time, '{V.TIMESTAMP_FORMAT}') AS Date_Time"
    return raw.selectExpr(*[text if name == "Date_Time" else name for name in schema.fieldNames()])


# ---------------------------------------------------------------- sources and sinks


def _csv_round_trip(spark, raw: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    _as_csv(raw, schema).write.option("header", True).csv(path)
    rows = files.read_csv(spark, path, schema)
    return rows.selectExpr("*", f"{temporal.parse_ts('Date_Time')} AS DateTime").drop("Date_Time", schemas.CORRUPT)


@query
def src1_csv_sensor(spark, sf_dir):
    return _csv_round_trip(spark, sensor_raw(spark, sf_dir), schemas.RAW_SENSOR, "raw-sensor")


@query
def src2_csv_accident(spark, sf_dir):
    return _csv_round_trip(spark, accident_raw(spark, sf_dir), schemas.RAW_ACCIDENT, "raw-accident")


@query
def src3_parquet_prefix(spark, sf_dir):
    """Two objects under one prefix read as one table."""
    path = scratch_path(spark, "processed")
    columns = ["traffic_pk", "Location", "congestion_index"]
    rows = sensor(spark, sf_dir).select(*columns, "Congestion_Level")
    high = F.col("Congestion_Level") == "High"
    files.write_replace(rows.filter(high).select(*columns), f"{path}/high")
    files.write_replace(rows.filter(~high).select(*columns), f"{path}/rest")
    schema = T.StructType(
        [
            T.StructField("traffic_pk", T.LongType()),
            T.StructField("Location", T.StringType()),
            T.StructField("congestion_index", T.DoubleType()),
        ]
    )
    return files.read_parquet(spark, path, schema, recursive=True)


@query
def src4_table_read(spark, sf_dir):
    built = stored_star(spark, sf_dir)
    views.register(
        spark,
        {
            "fact_accident": built.accidents, "dim_location": built.location, "dim_weather": built.weather,
            "dim_vehicle": built.vehicle,
        },
    )
    return files.read_table(
        spark,
        """
        SELECT a.accident_id, l.location_name, w.weather_condition, v.vehicle_type, a.risk_score
        FROM fact_accident a
        JOIN dim_location l ON a.location_id = l.location_id
        JOIN dim_weather w ON a.weather_id = w.weather_id
        JOIN dim_vehicle v ON a.vehicle_id = v.vehicle_id
        """,
    )


@query
def snk1_parquet_overwrite(spark, sf_dir):
    """Written twice, by month; the second run replaces the first."""
    path = scratch_path(spark, "accident")
    rows = accident(spark, sf_dir).select("accident_pk", "year", "month", "risk_score", "hazard_level")
    for _ in range(2):
        files.write_replace(rows, path, partition_by=["year", "month"])
    return spark.read.parquet(path)


@query
def snk2_idempotent_append(spark, sf_dir):
    """The whole table appended twice onto a part of it gives the table once."""
    path = scratch_path(spark, "readings")
    rows = sensor_raw(spark, sf_dir).select("traffic_pk", "Sensor_ID", "Location", "Congestion_Level")
    files.write_replace(rows.filter(F.col("Congestion_Level") == "High"), path)
    for _ in range(2):
        files.write_append(files.append_new(rows, spark.read.parquet(path), "traffic_pk"), path)
    return spark.read.parquet(path)


@lru_cache(maxsize=4)
def loaded_in_batches(spark: SparkSession, sf_dir: str) -> str:
    """A warehouse loaded with a batch of each source, a second one appended twice, and the first once more.

    The second batch repeats readings, and holds accidents of the first one and some ids twice.
    """
    root, features_of = scratch_path(spark, "batches"), {"sensor": sensor, "accident": accident}
    chosen = {
        "sensor": ("Congestion_Level = 'High'", ("Congestion_Level <> 'High'", "Congestion_Level = 'Low'")),
        "accident": ("accident_pk % 2 = 0", ("accident_pk % 2 = 1", "accident_pk % 10 = 0", "accident_pk % 14 = 7")),
    }
    for name, (first, second) in chosen.items():
        rows = features_of[name](spark, sf_dir)
        files.write_replace(rows.filter(first), f"{root}/first/{name}")
        files.write_replace(reduce(DataFrame.unionByName, [rows.filter(c) for c in second]), f"{root}/second/{name}")
    path = scratch_path(spark, "warehouse")
    paths = {batch: (f"{root}/{batch}/sensor", f"{root}/{batch}/accident") for batch in ("first", "second")}
    jobs.load_job(spark, *paths["first"], path, source.REGION_ZONES, check=False)
    for batch in ("second", "second", "first"):
        jobs.append_job(spark, *paths[batch], path, check=False)
    return path


@query
def snk2_rerun_safe_load(spark, sf_dir):
    """Rows of every table after batches were loaded again, and how many of them have a key of their own."""
    path = loaded_in_batches(spark, sf_dir)
    tables = warehouse.open_tables(spark, path)
    keys = {
        "fact_traffic": "traffic_pk", "fact_accident": "accident_pk", "dim_date": "date_id", "dim_weather": "weather_condition",
        "reject_traffic": "traffic_pk", "reject_accident": "accident_pk",
    }
    tables |= {name: warehouse.open_rejects(spark, path, name) for name in keys if name.startswith("reject")}
    counts = [
        tables[name].agg(*columns(["count(*) AS row_count", f"count(DISTINCT {key}) AS keys"])).selectExpr(f"'{name}' AS table_name", "*")
        for name, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def snk4_load_audit(spark, sf_dir):
    """What was counted while the batches were written, without zeros."""
    audit = warehouse.open_audit(spark, loaded_in_batches(spark, sf_dir)).filter("row_count > 0")
    return audit.groupBy("table_name", "measure").agg(*columns(["count(*) AS batches", "sum(row_count) AS row_count"]))


@query
def adh7_month_of_trend(spark, sf_dir):
    """SQL over a stored view: the months of a quarter, whose rows alone are read."""
    warehouse.open_views(spark, loaded_in_batches(spark, sf_dir))
    return files.read_table(
        spark, "SELECT year, month, total_accidents, total_casualties FROM vw_monthly_trend WHERE year = 2024 AND month IN (1, 2, 3)"
    )


def _of_batches(name: str) -> Query:
    def run(spark, sf_dir):
        return warehouse.open_views(spark, loaded_in_batches(spark, sf_dir))[name]

    return run


# Views merged from the cells that the loads of several batches left, some of them loaded again.
for _key, _name in {"vw1_merged_location_summary": "vw_location_summary", "vw2_merged_hourly_profile": "vw_hourly_profile"}.items():
    _run = _of_batches(_name)
    _run.__name__ = _key
    query(_run)


@query
def snk3_replace_table(spark, sf_dir):
    """Replacing a table also replaces its columns."""
    path = scratch_path(spark, "risk")
    files.write_replace(accident_raw(spark, sf_dir).select("accident_pk", "Location"), path)
    files.write_replace(risk(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def snk4_row_audit(spark, sf_dir):
    """Rows written per feature table, counted while they are written."""
    counts = []
    for name, frame in (("sensor", sensor(spark, sf_dir)), ("accident", accident(spark, sf_dir))):
        counted, observation = files.observed(frame, name)
        files.write_replace(counted, scratch_path(spark, name))
        counts.append((name, observation.get["row_count"]))
    return spark.createDataFrame(counts, "table_name string, row_count bigint")


# ---------------------------------------------------------------- time features


@query
def tmp1_parse_timestamp(spark, sf_dir):
    """Text to timestamp; the text of some rows is in another format and gives null."""
    text = f"date_format(Date_Time, IF(Congestion_Level = 'Low', 'dd/MM/yyyy', '{V.TIMESTAMP_FORMAT}')) AS t"
    rows = sensor_raw(spark, sf_dir).selectExpr("traffic_pk", text)
    return rows.selectExpr("traffic_pk", f"{temporal.parse_ts('t')} AS DateTime")


def _timed(spark, sf_dir):
    both = [
        source.table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "o_orderdate AS ts"),
        source.table(spark, sf_dir, "events").selectExpr("event_id AS id", "ts"),
    ]
    return reduce(DataFrame.unionAll, both)


@query
def tmp2_temporal_parts(spark, sf_dir):
    parts = temporal.with_temporal(_timed(spark, sf_dir), "ts")
    return parts.select("id", "year", "month", "day", "hour", "quarter", "day_of_week")


@query
def tmp3_is_weekend(spark, sf_dir):
    flag = f"{temporal.is_weekend('ts')} AS is_weekend"
    return _timed(spark, sf_dir).selectExpr("id", "CAST(to_date(ts) AS STRING) AS d", flag)


@query
def tmp4_is_peak_hour(spark, sf_dir):
    return sensor(spark, sf_dir).select("traffic_pk", "hour", "is_peak_hour")


@query
def tmp5_time_of_day(spark, sf_dir):
    return sensor(spark, sf_dir).select("traffic_pk", "hour", "time_of_day")


@query
def tmp6_calendar(spark, sf_dir):
    rest = ("month_name", "month_sort", "week", "day_name", "day_of_week_num")
    dated = temporal.with_calendar(_timed(spark, sf_dir), "ts")
    return dated.selectExpr("id", "CAST(date_only AS STRING) AS date_only", *rest)


# ---------------------------------------------------------------- KPIs


@query
def kpi1_congestion_index(spark, sf_dir):
    return sensor(spark, sf_dir).select("traffic_pk", "congestion_index")


@query
def kpi2_speed_band(spark, sf_dir):
    return sensor(spark, sf_dir).select("traffic_pk", "Average_Speed", "speed_category")


@query
def kpi3_volume_band(spark, sf_dir):
    return sensor(spark, sf_dir).select("traffic_pk", "Vehicle_Count", "volume_band")


@query
def kpi4_risk_score(spark, sf_dir):
    return accident(spark, sf_dir).select("accident_pk", "severity_score", "risk_score")


@query
def kpi5_hazard_level(spark, sf_dir):
    return accident(spark, sf_dir).select("accident_pk", "hazard_level")


@query
def kpi6_adverse_weather(spark, sf_dir):
    return accident(spark, sf_dir).select("accident_pk", "Weather_Condition", "adverse_weather")


@query
def kpi7_hazardous_road(spark, sf_dir):
    return accident(spark, sf_dir).select("accident_pk", "Road_Condition", "hazardous_road")


@query
def kpi8_fatal_or_severe(spark, sf_dir):
    return accident(spark, sf_dir).select("accident_pk", "Accident_Severity", "is_fatal_or_severe")


@query
def kpi9_traffic_density(spark, sf_dir):
    return accident(spark, sf_dir).select("accident_pk", "Traffic_Density", "traffic_density_num")


@query
def kpi10_vehicle_class(spark, sf_dir):
    return accident(spark, sf_dir).select("accident_pk", "Vehicle_Type", "vehicle_class")


@query
def kpi11_status(spark, sf_dir):
    return sensor(spark, sf_dir).groupBy("sensor_status").agg(F.count(F.lit(1)).alias("readings"))


@query
def prj1_conform(spark, sf_dir):
    columns = ["traffic_pk", *star.TRAFFIC_NAMES.values(), "congestion_index", "speed_category"]
    return star.conform(sensor(spark, sf_dir), star.TRAFFIC_NAMES, columns)


@query
def fun1_field_position(spark, sf_dir):
    """Place of a label in a list, 0 if it is not listed."""
    listed = ("Fatal", "Severe", "Moderate")
    return accident_raw(spark, sf_dir).selectExpr(
        "accident_pk", f"{kpi.position_in('Accident_Severity', *listed)} AS place"
    )


# ---------------------------------------------------------------- star schema


@query
def dim1_location(spark, sf_dir):
    """Zones with their accident counts: the dimension is literal, the counts are data."""
    counts = accident_raw(spark, sf_dir).groupBy("Location").agg(F.count(F.lit(1)).alias("accidents"))
    zones = star.dim_location(spark, source.REGION_ZONES)
    joined = zones.join(counts, F.col("location_name") == F.col("Location"), "left").drop("Location")
    return joined.fillna(0, ["accidents"])


@query
def dim2_vehicle(spark, sf_dir):
    counts = accident_raw(spark, sf_dir).groupBy("Vehicle_Type").agg(F.count(F.lit(1)).alias("accidents"))
    kinds = star.dim_vehicle(spark)
    joined = kinds.join(counts.withColumnRenamed("Vehicle_Type", "t"), F.col("vehicle_type") == F.col("t"), "left")
    return joined.drop("t").fillna(0, ["accidents"])


@query
def dim3_weather(spark, sf_dir):
    return star.dim_weather(accident_raw(spark, sf_dir)).drop("weather_id")


@query
def dim4_date(spark, sf_dir):
    dates = warehouse_of(spark, sf_dir).date
    return dates.withColumn("date_only", F.col("date_only").cast("string"))


@query
def dim5_weather_keys(spark, sf_dir):
    return star.dim_weather(accident_raw(spark, sf_dir)).select("weather_id", "weather_condition")


@query
def dim5_date_keys(spark, sf_dir):
    """Consecutive keys in time order."""
    dates = star.dim_date_sequential(sensor_raw(spark, sf_dir), accident_raw(spark, sf_dir), ts="Date_Time")
    return dates.select("date_id", "full_datetime")


@query
def dim5_fact_keys(spark, sf_dir):
    """Accidents numbered 1.. without a global sort: the keys are distinct and leave no gap."""
    keyed = star.with_row_keys(accident_raw(spark, sf_dir), ["Accident_ID"], "key")
    checks = ["count(*) AS n", "min(key) AS first", "max(key) AS last", "count(DISTINCT key) AS different"]
    return keyed.agg(*columns(checks))


@query
def dim6_resolve(spark, sf_dir):
    """Accidents found in a dimension that lacks a zone, and with key 0 those not found."""
    found, rejects = star.resolve(
        accident_raw(spark, sf_dir), _partial_location(spark), {"Location": "location_name"}, "location_id"
    )
    return found.select("accident_pk", "location_id").unionByName(
        rejects.selectExpr("accident_pk", "0L AS location_id")
    )


@query
def dim7_fact_traffic(spark, sf_dir):
    return warehouse_of(spark, sf_dir).traffic


@query
def dim8_fact_accident(spark, sf_dir):
    return warehouse_of(spark, sf_dir).accidents


@query
def dim8_accident_rejects(spark, sf_dir):
    """Accidents left out of the facts, with the constraints they break."""
    rejects = star.accident_rejects(
        accident(spark, sf_dir), _partial_location(spark), star.dim_vehicle(spark), stored_star(spark, sf_dir).weather
    )
    return rejects.selectExpr("accident_pk", "array_join(failed, ',') AS failed")


# ---------------------------------------------------------------- data quality


@query
def dq1_null_counts(spark, sf_dir):
    keyed = star.look_up(
        sensor(spark, sf_dir), _partial_location(spark), "Location", "location_name", "location_id"
    )
    return quality.null_counts(keyed, ["Sensor_ID", "location_id", "Vehicle_Count", "congestion_index"])


@query
def dq2_duplicates(spark, sf_dir):
    return quality.duplicates(source.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq2_unique_accidents(spark, sf_dir):
    """Accidents whose id is not unique; there is none."""
    return quality.duplicates(stored_star(spark, sf_dir).accidents, "accident_id")


@query
def dq3_orphans(spark, sf_dir):
    return quality.orphans(
        sensor_raw(spark, sf_dir), _partial_location(spark), {"Location": "location_name"}
    )


@query
def dq3_orphan_dates(spark, sf_dir):
    """Time keys of traffic facts that no accident shares."""
    built = stored_star(spark, sf_dir)
    dates = star.dim_date(accident_raw(spark, sf_dir), ts="Date_Time")
    return quality.orphans(built.traffic, dates, {"date_id": "date_id"})


@query
def dq5_quality_report(spark, sf_dir):
    """Every declared constraint over all six tables, some of whose rows are spoilt on the way: values
    taken out, ids and names repeated, a zone and some times removed from their dimensions."""
    built = stored_star(spark, sf_dir)
    spoilt = {
        "dim_location": _partial_location(spark),
        "dim_vehicle": built.vehicle.withColumn("vehicle_class", F.expr("IF(vehicle_id = 2, NULL, vehicle_class)")),
        "dim_weather": built.weather.withColumn("weather_condition", F.expr("IF(weather_id <= 2, 'Clear', weather_condition)")),
        "dim_date": built.date.filter("hour <> 7").withColumn("week", F.expr("IF(hour = 8, NULL, week)")),
        "fact_traffic": built.traffic.withColumn("vehicle_count", F.expr("IF(traffic_pk % 7 = 0, NULL, vehicle_count)")),
        "fact_accident": built.accidents.withColumns(
            {
                "accident_id": F.expr("IF(accident_pk % 11 = 0, 'again', IF(accident_pk % 13 = 0, NULL, accident_id))"),
                "road_condition": F.expr("IF(accident_pk % 5 = 0, NULL, road_condition)"),
            }
        ),
    }
    return warehouse.report(spoilt)


@query
def dq4_bad_values(spark, sf_dir):
    """Values outside the documented domains; two periods of the day are not documented."""
    dates = warehouse_of(spark, sf_dir).date
    return quality.domain_report(dates, {"time_of_day": V.DOCUMENTED_DOMAINS["time_of_day"], "is_weekend": (0, 1)})


# ---------------------------------------------------------------- views


def _view(name: str) -> Query:
    needs = {
        "location_summary": ("accidents", "traffic", "location"),
        "location_summary_fanout": ("accidents", "traffic", "location"),
        "hourly_profile": ("accidents", "traffic"),
        "hourly_profile_fanout": ("accidents", "traffic"),
        "monthly_trend": ("accidents",),
        "congestion_hotspots": ("traffic", "location"),
        "weather_risk": ("accidents", "weather"),
        "severity_by_location": ("accidents", "location"),
        "road_condition_risk": ("accidents",),
    }[name]

    def run(spark, sf_dir):
        built = stored_star(spark, sf_dir)
        view = getattr(views, name)(*[getattr(built, frame) for frame in needs])
        return views.ordered(f"vw_{name}", view)

    return run


for _key, _name in {
    "vw1_location_summary": "location_summary",
    "vw1f_location_summary_fanout": "location_summary_fanout",
    "vw2_hourly_profile": "hourly_profile",
    "vw2f_hourly_profile_fanout": "hourly_profile_fanout",
    "vw3_monthly_trend": "monthly_trend",
    "vw4_congestion_hotspots": "congestion_hotspots",
    "vw5_weather_risk": "weather_risk",
    "vw6_severity_by_location": "severity_by_location",
    "vw7_road_condition_risk": "road_condition_risk",
}.items():
    _run = _view(_name)
    _run.__name__ = _key
    query(_run)


@query
def vw8_ml_location_risk(spark, sf_dir):
    return views.ordered("vw_ml_location_risk", views.ml_location_risk(risk(spark, sf_dir)))


@query
def vw9_row_counts(spark, sf_dir):
    built = stored_star(spark, sf_dir)
    return views.all_row_counts(built.accidents, built.traffic, built.location, built.weather, risk(spark, sf_dir))


# ---------------------------------------------------------------- lake queries


@query
def adh1_hazard_distribution(spark, sf_dir):
    return lake.distribution(accident(spark, sf_dir), "hazard_level").orderBy(F.desc("Count"))


@query
def adh2_hourly_risk(spark, sf_dir):
    return lake.hourly_risk(accident(spark, sf_dir)).orderBy("hour")


@query
def adh3_traffic_by_location(spark, sf_dir):
    return lake.traffic_by_location(sensor(spark, sf_dir)).orderBy(F.desc("Avg_Congestion_Index"))


@query
def adh4_weather_road(spark, sf_dir):
    return lake.weather_road(accident(spark, sf_dir)).orderBy(F.desc("Avg_Risk"))


@query
def adh5_headline(spark, sf_dir):
    return lake.headline(accident(spark, sf_dir), sensor(spark, sf_dir))


@query
def adh6_peak_hour(spark, sf_dir):
    return lake.peak_hour(accident(spark, sf_dir))


@query
def adh7_sql_surface(spark, sf_dir):
    """Plain SQL over registered feature tables and views."""
    built = stored_star(spark, sf_dir)
    views.register(
        spark,
        {
            "sensor": sensor(spark, sf_dir),
            "vw_location_summary": views.location_summary(built.accidents, built.traffic, built.location),
        },
    )
    return files.read_table(
        spark,
        """
        SELECT s.Location AS location_name, s.time_of_day, count(*) AS readings,
               max(s.Vehicle_Count) AS peak_vehicles, max(v.fatal_severe_pct) AS zone_fatal_severe_pct
        FROM sensor s JOIN vw_location_summary v ON s.Location = v.location_name
        GROUP BY s.Location, s.time_of_day
        """,
    )


# ---------------------------------------------------------------- model data and metrics


def model_features(spark, sf_dir):
    built = stored_star(spark, sf_dir)
    return model_data.features(built.accidents, built.location, built.vehicle, built.weather)


@query
def mlp1_features(spark, sf_dir):
    return model_features(spark, sf_dir)


@query
def mlp2_label_encode(spark, sf_dir):
    encoded = model_data.label_encode(model_features(spark, sf_dir))
    return encoded.select("accident_id", *V.CATEGORICAL_FEATURES)


@query
def mlp3_class_balance(spark, sf_dir):
    return model_data.class_balance(accident(spark, sf_dir))


@query
def mlp4_hash_split(spark, sf_dir):
    train, test = model_data.hash_split(accident(spark, sf_dir), "Accident_ID")
    part = "Accident_ID", V.TARGET
    return train.select(*part, F.lit("train").alias("part")).unionByName(
        test.select(*part, F.lit("test").alias("part"))
    )


@query
def mlp4_stratified_split(spark, sf_dir):
    rows = accident(spark, sf_dir).select("Accident_ID", V.TARGET)
    split = model_data.stratified_split(rows, "Accident_ID", V.TARGET)
    return split.select("Accident_ID", V.TARGET, F.col("is_test").cast("int").alias("is_test"))


@query
def mlp5_standardise(spark, sf_dir):
    """Rows of either part scaled by the training rows' statistics."""
    columns = ["hour", "Number_of_Vehicles", "traffic_density_num", "adverse_weather"]
    train, test = model_data.hash_split(accident(spark, sf_dir), "Accident_ID")
    own, other = model_data.standardise(train, test, columns)
    return own.unionByName(other).select("accident_pk", *[F.round(c, 6).alias(c) for c in columns])


def _scored(spark, sf_dir, multiplier: int = 37):
    rows = accident(spark, sf_dir).selectExpr("Accident_ID", V.TARGET, f"{_probability(multiplier)} AS p1")
    return rows.selectExpr("*", "IF(p1 >= 0.5, 1, 0) AS predicted")


@query
def mlp7_metrics(spark, sf_dir):
    return evaluation.metrics(_scored(spark, sf_dir), "p1", "predicted", V.TARGET)


# Multipliers of the stand-in scores, one per model.
_STAND_INS = {"Random Forest": 37, "Gradient Boosting": 91, "Logistic Regression": 113}


@query
def mlp10_comparison(spark, sf_dir):
    """Comparison table over stand-in scores; ``mlp10_trained_comparison`` trains."""
    rows = []
    for name, multiplier in _STAND_INS.items():
        scored = _scored(spark, sf_dir, multiplier)
        folds = model_data.stratified_folds(scored, "Accident_ID", V.TARGET, V.CV_FOLDS)
        measured = evaluation.metrics(scored, "p1", "predicted", V.TARGET)
        by_fold = evaluation.fold_f1(folds, "fold", "predicted", V.TARGET)
        parts = measured.unionByName(by_fold, allowMissingColumns=True)  # a row each, side by side below
        rows.append(parts.agg(*[F.max(c).alias(c) for c in parts.columns]).withColumn("model", F.lit(name)))
    return evaluation.compare(reduce(DataFrame.unionByName, rows)).withColumn("selected", F.col("selected").cast("int"))


@query
def mlp12_tier_distribution(spark, sf_dir):
    return evaluation.tier_distribution(risk(spark, sf_dir))


@query
def mlp9_tiers(spark, sf_dir):
    """The scored table over stand-in scores; ``mlp9_score`` trains."""
    return risk(spark, sf_dir)


# ---------------------------------------------------------------- trained models
#
# The models are trained in full. Another library's fit cannot match digit by digit, so the queries
# return what SQL can state of it: which rows went where, and whether what must hold does.


@lru_cache(maxsize=4)
def encoded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded features with parts and folds, written once because training reads them many times."""
    named = model_features(spark, sf_dir).selectExpr("*", "location_name AS zone")
    return training.materialise(training.with_parts(model_data.label_encode(named), "accident_id"), "encoded")


def train_rows(spark, sf_dir):
    return encoded_rows(spark, sf_dir).filter("NOT is_test")


@lru_cache(maxsize=4)
def trained_models(spark: SparkSession, sf_dir: str) -> dict[str, training.Trained]:
    """The three models with their test metrics; shared by the queries below."""
    return training.train_all(train_rows(spark, sf_dir), encoded_rows(spark, sf_dir).filter("is_test"))


@lru_cache(maxsize=4)
def validated_models(spark: SparkSession, sf_dir: str) -> dict[str, training.Trained]:
    """The same with their cross-validation."""
    return training.cross_validate(lambda: trained_models(spark, sf_dir), train_rows(spark, sf_dir))


def _within(*values: float) -> int:
    return int(all(v is not None and 0 <= v <= 1 for v in values))


@query
def mlp6_train(spark, sf_dir):
    """Rows and positives per model and part; metrics are shares; the linear model's fit is at rest,
    so its probabilities add up to the training part's positives."""
    rows = []
    for name, found in trained_models(spark, sf_dir).items():
        scored = training.predict(found.model, encoded_rows(spark, sf_dir))
        parts = scored.groupBy("is_test").agg(
            *columns(["count(*) AS n", f"sum({V.TARGET}) AS positives", f"sum(p1 - {V.TARGET}) AS gap"])
        )
        for part in parts.collect():
            at_rest = name != "Logistic Regression" or part["is_test"] or abs(part["gap"]) < 1e-3 * part["n"]
            rows.append(
                (name, "test" if part["is_test"] else "train", part["n"], part["positives"], _within(*found.scores.values()), int(at_rest))
            )
    return spark.createDataFrame(rows, "model string, part string, n bigint, positives bigint, metrics_ok int, at_rest int")


@query
def mlp8_cross_validation(spark, sf_dir):
    """Rows and positives per model and fold, and whether the folds' F1 is a share."""
    folds = train_rows(spark, sf_dir).groupBy("fold").agg(*columns(["count(*) AS n", f"sum({V.TARGET}) AS positives"]))
    checks = [(name, _within(t.cv_f1_mean, t.cv_f1_std)) for name, t in validated_models(spark, sf_dir).items()]
    rows = [
        (name, row["fold"], row["n"], row["positives"], ok) for name, ok in checks for row in folds.collect()
    ]
    return spark.createDataFrame(rows, "model string, fold int, n bigint, positives bigint, f1_ok int")


@query
def mlp9_score(spark, sf_dir):
    """Every accident scored by the best model: its zone and outcome, and whether class and tier follow
    from the probability."""
    best = training.best_of(trained_models(spark, sf_dir))
    scored = training.score(best.model, encoded_rows(spark, sf_dir))
    tier = kpi.risk_tier("predicted_risk_prob")
    return scored.selectExpr(
        "accident_id", "location_name", "actual_fatal_severe",
        "CAST(predicted_risk_prob BETWEEN 0 AND 1 AS INT) AS probability_ok",
        f"CAST(risk_tier = {tier} AS INT) AS tier_ok",
        "CAST(predicted_class = IF(predicted_risk_prob > 0.5, 1, 0) OR abs(predicted_risk_prob - 0.5) < 0.0001 AS INT) AS class_ok",
    )


@query
def mlp10_trained_comparison(spark, sf_dir):
    """The three trained models; one is selected, and none has a larger ROC area."""
    found = evaluation.compare(training.model_rows(spark, validated_models(spark, sf_dir)))
    best = training.best_of(trained_models(spark, sf_dir)).name
    return found.selectExpr("model", f"CAST(selected = (model = '{best}') AS INT) AS selection_ok")


@query
def mlp11_importance(spark, sf_dir):
    """Features and categories of every model; ranks count through and the shares add up to 1."""
    found = []
    for name, t in trained_models(spark, sf_dir).items():
        found.append(training.importances(t.model, spark).withColumn("model", F.lit(name)))
    ranked = reduce(DataFrame.unionByName, found)
    whole = ranked.groupBy("model").agg(
        *columns(["CAST(abs(sum(importance) - 1) < 0.01 AS INT) AS sum_ok", "count(DISTINCT rank) AS ranks", "max(rank) AS last"])
    )
    return ranked.join(whole, "model").select("model", "feature", "category", "sum_ok", "ranks", "last")


@query
def mlp13_run_log(spark, sf_dir):
    """A run of the stand-in scores, appended to the table of runs twice."""
    path = scratch_path(spark, "runs")
    scores = evaluation.metrics(_scored(spark, sf_dir), "p1", "predicted", V.TARGET).first().asDict()
    run = training.Trained("Random Forest", None, scores, 0.5)
    for _ in range(2):
        training.log_run(spark, run, accident(spark, sf_dir).count(), path)
    runs = files.read_parquet(spark, path, schemas.MODEL_RUNS)
    if runs.select("run_id").distinct().count() != 2:
        raise ValueError("two runs must be told apart")
    return runs.drop("run_id", "logged_at")


@query
def mlp14_saved_model(spark, sf_dir):
    """The best model saved and loaded again scores every accident as before."""
    path = scratch_path(spark, "model")
    best = training.best_of(trained_models(spark, sf_dir)).model
    training.save(best, path)
    before, after = (training.score(m, encoded_rows(spark, sf_dir)) for m in (best, training.load(path)))
    both = before.join(after.selectExpr("accident_id", "predicted_risk_prob AS p", "risk_tier AS t"), "accident_id")
    return both.agg(*columns(["count(*) AS n", "count_if(p <> predicted_risk_prob OR t <> risk_tier) AS differing"]))


@lru_cache(maxsize=4)
def stored_model(spark: SparkSession, sf_dir: str) -> str:
    """A model and its encoder, fitted to the accidents in weather other than clear, and saved."""
    rows = model_features(spark, sf_dir).filter("weather_condition <> 'Clear'")
    encoder = model_data.fit_encoder(rows)
    encoded = training.materialise(encoder.transform(rows), "later-encoded")
    candidate = training.candidates(encoded.count())["Logistic Regression"]
    path = scratch_path(spark, "later-model")
    training.save(training.with_encoder(encoder, training.fit(candidate, encoded)), path)
    return path


@query
def mlp9_score_later_rows(spark, sf_dir):
    """All accidents scored with the stored model, those in a weather it has not seen among them: the codes
    that it gives, and whether tier and class follow from the probability."""
    rows = model_features(spark, sf_dir).selectExpr("*", "location_name AS zone")
    model = training.load(stored_model(spark, sf_dir))
    codes = PipelineModel(model.stages[:2]).transform(rows).select("accident_id", *V.CATEGORICAL_FEATURES[1:])
    scored = training.score(model, rows).selectExpr(
        "accident_id", "location_name", "CAST(predicted_risk_prob BETWEEN 0 AND 1 AS INT) AS probability_ok",
        f"CAST(risk_tier = {kpi.risk_tier('predicted_risk_prob')} AS INT) AS tier_ok",
    )
    return codes.join(scored, "accident_id")


# ---------------------------------------------------------------- streaming


def _keys(spark, sf_dir):
    """Object keys such as an upload of each order and event would have."""
    orders = source.table(spark, sf_dir, "orders").selectExpr(
        "concat('raw/', o_orderpriority, '/ACCIDENT_', o_orderkey, '.csv') AS key"
    )
    kind = "CASE event_type WHEN 'error' THEN 'Sensor-accident' WHEN 'view' THEN 'notes' ELSE 'road_sensor' END"
    events = source.table(spark, sf_dir, "events").selectExpr(
        f"concat('raw/', event_type, '/', {kind}, '_', event_id, '.csv') AS key"
    )
    return orders.unionAll(events)


@query
def str1_routing(spark, sf_dir):
    return _keys(spark, sf_dir).selectExpr("key", f"array_join({ingest.routes_of('key')}, ',') AS jobs")


@query
def str1_ingest(spark, sf_dir):
    """Files of both kinds and of neither, ingested by the two jobs; the second run finds none new."""
    root = scratch_path(spark, "landing")
    out, checkpoint = scratch_path(spark, "processed"), scratch_path(spark, "checkpoint")
    readings, accidents = sensor_raw(spark, sf_dir), accident_raw(spark, sf_dir)
    for frame, schema, name in (
        (readings, schemas.RAW_SENSOR, "Road_Traffic_SENSOR_data"),
        (accidents, schemas.RAW_ACCIDENT, "traffic_accident_data"),
        (accidents, schemas.RAW_ACCIDENT, "unrelated"),
    ):
        _as_csv(frame, schema).write.option("header", True).csv(f"{root}/{name}")
    maxima = tuple(kpi.maxima_of(readings).first())  # once, not per batch
    for _ in range(2):
        for job in ingest.ingest_all(spark, root, out, checkpoint, maxima):
            job.awaitTermination()
    sensors = spark.read.parquet(f"{out}/sensor").selectExpr("'sensor' AS job", "Location", "congestion_index AS score")
    crashes = spark.read.parquet(f"{out}/accident").selectExpr("'accident' AS job", "Location", "risk_score AS score")
    totals = ["count(*) AS rows", f"sum({units('score')}) AS total_score"]
    return sensors.unionByName(crashes).groupBy("job", "Location").agg(*columns(totals))


@lru_cache(maxsize=4)
def ingested_files(spark: SparkSession, sf_dir: str) -> str:
    """Sensor files in three column orders, one that lacks a column and one that is empty, ingested in
    batches of two files; the second run finds nothing new."""
    root, out, checkpoint = (scratch_path(spark, name) for name in ("drop", "ingested", "ingest-checkpoint"))
    rows = _as_csv(sensor_raw(spark, sf_dir), schemas.RAW_SENSOR)
    names = rows.columns
    orders = {"High": names, "Moderate": names[::-1], "Low": [*names[2:], *names[:2]]}
    for level, order in orders.items():
        part = rows.filter(F.col("Congestion_Level") == level).select(order)
        part.coalesce(1).write.option("header", True).csv(f"{root}/sensor-{level}")
    rows.drop("Location").limit(5).coalesce(1).write.option("header", True).csv(f"{root}/sensor-lacking")
    rows.select(F.lit("")).limit(1).coalesce(1).write.text(f"{root}/sensor-empty")
    for _ in range(2):
        dead_letters.ingest_sensor(spark, root, out, checkpoint, 2).awaitTermination()
    return out


@query
def str1_quarantine(spark, sf_dir):
    """Good rows per congestion level, and the files set aside by reason."""
    out = ingested_files(spark, sf_dir)
    good = dead_letters.read_sensor(spark, out).groupBy("Congestion_Level").agg(F.expr("count(*) AS n"))
    bad = dead_letters.read_quarantine(spark, f"{out}/quarantine-sensor").groupBy("reason").agg(F.expr("count(*) AS n"))
    return good.selectExpr("'row' AS what", "Congestion_Level AS kind", "n").unionByName(
        bad.selectExpr("'file' AS what", "reason AS kind", "n")
    )


@query
def str2_calibrated_kpi(spark, sf_dir):
    """The index of readings that came in several batches, with the maxima that the batches left."""
    rows = dead_letters.read_sensor(spark, ingested_files(spark, sf_dir))
    return rows.groupBy("Location", "hour").agg(
        *columns(["count(*) AS readings", f"sum({units('congestion_index')}) AS total_index", "max(congestion_index) AS max_index"])
    )


def _drain(spark, stream: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", scratch_path(spark, f"{name}-checkpoint"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(path)


@query
def str2_incremental_kpi(spark, sf_dir):
    """Sensor KPIs of a stream of events, with the maxima of a calibration table."""
    calibration = tuple(kpi.maxima_of(sensor_raw(spark, sf_dir)).first())  # once, not per batch
    readings = source.readings_of(source.event_stream(spark, sf_dir), source.table(spark, sf_dir, "region"))
    rows = ingest.sensor_kpis(readings, calibration)
    wanted = ("traffic_pk", "Location", "hour", "congestion_index", "speed_category", "volume_band")
    return _drain(spark, rows.select(*wanted), "kpis")


def _failures(events: DataFrame) -> DataFrame:
    """An alarm per event type, which every fourth user's events breach."""
    return events.selectExpr("ts", "event_type AS name", "IF(user_id % 4 = 0, 1, 0) AS failed")


def _alarm_states(spark, sf_dir):
    return alarms.alarm(_failures(source.table(spark, sf_dir, "events")), "ts", "name", "failed")


@query
def str3_alarm(spark, sf_dir):
    return _alarm_states(spark, sf_dir)


@query
def str3_alarm_stream(spark, sf_dir):
    """The same as a stream; periods within the watermark's delay of the end are still open."""
    failures = _failures(source.event_stream(spark, sf_dir))
    return _drain(spark, alarms.alarm_stream(failures, "ts", "name", "failed"), "alarms")


@query
def str4_alarm_changes(spark, sf_dir):
    """Every change of an alarm, by a stream with keyed state and timers. A clock's heartbeat closes the period
    after the last one, so alarms that have fallen silent by then change as well."""
    events = source.table(spark, sf_dir, "events")
    clock = scratch_path(spark, "clock")
    period = f"floor(unix_seconds(max(ts)) / {V.ALARM_PERIOD_SECONDS}) * {V.ALARM_PERIOD_SECONDS}"
    upto = f"timestamp_seconds({period} + {2 * V.ALARM_PERIOD_SECONDS} + 601) AS ts"
    files.write_replace(events.selectExpr(upto).selectExpr("ts", "CAST(NULL AS STRING) AS name", "0 AS failed"), clock)
    ticks = spark.readStream.schema("ts timestamp, name string, failed int").parquet(clock)
    rows = _failures(source.event_stream(spark, sf_dir)).unionByName(ticks)
    return _drain(spark, transitions.alarm_changes(rows, "ts", "name", "failed"), "alarm-changes").selectExpr(
        "alarm_name", "changed_at", "state", "CAST(coalesce(total, 0) AS BIGINT) AS total"
    )


@query
def str4_alarm_filled(spark, sf_dir):
    return alarms.alarm_filled(_alarm_states(spark, sf_dir)).fillna(0, ["total"])


@query
def str4_alarm_two_periods(spark, sf_dir):
    return alarms.alarm_filled(_alarm_states(spark, sf_dir), periods_to_alarm=2).fillna(0, ["total"])


@query
def str5_alarm_status(spark, sf_dir):
    return alarms.alarm_status(_alarm_states(spark, sf_dir), prefix="c")
