"""The analytical views over the star schema.

Conventions. Facts carry the time key of ``star.date_key``, so the hour or month of a row is
computed from the key and no view joins the date dimension. A view that needs a small dimension
aggregates first and joins the few result rows. ``COUNT(DISTINCT pk)`` is a plain count, since a
primary key is unique in its own table; that is what ``quality.duplicates`` verifies.

Two of the views combine both fact tables. Joining them on a shared key repeats every accident
once per reading, so sums inflate. ``location_summary`` and ``hourly_profile`` therefore stack the
two facts and aggregate once. The ``*_fanout`` versions give the inflated numbers of the literal
join, computed from per-key totals: cost grows with the rows, not with their product.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow import fixed_values as V
from cityflow.functions.kpi import position_in
from cityflow.functions.numeric import (
    avg_fixed,
    avg_of,
    hits,
    percent,
    ratio,
    sum_fixed,
    total,
    units,
    wide_ratio,
)
from cityflow.functions.temporal import is_peak, time_of_day
from cityflow.functions.text import columns, literal, one_of
from cityflow.operators.measures import HOUR, ROWS, Cells, Rows
from cityflow.operators.star import MONTH, key_time

_WIDE = "DECIMAL(38,0)"


def _named_zones(totals: DataFrame, location: DataFrame) -> DataFrame:
    zones = location.select("location_id", "location_name", "zone_type")
    return zones.join(totals, "location_id").drop("location_id")


def _severity_counts(m: Rows, suffix: str, severities: Sequence[str] = V.SEVERITY_ORDER) -> list[str]:
    return [f"{m.hits(f'accident_severity = {literal(s)}')} AS {s.lower()}_{suffix}" for s in severities]


def _stack(accidents: DataFrame, traffic: DataFrame) -> DataFrame:
    """Both facts, or their cells, in one frame; a row is null in the columns only the other one has."""
    if "n_accidents" in accidents.columns:
        return accidents.unionByName(traffic, allowMissingColumns=True)
    left = accidents.select(
        "accident_pk", "location_id", "date_id", "accident_severity", "casualties", "severity_score",
        "risk_score", "adverse_weather", "hazardous_road", "is_fatal_or_severe",
    )
    right = traffic.select(
        "traffic_pk", "location_id", "date_id", "vehicle_count", "average_speed", "congestion_level",
        "congestion_index",
    )
    return left.unionByName(right, allowMissingColumns=True)


# ---------------------------------------------------------------- location summary


def location_summary(accidents: DataFrame, traffic: DataFrame, location: DataFrame, m: Rows = ROWS) -> DataFrame:
    """One row per zone with accidents: accident KPIs, traffic volume and the accident rate."""
    n, vehicles = m.count("accident_pk"), f"coalesce({m.total('vehicle_count')}, 0)"
    measures = [
        f"{n} AS total_accidents",
        f"{m.total('casualties')} AS total_casualties",
        f"{m.avg_fixed('risk_score', 3)} AS avg_risk_score",
        f"{m.sum_fixed('risk_score', 2)} AS total_risk_score",
        f"{m.top('risk_score')} AS max_risk_score",
        f"{m.avg_of('severity_score', 3)} AS avg_severity_score",
        *_severity_counts(m, "count"),
        f"{m.total('is_fatal_or_severe')} AS fatal_severe_count",
        f"{percent(m.total('is_fatal_or_severe'), n)} AS fatal_severe_pct",
        f"{percent(m.total('adverse_weather'), n)} AS adverse_weather_pct",
        f"{percent(m.total('hazardous_road'), n)} AS hazardous_road_pct",
        f"{vehicles} AS total_vehicles",
        f"{m.avg_of('vehicle_count', 1)} AS avg_vehicles_per_reading",
        f"{m.avg_fixed('congestion_index', 4)} AS avg_congestion_index",
        f"{ratio(f'{n} * 1000', vehicles, 4)} AS accident_rate_per_1000_vehicles",
    ]
    zones = _stack(accidents, traffic).groupBy("location_id").agg(*columns(measures))
    return _named_zones(zones.filter("total_accidents > 0"), location)


def _per_key_totals(accidents: DataFrame, traffic: DataFrame, key: str) -> DataFrame:
    """Counts, sums and extremes of both facts per join key: one shuffle of partial totals."""

    def wide(aggregate: str, name: str) -> str:
        return f"CAST({aggregate} AS {_WIDE}) AS {name}"

    summed = (
        "casualties", "severity_score", "adverse_weather", "hazardous_road", "is_fatal_or_severe",
        "vehicle_count", "average_speed",
    )
    totals = [
        wide("count(accident_pk)", "n_a"),
        wide("count(traffic_pk)", "n_t"),
        *[wide(total(c), f"s_{c}") for c in summed],
        wide(f"sum({units('risk_score')})", "s_risk"),
        wide(f"sum({units('congestion_index')})", "s_congestion"),
        *[wide(hits(f"accident_severity = {literal(s)}"), f"n_{s.lower()}") for s in V.SEVERITY_ORDER],
        wide(hits("congestion_level = 'High'"), "n_high"),
        "max(risk_score) AS max_risk_score",
        "max(vehicle_count) AS peak_vehicles",
        "min(average_speed) AS min_speed_kmh",
        "max(congestion_index) AS max_congestion_index",
    ]
    return _stack(accidents, traffic).groupBy(key).agg(*columns(totals))


def _copies(n: str) -> str:
    """Times an outer join repeats a row that has ``n`` partners on the other side."""
    return f"greatest({n}, 1)"


def location_summary_fanout(accidents: DataFrame, traffic: DataFrame, location: DataFrame) -> DataFrame:
    """``location_summary`` as the literal join ``accidents LEFT JOIN traffic`` gives it.

    A zone has one row here, so totals are multiplied per row; inflated sums come as DOUBLE.
    """
    m = _copies("n_t")
    vehicles = "coalesce(s_vehicle_count * n_a, 0)"
    zones = (
        _per_key_totals(accidents, traffic, "location_id")
        .filter("n_a > 0")
        .selectExpr(
            "location_id",
            "CAST(n_a AS BIGINT) AS total_accidents",
            f"CAST(s_casualties * {m} AS DOUBLE) AS total_casualties",
            f"{wide_ratio('s_risk', 'n_a', 3, 4)} AS avg_risk_score",
            f"{wide_ratio(f's_risk * {m}', '1', 2, 4)} AS total_risk_score",
            "max_risk_score",
            f"{wide_ratio('s_severity_score', 'n_a', 3)} AS avg_severity_score",
            *[f"CAST(n_{s.lower()} * {m} AS DOUBLE) AS {s.lower()}_count" for s in V.SEVERITY_ORDER],
            f"CAST(s_is_fatal_or_severe * {m} AS DOUBLE) AS fatal_severe_count",
            f"{wide_ratio(f's_is_fatal_or_severe * {m} * 100', 'n_a', 1)} AS fatal_severe_pct",
            f"{wide_ratio('s_adverse_weather * 100', 'n_a', 1)} AS adverse_weather_pct",
            f"{wide_ratio('s_hazardous_road * 100', 'n_a', 1)} AS hazardous_road_pct",
            f"CAST({vehicles} AS DOUBLE) AS total_vehicles",
            f"{wide_ratio('s_vehicle_count', 'n_t', 1)} AS avg_vehicles_per_reading",
            f"{wide_ratio('s_congestion', 'n_t', 4, 4)} AS avg_congestion_index",
            f"{wide_ratio('n_a * 1000', vehicles, 4)} AS accident_rate_per_1000_vehicles",
        )
    )
    return _named_zones(zones, location)


# ---------------------------------------------------------------- hourly profile


def _with_hour(rows: DataFrame) -> DataFrame:
    """Cells have the hour; facts have the key of their time."""
    return rows if "hour" in rows.columns else rows.selectExpr("*", f"{HOUR} AS hour")


def _by_hour(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Group by hour of day; the names of the hours are written for the result rows only."""
    hours = _with_hour(df).groupBy("hour").agg(*columns(measures))
    return hours.selectExpr(
        "hour", f"{time_of_day('hour')} AS time_of_day", f"{is_peak('hour')} AS is_peak_hour",
        "* EXCEPT (hour)",
    )


def hourly_profile(accidents: DataFrame, traffic: DataFrame, dates: DataFrame | None = None, m: Rows = ROWS) -> DataFrame:
    """One row per hour of day: traffic and accident measures side by side.

    The date dimension also holds the timestamps of rejected rows. With ``dates`` their hours are
    listed too, as the published view does.
    """
    stacked = _stack(accidents, traffic)
    if dates is not None:
        listed = dates.select("date_id") if m is ROWS else dates.selectExpr(f"{HOUR} AS hour")
        stacked = stacked.unionByName(listed, allowMissingColumns=True)
    readings, n = m.count("traffic_pk"), m.count("accident_pk")
    return _by_hour(
        stacked,
        [
            f"{readings} AS sensor_reading_count",
            f"{m.avg_of('vehicle_count', 1)} AS avg_vehicles",
            f"{m.top('vehicle_count')} AS peak_vehicles",
            f"{m.avg_of('average_speed', 1)} AS avg_speed_kmh",
            f"{m.low('average_speed')} AS min_speed_kmh",
            f"{m.avg_fixed('congestion_index', 4)} AS avg_congestion_index",
            f"{m.top('congestion_index')} AS max_congestion_index",
            percent(m.hits("congestion_level = 'High'"), readings) + " AS high_congestion_pct",
            f"{n} AS accident_count",
            f"{m.total('casualties')} AS total_casualties",
            f"{m.avg_fixed('risk_score', 3)} AS avg_risk_score",
            f"{m.top('risk_score')} AS max_risk_score",
            f"{m.total('is_fatal_or_severe')} AS fatal_severe_count",
            f"{percent(m.total('is_fatal_or_severe'), n)} AS fatal_severe_pct",
        ],
    )


def hourly_profile_fanout(accidents: DataFrame, traffic: DataFrame) -> DataFrame:
    """``hourly_profile`` as the literal join of both facts on the timestamp gives it."""

    def of_accidents(x: str) -> str:
        return f"sum({x} * {_copies('n_t')})"

    def of_traffic(x: str) -> str:
        return f"sum({x} * {_copies('n_a')})"

    readings, n = "sum(n_t)", "sum(n_a)"
    severe = of_accidents("s_is_fatal_or_severe")
    return _by_hour(
        _per_key_totals(accidents, traffic, "date_id"),
        [
            f"CAST({readings} AS BIGINT) AS sensor_reading_count",
            f"{wide_ratio(of_traffic('s_vehicle_count'), of_traffic('n_t'), 1)} AS avg_vehicles",
            "max(peak_vehicles) AS peak_vehicles",
            f"{wide_ratio(of_traffic('s_average_speed'), of_traffic('n_t'), 1)} AS avg_speed_kmh",
            "min(min_speed_kmh) AS min_speed_kmh",
            f"{wide_ratio(of_traffic('s_congestion'), of_traffic('n_t'), 4, 4)} AS avg_congestion_index",
            "max(max_congestion_index) AS max_congestion_index",
            f"{wide_ratio(of_traffic('n_high') + ' * 100', readings, 1)} AS high_congestion_pct",
            f"CAST({n} AS BIGINT) AS accident_count",
            f"CAST({of_accidents('s_casualties')} AS DOUBLE) AS total_casualties",
            f"{wide_ratio(of_accidents('s_risk'), of_accidents('n_a'), 3, 4)} AS avg_risk_score",
            "max(max_risk_score) AS max_risk_score",
            f"CAST({severe} AS DOUBLE) AS fatal_severe_count",
            f"{wide_ratio(f'{severe} * 100', n, 1)} AS fatal_severe_pct",
        ],
    )


# ---------------------------------------------------------------- single-fact views

def _severe_pct(m: Rows) -> str:
    return f"{percent(m.total('is_fatal_or_severe'), m.n)} AS fatal_severe_pct"


def _condition_pcts(m: Rows) -> list[str]:
    return [
        f"{percent(m.total('adverse_weather'), m.n)} AS adverse_weather_pct",
        f"{percent(m.total('hazardous_road'), m.n)} AS hazardous_road_pct",
    ]


def _peak_pct(m: Rows) -> str:
    return f"{percent(m.total('is_peak_hour'), m.n)} AS peak_hour_pct"


def monthly_trend(accidents: DataFrame, m: Rows = ROWS) -> DataFrame:
    """One row per calendar month. Month names are written for the result rows only."""
    measures = [
        f"{m.n} AS total_accidents",
        f"{m.total('casualties')} AS total_casualties",
        f"{m.avg_of('casualties', 2)} AS avg_casualties_per_accident",
        *_severity_counts(m, "accidents"),
        f"{m.total('is_fatal_or_severe')} AS fatal_severe_count",
        _severe_pct(m),
        f"{m.avg_fixed('risk_score', 3)} AS avg_risk_score",
        f"{m.sum_fixed('risk_score', 2)} AS total_risk_score",
        *_condition_pcts(m),
        _peak_pct(m),
    ]
    # the month that stored facts are partitioned by lets a filter on it leave other months unread
    month = MONTH if MONTH in accidents.columns else f"trunc({key_time('date_id')}, 'month')"
    dated = accidents.selectExpr("*", f"{month} AS m")
    return (
        dated.groupBy("m")
        .agg(*columns(measures))
        .selectExpr(
            "year(m) AS year", "quarter(m) AS quarter", "month(m) AS month",
            "date_format(m, 'MMMM') AS month_name", "month(m) AS month_sort", "* EXCEPT (m)",
        )
    )


def congestion_hotspots(traffic: DataFrame, location: DataFrame, m: Rows = ROWS) -> DataFrame:
    """One row per zone and day period."""
    measures = [
        f"{m.n} AS sensor_readings",
        f"{m.avg_of('vehicle_count', 1)} AS avg_vehicles",
        f"{m.top('vehicle_count')} AS peak_vehicles",
        f"{m.avg_of('average_speed', 1)} AS avg_speed_kmh",
        f"{m.low('average_speed')} AS min_speed_kmh",
        f"{m.avg_fixed('congestion_index', 4)} AS avg_congestion_index",
        f"{m.top('congestion_index')} AS max_congestion_index",
        *[
            percent(m.hits(f"congestion_level = '{level}'"), m.n) + f" AS {level.lower()}_congestion_pct"
            for level in ("High", "Moderate", "Low")
        ],
    ]
    timed = _with_hour(traffic).selectExpr(
        "*", f"{time_of_day('hour')} AS time_of_day", f"{is_peak('hour')} AS is_peak_hour"
    )
    cells = timed.groupBy("location_id", "time_of_day", "is_peak_hour").agg(*columns(measures))
    return _named_zones(cells, location)


def weather_risk(accidents: DataFrame, weather: DataFrame, m: Rows = ROWS) -> DataFrame:
    """One row per weather and road condition."""
    measures = [
        f"{m.n} AS accidents",
        f"{m.total('casualties')} AS total_casualties",
        f"{m.avg_of('casualties', 2)} AS avg_casualties",
        f"{m.avg_of('severity_score', 3)} AS avg_severity_score",
        f"{m.avg_fixed('risk_score', 3)} AS avg_risk_score",
        f"{m.top('risk_score')} AS max_risk_score",
        *_severity_counts(m, "count", V.FATAL_OR_SEVERE),
        f"{m.total('is_fatal_or_severe')} AS fatal_severe_count",
        _severe_pct(m),
    ]
    cells = accidents.groupBy("weather_id", "road_condition", "hazardous_road").agg(*columns(measures))
    named = weather.selectExpr("weather_id", "weather_condition", "is_adverse AS is_adverse_weather")
    return named.join(cells, "weather_id").drop("weather_id").withColumnRenamed("hazardous_road", "is_hazardous_road")


def severity_by_location(accidents: DataFrame, location: DataFrame, m: Rows = ROWS) -> DataFrame:
    """One row per zone and severity, with its share of the zone's accidents."""
    measures = [
        f"{m.n} AS accident_count",
        f"{m.total('casualties')} AS total_casualties",
        f"{m.avg_of('casualties', 2)} AS avg_casualties",
        f"{m.avg_fixed('risk_score', 3)} AS avg_risk_score",
        f"{m.sum_fixed('risk_score', 2)} AS total_risk_score",
        *_condition_pcts(m),
    ]
    cells = accidents.groupBy("location_id", "accident_severity").agg(*columns(measures))
    share = percent("accident_count", "sum(accident_count) OVER (PARTITION BY location_name)")
    return _named_zones(cells, location).selectExpr("*", f"{share} AS pct_of_location_total")


def road_condition_risk(accidents: DataFrame, m: Rows = ROWS) -> DataFrame:
    """One row per road condition."""
    measures = [
        f"{m.top('hazardous_road')} AS is_hazardous",
        f"{m.n} AS total_accidents",
        f"{m.total('casualties')} AS total_casualties",
        f"{m.avg_of('casualties', 2)} AS avg_casualties",
        f"{m.avg_fixed('risk_score', 3)} AS avg_risk_score",
        f"{m.top('risk_score')} AS max_risk_score",
        f"{m.avg_of('severity_score', 3)} AS avg_severity_score",
        *_severity_counts(m, "count", V.FATAL_OR_SEVERE),
        f"{m.total('is_fatal_or_severe')} AS fatal_severe_count",
        _severe_pct(m),
        f"{m.avg_of('traffic_density_num', 3)} AS avg_traffic_density_num",
        _peak_pct(m),
    ]
    return accidents.groupBy("road_condition").agg(*columns(measures))


def ml_location_risk(risk: DataFrame, dangerous_from: float = V.DANGEROUS_FROM) -> DataFrame:
    """One row per zone over the scored accidents. The rating uses the unrounded average."""
    # Probabilities have 4 places, so the average is compared as whole numbers.
    limit = f"count(predicted_risk_prob) * {round(dangerous_from * 10**4)}"
    measures = [
        f"{avg_fixed('predicted_risk_prob', 4)} AS avg_predicted_risk",
        "min(predicted_risk_prob) AS min_predicted_risk",
        "max(predicted_risk_prob) AS max_predicted_risk",
        *[
            f"{hits(f'risk_tier = {literal(tier)}')} AS {tier.lower().replace(' ', '_')}_count"
            for tier in reversed(V.TIER_LABELS)
        ],
        f"{total('predicted_class')} AS predicted_fatal_severe",
        f"{total('actual_fatal_severe')} AS actual_fatal_severe",
        f"{percent(total('actual_fatal_severe'), "count(*)", 2)} AS actual_fatal_severe_pct",
        "count(*) AS total_accidents",
        f"IF(sum({units('predicted_risk_prob')}) >= {limit}, 'Dangerous', 'Caution') AS safety_rating",
    ]
    return risk.groupBy("location_name").agg(*columns(measures))


# ---------------------------------------------------------------- all views together


def _keys(rows: DataFrame, views: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct grouping keys of several views over one frame, which is read once: view_name and up to three
    parts as text."""
    parts = []
    for name, keys in views.items():
        padded = [*keys, "NULL", "NULL", "NULL"][:3]
        listed = ", ".join(f"CAST({k} AS STRING) AS {c}" for k, c in zip(padded, "abc"))
        parts.append(f"struct('{name}' AS view_name, {listed})")
    return rows.selectExpr(f"inline(array({', '.join(parts)}))").distinct()


_ZONED = ("vw_location_summary", "vw_congestion_hotspots", "vw_severity_by_location")


def all_row_counts(
    accidents: DataFrame,
    traffic: DataFrame,
    location: DataFrame,
    weather: DataFrame,
    risk: DataFrame,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Name and row count of each of :func:`all_views`.

    A view has a row per grouping key, so the keys of all views over a fact are found in one pass and
    counted; nothing else is computed.
    """
    month = MONTH if MONTH in accidents.columns else f"trunc({key_time('date_id')}, 'month')"
    found = [
        _keys(
            _with_hour(accidents),
            {
                "vw_location_summary": ["location_id"], "vw_hourly_profile": ["hour"], "vw_monthly_trend": [month],
                "vw_weather_risk": ["weather_id", "road_condition", "hazardous_road"],
                "vw_severity_by_location": ["location_id", "accident_severity"], "vw_road_condition_risk": ["road_condition"],
            },
        ),
        _keys(
            _with_hour(traffic),
            {
                "vw_hourly_profile": ["hour"],
                "vw_congestion_hotspots": ["location_id", time_of_day("hour"), is_peak("hour")],
            },
        ),
        _keys(risk, {"vw_ml_location_risk": ["location_name"]}),
    ]
    if dates is not None:
        found.append(_keys(dates, {"vw_hourly_profile": [HOUR]}))
    keys = reduce(DataFrame.unionByName, found).distinct()
    zones = location.selectExpr("CAST(location_id AS STRING) AS a", "true AS zone")
    kinds = weather.selectExpr("CAST(weather_id AS STRING) AS a", "true AS kind")
    named = keys.join(zones, "a", "left").join(kinds, "a", "left")
    counts = (
        named.filter(f"({one_of('view_name', _ZONED)}) <= coalesce(zone, false)")
        .filter("(view_name = 'vw_weather_risk') <= coalesce(kind, false)")
        .groupBy("view_name")
        .agg(F.expr("count(*) AS row_count"))
    )
    names = ", ".join(f"'{name}'" for name in ("vw_hourly_profile", "vw_monthly_trend", "vw_weather_risk", "vw_road_condition_risk", "vw_ml_location_risk", *_ZONED))
    listed = keys.sparkSession.sql(f"SELECT explode(array({names})) AS view_name")
    return listed.join(counts, "view_name", "left").fillna(0, ["row_count"])


_PRESENTATION = {
    "vw_hourly_profile": ["hour"],
    "vw_monthly_trend": ["year", "month_sort"],
    "vw_congestion_hotspots": ["location_name", "time_of_day"],
    "vw_weather_risk": ["-avg_risk_score"],
    "vw_severity_by_location": ["location_name", position_in("accident_severity", *V.SEVERITY_ORDER)],
    "vw_road_condition_risk": ["-avg_risk_score"],
    "vw_ml_location_risk": ["-avg_predicted_risk"],
}


def ordered(name: str, view: DataFrame) -> DataFrame:
    """The view in its presentation order; views are small, so this sorts a few rows."""
    keys = _PRESENTATION.get(name, [])
    order = [F.expr(k[1:]).desc() if k.startswith("-") else F.expr(k) for k in keys]
    return view.orderBy(*order) if order else view


def all_views(
    accidents: DataFrame,
    traffic: DataFrame,
    location: DataFrame,
    weather: DataFrame,
    risk: DataFrame,
    dates: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The eight views, over facts or over their cells (see ``measures``)."""
    over_cells = "n_accidents" in accidents.columns
    m, of_traffic = (Cells("n_accidents"), Cells("n_readings")) if over_cells else (ROWS, ROWS)
    return {
        "vw_location_summary": location_summary(accidents, traffic, location, m),
        "vw_hourly_profile": hourly_profile(accidents, traffic, dates, m),
        "vw_monthly_trend": monthly_trend(accidents, m),
        "vw_congestion_hotspots": congestion_hotspots(traffic, location, of_traffic),
        "vw_weather_risk": weather_risk(accidents, weather, m),
        "vw_severity_by_location": severity_by_location(accidents, location, m),
        "vw_road_condition_risk": road_condition_risk(accidents, m),
        "vw_ml_location_risk": ml_location_risk(risk),
    }


def register(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Make tables and views available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
