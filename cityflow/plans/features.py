"""Feature tables: raw records plus time features and KPI columns."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cityflow import fixed_values as V
from cityflow.functions import kpi
from cityflow.functions.temporal import parse_ts, time_of_day, with_temporal
from cityflow.functions.text import literal


def _dated(raw: DataFrame) -> DataFrame:
    is_text = isinstance(raw.schema["Date_Time"].dataType, T.StringType)
    ts = parse_ts("Date_Time") if is_text else "CAST(Date_Time AS TIMESTAMP)"
    return with_temporal(raw.selectExpr("*", f"{ts} AS DateTime"))


def sensor_measures(raw: DataFrame) -> DataFrame:
    """What a reading says by itself: time features, bands and status, without the congestion index, which
    refers to the maxima of all readings."""
    return _dated(raw).selectExpr(
        "*",
        f"{kpi.speed_category('Average_Speed')} AS speed_category",
        f"{kpi.volume_band('Vehicle_Count')} AS volume_band",
        f"{time_of_day('hour')} AS time_of_day",
        f"{literal(V.SENSOR_STATUS)} AS sensor_status",
    )


def sensor_features(raw: DataFrame, maxima: DataFrame | tuple[float, float] | None = None) -> DataFrame:
    """KPI columns of sensor readings; ``maxima`` as in :func:`kpi.with_congestion_index`."""
    if maxima is None:
        maxima = kpi.maxima_of(raw)
    return kpi.with_congestion_index(_dated(raw), maxima=maxima).selectExpr(
        "*",
        f"{kpi.speed_category('Average_Speed')} AS speed_category",
        f"{kpi.volume_band('Vehicle_Count')} AS volume_band",
        f"{time_of_day('hour')} AS time_of_day",
        f"{literal(V.SENSOR_STATUS)} AS sensor_status",
    )


def accident_features(raw: DataFrame) -> DataFrame:
    """KPI columns of accident records."""
    scored = (
        _dated(raw)
        .selectExpr(
            "*",
            f"{kpi.severity_score('Accident_Severity')} AS severity_score",
            f"{kpi.log_casualties('Casualties')} AS log_cas",
        )
        .selectExpr("*", f"{kpi.risk_score('severity_score', 'log_cas', 'Number_of_Vehicles')} AS risk_score")
    )
    return scored.selectExpr(
        "*",
        f"{kpi.hazard_level('risk_score')} AS hazard_level",
        f"{kpi.flag_in('Weather_Condition', V.ADVERSE_WEATHER)} AS adverse_weather",
        f"{kpi.flag_in('Road_Condition', V.HAZARDOUS_ROADS)} AS hazardous_road",
        f"{kpi.flag_in('Accident_Severity', V.FATAL_OR_SEVERE)} AS is_fatal_or_severe",
        f"{kpi.ordinal('Traffic_Density', V.DENSITY_RANKS, V.TOP_DENSITY_RANK)} AS traffic_density_num",
        f"{kpi.vehicle_class('Vehicle_Type')} AS vehicle_class",
    )
