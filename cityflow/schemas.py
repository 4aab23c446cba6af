"""Explicit schemas. Nothing is inferred: inference costs a pass and can mistype ids."""

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

RAW_SENSOR = _struct(
    Sensor_ID=_S, Location=_S, Date_Time=_S, Vehicle_Count=_I, Average_Speed=_I, Congestion_Level=_S
)
RAW_ACCIDENT = _struct(
    Accident_ID=_S, Location=_S, Date_Time=_S, Vehicle_Type=_S, Weather_Condition=_S,
    Road_Condition=_S, Accident_Severity=_S, Number_of_Vehicles=_I, Casualties=_I, Traffic_Density=_S,
)

DIM_LOCATION = _struct(location_id=_L, location_name=_S, zone_type=_S)
DIM_VEHICLE = _struct(vehicle_id=_L, vehicle_type=_S, vehicle_class=_S)
DIM_WEATHER = _struct(weather_id=_L, weather_condition=_S, is_adverse=_I)
DIM_DATE = _struct(
    date_id=_L, full_datetime=T.TimestampType(), date_only=T.DateType(), year=_I, quarter=_I,
    month=_I, month_name=_S, month_sort=_I, week=_I, day_name=_S, day_of_week_num=_I, hour=_I,
    time_of_day=_S, is_peak_hour=_I, is_weekend=_I,
)
FACT_TRAFFIC = _struct(
    traffic_pk=_L, sensor_id=_S, location_id=_L, date_id=_L, vehicle_count=_I, average_speed=_I,
    congestion_level=_S, congestion_index=_D, speed_category=_S, volume_band=_S, sensor_status=_S,
)
FACT_ACCIDENT = _struct(
    accident_pk=_L, accident_id=_S, location_id=_L, date_id=_L, vehicle_id=_L, weather_id=_L,
    vehicle_type=_S, weather_condition=_S, road_condition=_S, accident_severity=_S,
    number_of_vehicles=_I, casualties=_I, traffic_density=_S, severity_score=_I, risk_score=_D,
    hazard_level=_S, adverse_weather=_I, hazardous_road=_I, is_peak_hour=_I,
    is_fatal_or_severe=_I, traffic_density_num=_I,
)
ACCIDENT_RISK = _struct(
    accident_id=_S, location_name=_S, predicted_risk_prob=_D, predicted_class=_I,
    actual_fatal_severe=_I, risk_tier=_S,
)
LOADS = _struct(version=_L, load_id=_S, source=_S, batch_id=_S, whole=T.BooleanType(), last_key=_L)
LOAD_AUDIT = _struct(load_id=_S, batch_id=_S, table_name=_S, measure=_S, row_count=_L)
QUARANTINE = _struct(path=_S, reason=_S, header=_S, batch_id=_L)
MODEL_RUNS = _struct(
    run_name=_S, model_type=_S, n_features=_I, train_size=_L, test_accuracy=_D, test_f1=_D,
    roc_auc=_D, cv_f1_mean=_D, run_id=_S, logged_at=T.TimestampType(),
)
