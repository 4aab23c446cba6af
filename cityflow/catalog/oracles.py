"""SQL for DuckDB that computes each registered query on its own, from the benchmark tables.

The texts share common table expressions for the raw records and features, and three helpers for
rounding. They follow the published definitions: views that fan out are the literal joins here.
"""

from cityflow import fixed_values as V
from cityflow import schemas

# ---------------------------------------------------------------- helpers


def _round_text(x: str, digits: int = 4) -> str:
    """Half-up rounding of the shortest decimal form of a double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def _ratio(num: str, den: str, digits: int, scale: int = 0) -> str:
    """round(num / 10**scale / den, digits), half up, in whole numbers; num and den are integers."""
    top, bottom = f"CAST({num} AS HUGEINT)", f"NULLIF(CAST({den} AS HUGEINT), 0)"
    if digits >= scale:
        top = f"({top} * {10 ** (digits - scale)})"
    else:
        bottom = f"({bottom} * {10 ** (scale - digits)})"
    return f"CAST((2 * {top} + {bottom}) // (2 * {bottom}) AS DOUBLE) / {10 ** digits}.0"


def _units(x: str) -> str:
    return f"CAST(round({x} * 10000) AS BIGINT)"


def _avg(x: str, digits: int) -> str:
    return _ratio(f"sum({x})", f"count({x})", digits)


def _avg4(x: str, digits: int) -> str:
    return _ratio(f"sum({_units(x)})", f"count({x})", digits, 4)


def _sum4(x: str, digits: int) -> str:
    return _ratio(f"sum({_units(x)})", "1", digits, 4)


def _sum(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


def _pct(part: str, whole: str, digits: int = 1) -> str:
    return _ratio(f"100 * ({part})", whole, digits)


def _hits(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


# ---------------------------------------------------------------- shared expressions

_SENSOR_RAW = """
sensor_raw AS (
  SELECT CAST(e.user_id AS VARCHAR) AS Sensor_ID, e.event_id AS traffic_pk, r.r_name AS Location,
    date_trunc('hour', e.ts) AS Date_Time, CAST(floor(e.value) AS INTEGER) AS Vehicle_Count,
    CAST(20 + e.user_id % 60 AS INTEGER) AS Average_Speed,
    CASE e.event_type WHEN 'error' THEN 'High' WHEN 'purchase' THEN 'High' WHEN 'signup' THEN 'Low'
      ELSE 'Moderate' END AS Congestion_Level
  FROM events e JOIN region r ON e.user_id % 5 = r.r_regionkey)"""

_ACCIDENT_RAW = """
accident_raw AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS Accident_ID, o.o_orderkey AS accident_pk, r.r_name AS Location,
    TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * CAST(o.o_orderkey % 5000 AS INTEGER) AS Date_Time,
    CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Truck' WHEN '2-HIGH' THEN 'Bus' WHEN '3-MEDIUM' THEN 'Car'
      WHEN '4-NOT SPECIFIED' THEN 'Motorcycle' ELSE 'Bicycle' END AS Vehicle_Type,
    CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Clear' WHEN 'BUILDING' THEN 'Rain' WHEN 'FURNITURE' THEN 'Fog'
      WHEN 'HOUSEHOLD' THEN 'Snow' ELSE 'Storm' END AS Weather_Condition,
    CASE o.o_orderkey % 4 WHEN 0 THEN 'Dry' WHEN 1 THEN 'Wet' WHEN 2 THEN 'Icy'
      ELSE 'Under Construction' END AS Road_Condition,
    CASE CAST(floor(o.o_totalprice) AS BIGINT) % 4 WHEN 0 THEN 'Minor' WHEN 1 THEN 'Moderate'
      WHEN 2 THEN 'Severe' ELSE 'Fatal' END AS Accident_Severity,
    CAST(1 + CAST(floor(o.o_totalprice / 1000) AS BIGINT) % 4 AS INTEGER) AS Number_of_Vehicles,
    CAST(o.o_custkey % 10 AS INTEGER) AS Casualties,
    CASE o.o_orderstatus WHEN 'P' THEN 'Low' WHEN 'F' THEN 'Moderate' ELSE 'High' END AS Traffic_Density
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def _period(hour: str) -> str:
    return (
        f"CASE WHEN {hour} BETWEEN 7 AND 10 THEN 'Morning Peak' WHEN {hour} BETWEEN 11 AND 13 THEN 'Midday' "
        f"WHEN {hour} BETWEEN 17 AND 20 THEN 'Evening Peak' WHEN {hour} >= 21 OR {hour} <= 5 THEN 'Off-Peak Night' "
        "ELSE 'Off-Peak Day' END"
    )


def _peak(hour: str) -> str:
    return f"CAST(CASE WHEN {hour} BETWEEN 7 AND 10 OR {hour} BETWEEN 17 AND 20 THEN 1 ELSE 0 END AS INTEGER)"


def _int(x: str) -> str:
    return f"CAST({x} AS INTEGER)"


_CONGESTION = _round_text(
    "0.6::DOUBLE * Vehicle_Count / max_volume + 0.4::DOUBLE * (1.0::DOUBLE - Average_Speed::DOUBLE / max_speed)"
)
_SENSOR = f"""
maxima AS (SELECT CAST(max(Vehicle_Count) AS DOUBLE) AS max_volume, CAST(max(Average_Speed) AS DOUBLE) AS max_speed FROM sensor_raw),
sensor AS (
  SELECT s.*, {_int("hour(Date_Time)")} AS hour, {_peak("hour(Date_Time)")} AS is_peak_hour,
    {_period("hour(Date_Time)")} AS time_of_day, {_CONGESTION} AS congestion_index,
    CASE WHEN Average_Speed < 20 THEN 'Very Slow' WHEN Average_Speed < 40 THEN 'Slow'
      WHEN Average_Speed < 60 THEN 'Moderate' WHEN Average_Speed < 80 THEN 'Fast' ELSE 'Very Fast' END AS speed_category,
    CASE WHEN Vehicle_Count <= 100 THEN 'Very Low' WHEN Vehicle_Count <= 200 THEN 'Low'
      WHEN Vehicle_Count <= 300 THEN 'Medium' WHEN Vehicle_Count <= 400 THEN 'High' ELSE 'Very High' END AS volume_band,
    'Active' AS sensor_status
  FROM sensor_raw s CROSS JOIN maxima)"""

_ACCIDENT = f"""
accident_scored AS (
  SELECT a.*, CASE Accident_Severity WHEN 'Minor' THEN 1 WHEN 'Moderate' THEN 2 WHEN 'Severe' THEN 3 ELSE 4 END AS severity_score
  FROM accident_raw a),
accident_risk AS (
  SELECT *, {_round_text("severity_score * ln(coalesce(Casualties, 0) + 2.0::DOUBLE) * Number_of_Vehicles")} AS risk_score
  FROM accident_scored),
accident AS (
  SELECT *, {_int("hour(Date_Time)")} AS hour, {_peak("hour(Date_Time)")} AS is_peak_hour,
    CASE WHEN risk_score <= 5 THEN 'Low Hazard' WHEN risk_score <= 15 THEN 'Moderate Hazard'
      WHEN risk_score <= 30 THEN 'High Hazard' ELSE 'Critical Hazard' END AS hazard_level,
    CASE WHEN Weather_Condition IN ('Fog', 'Snow', 'Storm') THEN 1 ELSE 0 END AS adverse_weather,
    CASE WHEN Road_Condition IN ('Icy', 'Under Construction') THEN 1 ELSE 0 END AS hazardous_road,
    CASE WHEN Accident_Severity IN ('Fatal', 'Severe') THEN 1 ELSE 0 END AS is_fatal_or_severe,
    CASE Traffic_Density WHEN 'Low' THEN 1 WHEN 'Moderate' THEN 2 ELSE 3 END AS traffic_density_num,
    CASE Vehicle_Type WHEN 'Bicycle' THEN 'Non-Motorised' WHEN 'Motorcycle' THEN 'Two-Wheeler'
      WHEN 'Car' THEN 'Light Motor' WHEN 'Bus' THEN 'Heavy Motor' WHEN 'Truck' THEN 'Heavy Motor'
      ELSE 'Other' END AS vehicle_class
  FROM accident_risk)"""

_DIMS = f"""
dim_location AS (SELECT CAST(i AS BIGINT) AS location_id, location_name, zone_type FROM (VALUES
  (1, 'AFRICA', 'Urban Core'), (2, 'AMERICA', 'Highway'), (3, 'ASIA', 'Residential'),
  (4, 'EUROPE', 'Industrial'), (5, 'MIDDLE EAST', 'Suburban')) AS v(i, location_name, zone_type)),
dim_vehicle AS (SELECT CAST(i AS BIGINT) AS vehicle_id, vehicle_type, vehicle_class FROM (VALUES
  (1, 'Bicycle', 'Non-Motorised'), (2, 'Motorcycle', 'Two-Wheeler'), (3, 'Car', 'Light Motor'),
  (4, 'Bus', 'Heavy Motor'), (5, 'Truck', 'Heavy Motor')) AS v(i, vehicle_type, vehicle_class)),
dim_weather AS (SELECT row_number() OVER (ORDER BY weather_condition) AS weather_id, weather_condition, is_adverse
  FROM (SELECT DISTINCT Weather_Condition AS weather_condition, adverse_weather AS is_adverse FROM accident)),
times AS (SELECT Date_Time AS t FROM sensor_raw UNION SELECT Date_Time FROM accident_raw),
dim_date AS (
  SELECT CAST(epoch(t) AS BIGINT) AS date_id, t AS full_datetime, CAST(t AS DATE) AS date_only,
    {_int("year(t)")} AS year, {_int("quarter(t)")} AS quarter, {_int("month(t)")} AS month, monthname(t) AS month_name,
    {_int("month(t)")} AS month_sort, {_int("weekofyear(t)")} AS week, dayname(t) AS day_name,
    {_int("isodow(t)")} AS day_of_week_num, {_int("hour(t)")} AS hour, {_period("hour(t)")} AS time_of_day,
    {_peak("hour(t)")} AS is_peak_hour, CAST(CASE WHEN isodow(t) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend
  FROM times)"""

_FACTS = """
fact_traffic AS (
  SELECT s.traffic_pk, s.Sensor_ID AS sensor_id, l.location_id, d.date_id, s.Vehicle_Count AS vehicle_count,
    s.Average_Speed AS average_speed, s.Congestion_Level AS congestion_level, s.congestion_index,
    s.speed_category, s.volume_band, s.sensor_status
  FROM sensor s JOIN dim_location l ON s.Location = l.location_name JOIN dim_date d ON s.Date_Time = d.full_datetime),
fact_accident AS (
  SELECT a.accident_pk, a.Accident_ID AS accident_id, l.location_id, d.date_id, v.vehicle_id, w.weather_id,
    a.Vehicle_Type AS vehicle_type, a.Weather_Condition AS weather_condition, a.Road_Condition AS road_condition,
    a.Accident_Severity AS accident_severity, a.Number_of_Vehicles AS number_of_vehicles, a.Casualties AS casualties,
    a.Traffic_Density AS traffic_density, a.severity_score, a.risk_score, a.hazard_level, a.adverse_weather,
    a.hazardous_road, a.is_peak_hour, a.is_fatal_or_severe, a.traffic_density_num
  FROM accident a JOIN dim_location l ON a.Location = l.location_name JOIN dim_vehicle v ON a.Vehicle_Type = v.vehicle_type
  JOIN dim_weather w ON a.Weather_Condition = w.weather_condition JOIN dim_date d ON a.Date_Time = d.full_datetime)"""

_RISK = f"""
risk AS (
  SELECT accident_id, location_name, predicted_risk_prob, CASE WHEN predicted_risk_prob >= 0.5 THEN 1 ELSE 0 END AS predicted_class,
    actual_fatal_severe, CASE WHEN predicted_risk_prob < 0.35 THEN 'Low Risk' WHEN predicted_risk_prob < 0.5 THEN 'Moderate Risk'
      WHEN predicted_risk_prob < 0.7 THEN 'High Risk' ELSE 'Critical Risk' END AS risk_tier
  FROM (SELECT Accident_ID AS accident_id, Location AS location_name,
    CAST(accident_pk * 37 % 1000 AS DOUBLE) / 1000.0::DOUBLE AS predicted_risk_prob, is_fatal_or_severe AS actual_fatal_severe FROM accident))"""

_TIMED = """
timed AS (SELECT o_orderkey AS id, o_orderdate AS ts FROM orders UNION ALL SELECT event_id, ts FROM events)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_S = _with(_SENSOR_RAW, _SENSOR)
_A = _with(_ACCIDENT_RAW, _ACCIDENT)
_AR = _with(_ACCIDENT_RAW, _ACCIDENT, _RISK)
_STAR = _with(_SENSOR_RAW, _SENSOR, _ACCIDENT_RAW, _ACCIDENT, _DIMS, _FACTS)
_STAR_RISK = _with(_SENSOR_RAW, _SENSOR, _ACCIDENT_RAW, _ACCIDENT, _DIMS, _FACTS, _RISK)

_HASH = "('0x' || substr(md5({key} || '{salt}'), 1, 8))::BIGINT"


def _hash(key: str, salt: str) -> str:
    return _HASH.format(key=key, salt=salt)


# ---------------------------------------------------------------- views

_VIEW_1 = f"""
zone_accidents AS (
  SELECT location_id, count(DISTINCT accident_pk) AS total_accidents, {_sum("casualties")} AS total_casualties,
    {_avg4("risk_score", 3)} AS avg_risk_score, {_sum4("risk_score", 2)} AS total_risk_score, max(risk_score) AS max_risk_score,
    {_avg("severity_score", 3)} AS avg_severity_score,
    {_hits("accident_severity = 'Fatal'")} AS fatal_count, {_hits("accident_severity = 'Severe'")} AS severe_count,
    {_hits("accident_severity = 'Moderate'")} AS moderate_count, {_hits("accident_severity = 'Minor'")} AS minor_count,
    {_sum("is_fatal_or_severe")} AS fatal_severe_count,
    {_pct("sum(is_fatal_or_severe)", "count(*)")} AS fatal_severe_pct,
    {_pct("sum(adverse_weather)", "count(*)")} AS adverse_weather_pct,
    {_pct("sum(hazardous_road)", "count(*)")} AS hazardous_road_pct
  FROM fact_accident GROUP BY location_id),
zone_traffic AS (
  SELECT location_id, {_sum("vehicle_count")} AS vehicles, {_avg("vehicle_count", 1)} AS avg_vehicles_per_reading,
    {_avg4("congestion_index", 4)} AS avg_congestion_index
  FROM fact_traffic GROUP BY location_id),
vw_location_summary AS (
  SELECT l.location_name, l.zone_type, a.* EXCLUDE (location_id), coalesce(t.vehicles, 0) AS total_vehicles,
    t.avg_vehicles_per_reading, t.avg_congestion_index,
    {_ratio("1000 * a.total_accidents", "coalesce(t.vehicles, 0)", 4)} AS accident_rate_per_1000_vehicles
  FROM zone_accidents a JOIN dim_location l USING (location_id) LEFT JOIN zone_traffic t USING (location_id))"""

_VIEW_2 = f"""
hour_traffic AS (
  SELECT d.hour, count(*) AS sensor_reading_count, {_avg("vehicle_count", 1)} AS avg_vehicles, max(vehicle_count) AS peak_vehicles,
    {_avg("average_speed", 1)} AS avg_speed_kmh, min(average_speed) AS min_speed_kmh,
    {_avg4("congestion_index", 4)} AS avg_congestion_index, max(congestion_index) AS max_congestion_index,
    {_pct("sum(CASE WHEN congestion_level = 'High' THEN 1 ELSE 0 END)", "count(*)")} AS high_congestion_pct
  FROM fact_traffic t JOIN dim_date d USING (date_id) GROUP BY d.hour),
hour_accidents AS (
  SELECT d.hour, count(*) AS accident_count, {_sum("casualties")} AS total_casualties, {_avg4("risk_score", 3)} AS avg_risk_score,
    max(risk_score) AS max_risk_score, {_sum("is_fatal_or_severe")} AS fatal_severe_count,
    {_pct("sum(is_fatal_or_severe)", "count(*)")} AS fatal_severe_pct
  FROM fact_accident a JOIN dim_date d USING (date_id) GROUP BY d.hour),
vw_hourly_profile AS (
  SELECT h.hour, h.time_of_day, h.is_peak_hour, coalesce(t.sensor_reading_count, 0) AS sensor_reading_count,
    t.* EXCLUDE (hour, sensor_reading_count), coalesce(a.accident_count, 0) AS accident_count, a.* EXCLUDE (hour, accident_count)
  FROM (SELECT DISTINCT hour, time_of_day, is_peak_hour FROM dim_date) h
  LEFT JOIN hour_traffic t ON h.hour = t.hour LEFT JOIN hour_accidents a ON h.hour = a.hour)"""

_VIEW_3 = f"""
vw_monthly_trend AS (
  SELECT d.year, d.quarter, d.month, d.month_name, d.month_sort, count(DISTINCT accident_pk) AS total_accidents,
    {_sum("casualties")} AS total_casualties, {_avg("casualties", 2)} AS avg_casualties_per_accident,
    {_hits("accident_severity = 'Fatal'")} AS fatal_accidents, {_hits("accident_severity = 'Severe'")} AS severe_accidents,
    {_hits("accident_severity = 'Moderate'")} AS moderate_accidents, {_hits("accident_severity = 'Minor'")} AS minor_accidents,
    {_sum("is_fatal_or_severe")} AS fatal_severe_count, {_pct("sum(is_fatal_or_severe)", "count(*)")} AS fatal_severe_pct,
    {_avg4("risk_score", 3)} AS avg_risk_score, {_sum4("risk_score", 2)} AS total_risk_score,
    {_pct("sum(adverse_weather)", "count(*)")} AS adverse_weather_pct, {_pct("sum(hazardous_road)", "count(*)")} AS hazardous_road_pct,
    {_pct("sum(a.is_peak_hour)", "count(*)")} AS peak_hour_pct
  FROM fact_accident a JOIN dim_date d USING (date_id) GROUP BY ALL)"""

_VIEW_4 = f"""
vw_congestion_hotspots AS (
  SELECT l.location_name, l.zone_type, d.time_of_day, d.is_peak_hour, count(DISTINCT traffic_pk) AS sensor_readings,
    {_avg("vehicle_count", 1)} AS avg_vehicles, max(vehicle_count) AS peak_vehicles, {_avg("average_speed", 1)} AS avg_speed_kmh,
    min(average_speed) AS min_speed_kmh, {_avg4("congestion_index", 4)} AS avg_congestion_index,
    max(congestion_index) AS max_congestion_index,
    {_pct("sum(CASE WHEN congestion_level = 'High' THEN 1 ELSE 0 END)", "count(*)")} AS high_congestion_pct,
    {_pct("sum(CASE WHEN congestion_level = 'Moderate' THEN 1 ELSE 0 END)", "count(*)")} AS moderate_congestion_pct,
    {_pct("sum(CASE WHEN congestion_level = 'Low' THEN 1 ELSE 0 END)", "count(*)")} AS low_congestion_pct
  FROM fact_traffic t JOIN dim_location l USING (location_id) JOIN dim_date d USING (date_id) GROUP BY ALL)"""

_VIEW_5 = f"""
vw_weather_risk AS (
  SELECT w.weather_condition, w.is_adverse AS is_adverse_weather, a.road_condition, a.hazardous_road AS is_hazardous_road,
    count(*) AS accidents, {_sum("casualties")} AS total_casualties, {_avg("casualties", 2)} AS avg_casualties,
    {_avg("severity_score", 3)} AS avg_severity_score, {_avg4("risk_score", 3)} AS avg_risk_score, max(risk_score) AS max_risk_score,
    {_hits("accident_severity = 'Fatal'")} AS fatal_count, {_hits("accident_severity = 'Severe'")} AS severe_count,
    {_sum("is_fatal_or_severe")} AS fatal_severe_count, {_pct("sum(is_fatal_or_severe)", "count(*)")} AS fatal_severe_pct
  FROM fact_accident a JOIN dim_weather w USING (weather_id) GROUP BY ALL)"""

_VIEW_6 = f"""
vw_severity_by_location AS (
  SELECT *, {_pct("accident_count", "sum(accident_count) OVER (PARTITION BY location_name)")} AS pct_of_location_total
  FROM (SELECT l.location_name, l.zone_type, a.accident_severity, count(*) AS accident_count, {_sum("casualties")} AS total_casualties,
      {_avg("casualties", 2)} AS avg_casualties, {_avg4("risk_score", 3)} AS avg_risk_score, {_sum4("risk_score", 2)} AS total_risk_score,
      {_pct("sum(adverse_weather)", "count(*)")} AS adverse_weather_pct, {_pct("sum(hazardous_road)", "count(*)")} AS hazardous_road_pct
    FROM fact_accident a JOIN dim_location l USING (location_id) GROUP BY ALL))"""

_VIEW_7 = f"""
vw_road_condition_risk AS (
  SELECT road_condition, max(hazardous_road) AS is_hazardous, count(*) AS total_accidents, {_sum("casualties")} AS total_casualties,
    {_avg("casualties", 2)} AS avg_casualties, {_avg4("risk_score", 3)} AS avg_risk_score, max(risk_score) AS max_risk_score,
    {_avg("severity_score", 3)} AS avg_severity_score, {_hits("accident_severity = 'Fatal'")} AS fatal_count,
    {_hits("accident_severity = 'Severe'")} AS severe_count, {_sum("is_fatal_or_severe")} AS fatal_severe_count,
    {_pct("sum(is_fatal_or_severe)", "count(*)")} AS fatal_severe_pct, {_avg("traffic_density_num", 3)} AS avg_traffic_density_num,
    {_pct("sum(is_peak_hour)", "count(*)")} AS peak_hour_pct
  FROM fact_accident GROUP BY ALL)"""

_VIEW_8 = f"""
vw_ml_location_risk AS (
  SELECT location_name, {_avg4("predicted_risk_prob", 4)} AS avg_predicted_risk, min(predicted_risk_prob) AS min_predicted_risk,
    max(predicted_risk_prob) AS max_predicted_risk, {_hits("risk_tier = 'Critical Risk'")} AS critical_risk_count,
    {_hits("risk_tier = 'High Risk'")} AS high_risk_count, {_hits("risk_tier = 'Moderate Risk'")} AS moderate_risk_count,
    {_hits("risk_tier = 'Low Risk'")} AS low_risk_count, {_sum("predicted_class")} AS predicted_fatal_severe,
    {_sum("r.actual_fatal_severe")} AS actual_fatal_severe, {_pct("sum(r.actual_fatal_severe)", "count(*)", 2)} AS actual_fatal_severe_pct,
    count(*) AS total_accidents,
    CASE WHEN sum({_units("predicted_risk_prob")}) >= 5050 * count(*) THEN 'Dangerous' ELSE 'Caution' END AS safety_rating
  FROM risk r GROUP BY location_name)"""

_VIEW_1F = f"""
SELECT l.location_name, l.zone_type, count(DISTINCT a.accident_pk) AS total_accidents,
  CAST(sum(a.casualties) AS DOUBLE) AS total_casualties, {_avg4("a.risk_score", 3)} AS avg_risk_score,
  {_sum4("a.risk_score", 2)} AS total_risk_score, max(a.risk_score) AS max_risk_score, {_avg("a.severity_score", 3)} AS avg_severity_score,
  CAST({_hits("a.accident_severity = 'Fatal'")} AS DOUBLE) AS fatal_count, CAST({_hits("a.accident_severity = 'Severe'")} AS DOUBLE) AS severe_count,
  CAST({_hits("a.accident_severity = 'Moderate'")} AS DOUBLE) AS moderate_count, CAST({_hits("a.accident_severity = 'Minor'")} AS DOUBLE) AS minor_count,
  CAST(sum(a.is_fatal_or_severe) AS DOUBLE) AS fatal_severe_count,
  {_pct("sum(a.is_fatal_or_severe)", "count(DISTINCT a.accident_pk)")} AS fatal_severe_pct,
  {_pct("sum(a.adverse_weather)", "count(*)")} AS adverse_weather_pct, {_pct("sum(a.hazardous_road)", "count(*)")} AS hazardous_road_pct,
  CAST(coalesce(sum(t.vehicle_count), 0) AS DOUBLE) AS total_vehicles, {_avg("t.vehicle_count", 1)} AS avg_vehicles_per_reading,
  {_avg4("t.congestion_index", 4)} AS avg_congestion_index,
  {_ratio("1000 * count(DISTINCT a.accident_pk)", "coalesce(sum(t.vehicle_count), 0)", 4)} AS accident_rate_per_1000_vehicles
FROM fact_accident a JOIN dim_location l ON a.location_id = l.location_id
LEFT JOIN fact_traffic t ON a.location_id = t.location_id
GROUP BY l.location_name, l.zone_type"""

_VIEW_2F = f"""
SELECT d.hour, d.time_of_day, d.is_peak_hour, count(DISTINCT t.traffic_pk) AS sensor_reading_count,
  {_avg("t.vehicle_count", 1)} AS avg_vehicles, max(t.vehicle_count) AS peak_vehicles, {_avg("t.average_speed", 1)} AS avg_speed_kmh,
  min(t.average_speed) AS min_speed_kmh, {_avg4("t.congestion_index", 4)} AS avg_congestion_index,
  max(t.congestion_index) AS max_congestion_index,
  {_pct("sum(CASE WHEN t.congestion_level = 'High' THEN 1 ELSE 0 END)", "count(DISTINCT t.traffic_pk)")} AS high_congestion_pct,
  count(DISTINCT a.accident_pk) AS accident_count, CAST(sum(a.casualties) AS DOUBLE) AS total_casualties,
  {_avg4("a.risk_score", 3)} AS avg_risk_score, max(a.risk_score) AS max_risk_score,
  CAST(sum(a.is_fatal_or_severe) AS DOUBLE) AS fatal_severe_count,
  {_pct("sum(a.is_fatal_or_severe)", "count(DISTINCT a.accident_pk)")} AS fatal_severe_pct
FROM dim_date d LEFT JOIN fact_traffic t ON d.date_id = t.date_id LEFT JOIN fact_accident a ON d.date_id = a.date_id
GROUP BY d.hour, d.time_of_day, d.is_peak_hour"""

_ALL_VIEWS = ",".join([_VIEW_1, _VIEW_2, _VIEW_3, _VIEW_4, _VIEW_5, _VIEW_6, _VIEW_7, _VIEW_8])
_VIEW_NAMES = (
    "vw_location_summary", "vw_hourly_profile", "vw_monthly_trend", "vw_congestion_hotspots", "vw_weather_risk",
    "vw_severity_by_location", "vw_road_condition_risk", "vw_ml_location_risk",
)

# ---------------------------------------------------------------- model and alarms

_FEATURES = """
features AS (
  SELECT a.accident_id, l.location_name, w.weather_condition, a.road_condition, v.vehicle_type, d.hour, d.is_peak_hour,
    d.is_weekend, d.month, d.quarter, a.number_of_vehicles, a.traffic_density_num, a.adverse_weather, a.hazardous_road,
    a.is_fatal_or_severe
  FROM fact_accident a JOIN dim_location l ON a.location_id = l.location_id JOIN dim_weather w ON a.weather_id = w.weather_id
  JOIN dim_vehicle v ON a.vehicle_id = v.vehicle_id JOIN dim_date d ON a.date_id = d.date_id)"""


def _scores(multiplier: int) -> str:
    return f"""(SELECT Accident_ID, is_fatal_or_severe AS y, CAST(accident_pk * {multiplier} % 1000 AS DOUBLE) / 1000.0::DOUBLE AS p,
      CASE WHEN accident_pk * {multiplier} % 1000 >= 500 THEN 1 ELSE 0 END AS c FROM accident)"""


def _f1(y: str = "y", c: str = "c") -> str:
    return (
        f"2.0::DOUBLE * sum(CASE WHEN {y} = 1 AND {c} = 1 THEN 1 ELSE 0 END) "
        f"/ (sum({y}) + sum({c}))"
    )


def _metrics(scores: str) -> str:
    return f"""SELECT CAST(sum(CASE WHEN y = c THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS accuracy, {_f1()} AS f1_score,
      CAST(sum(CASE WHEN y = 1 THEN 2 * low + same ELSE 0 END) AS DOUBLE) / (2.0::DOUBLE * sum(y) * (count(*) - sum(y))) AS roc_auc
    FROM (SELECT y, c, sum(1 - y) OVER (ORDER BY p RANGE UNBOUNDED PRECEDING) - sum(1 - y) OVER (PARTITION BY p) AS low,
      sum(1 - y) OVER (PARTITION BY p) AS same FROM {scores})"""


def _fold(target: str) -> str:
    return f"""row_number() OVER (ORDER BY {target}, {_hash("Accident_ID", "fold42")}, Accident_ID) % 5"""


_IS_TEST = f"""row_number() OVER (PARTITION BY is_fatal_or_severe ORDER BY {_hash("Accident_ID", "42")}, Accident_ID)
      <= floor(count(*) OVER (PARTITION BY is_fatal_or_severe) * 0.2::DOUBLE + 0.5)"""
_PARTS = f""", parts AS (SELECT *, CASE WHEN {_IS_TEST} THEN 'test' ELSE 'train' END AS part FROM accident),
    models AS (SELECT unnest(['Random Forest', 'Gradient Boosting', 'Logistic Regression']) AS model) """


def _model_row(name: str, multiplier: int) -> str:
    return f"""SELECT '{name}' AS model, m.*, f.* FROM ({_metrics(_scores(multiplier))}) m,
    (SELECT avg(f1) AS cv_f1_mean, stddev_pop(f1) AS cv_f1_std FROM (
      SELECT {_f1()} AS f1 FROM (SELECT *, {_fold("y")} AS fold FROM {_scores(multiplier)}) GROUP BY fold)) f"""


_ALARMS = """
failures AS (
  SELECT ts, event_type AS alarm_name, CASE WHEN user_id % 4 = 0 THEN 1 ELSE 0 END AS failed FROM events),
states AS (
  SELECT alarm_name, time_bucket(INTERVAL '5 minutes', ts) AS period_start,
    time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS period_end, CAST(sum(failed) AS BIGINT) AS total,
    CASE WHEN sum(failed) >= 1 THEN 'ALARM' ELSE 'OK' END AS state
  FROM failures GROUP BY ALL)"""


def _filled(periods: int) -> str:
    return f"""{_with(_ALARMS)}
SELECT alarm_name, period_start, coalesce(total, 0) AS total,
  CASE WHEN sum(CASE WHEN state = 'ALARM' THEN 1 ELSE 0 END) OVER (PARTITION BY alarm_name ORDER BY period_start
    ROWS BETWEEN {periods - 1} PRECEDING AND CURRENT ROW) = {periods} THEN 'ALARM' ELSE 'OK' END AS state
FROM (SELECT alarm_name, unnest(generate_series(min(period_start), (SELECT max(period_start) FROM states), INTERVAL '5 minutes')) AS period_start
  FROM states GROUP BY alarm_name) spine LEFT JOIN states USING (alarm_name, period_start)"""


def _z(column: str) -> str:
    return f"round((t.{column} - s.{column}_m) / s.{column}_d, 6) AS {column}"


_SCALED = ("hour", "Number_of_Vehicles", "traffic_density_num", "adverse_weather")

_SPOILT = """,
s_location AS (SELECT * FROM dim_location WHERE location_name <> 'ASIA'),
d_location AS (SELECT CAST(row_number() OVER (ORDER BY location_id) AS BIGINT) AS location_id, location_name, zone_type FROM s_location),
d_vehicle AS (SELECT * REPLACE (CASE WHEN vehicle_id = 2 THEN NULL ELSE vehicle_class END AS vehicle_class) FROM dim_vehicle),
d_weather AS (SELECT * REPLACE (CASE WHEN weather_id <= 2 THEN 'Clear' ELSE weather_condition END AS weather_condition) FROM dim_weather),
d_date AS (SELECT * REPLACE (CASE WHEN hour = 8 THEN NULL ELSE week END AS week) FROM dim_date WHERE hour <> 7),
f_traffic AS (SELECT * REPLACE (CASE WHEN traffic_pk % 7 = 0 THEN NULL ELSE vehicle_count END AS vehicle_count) FROM fact_traffic),
f_accident AS (SELECT * REPLACE (
  CASE WHEN accident_pk % 11 = 0 THEN 'again' WHEN accident_pk % 13 = 0 THEN NULL ELSE accident_id END AS accident_id,
  CASE WHEN accident_pk % 5 = 0 THEN NULL ELSE road_condition END AS road_condition) FROM fact_accident)
"""


def _constraints() -> str:
    """A row per constraint over the spoilt tables."""
    tables = {
        "dim_location": schemas.DIM_LOCATION, "dim_vehicle": schemas.DIM_VEHICLE, "dim_weather": schemas.DIM_WEATHER,
        "dim_date": schemas.DIM_DATE, "fact_traffic": schemas.FACT_TRAFFIC, "fact_accident": schemas.FACT_ACCIDENT,
    }

    def row(table: str, constraint: str, column: str, count: str) -> str:
        return f"SELECT '{table}' AS table_name, '{constraint}' AS constraint_name, '{column}' AS column_name, CAST({count} AS BIGINT) AS broken"

    def own(table: str) -> str:
        return table.replace("dim_", "d_").replace("fact_", "f_")

    rows = [
        row(t, "not null", c, f"(SELECT count(*) - count({c}) FROM {own(t)})")
        for t, schema in tables.items() for c in schema.fieldNames()
    ]
    unique = [
        ("dim_location", "location_id"), ("dim_location", "location_name"), ("dim_vehicle", "vehicle_id"), ("dim_vehicle", "vehicle_type"),
        ("dim_weather", "weather_id"), ("dim_weather", "weather_condition"), ("dim_date", "date_id"), ("dim_date", "full_datetime"),
        ("fact_traffic", "traffic_pk"), ("fact_accident", "accident_pk"), ("fact_accident", "accident_id"),
    ]
    rows += [
        row(t, "unique", c, f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {own(t)} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))")
        for t, c in unique
    ]
    for fact, parents in (("fact_traffic", ("location", "date")), ("fact_accident", ("location", "date", "vehicle", "weather"))):
        rows += [
            row(fact, "reference", f"{p}_id", f"(SELECT count(*) FROM {own(fact)} WHERE {p}_id NOT IN (SELECT {p}_id FROM d_{p}))")
            for p in parents
        ]
    return " UNION ALL ".join(rows)


# The facts after the batches of the load queries: readings of a level twice, accidents of ambiguous ids not at all.
_LOADED = """, loaded_traffic AS (SELECT * FROM fact_traffic UNION ALL SELECT * FROM fact_traffic WHERE congestion_level = 'Low'),
loaded_accident AS (SELECT * FROM fact_accident WHERE accident_pk % 14 <> 7),"""


def _loaded(view: str) -> str:
    return view.replace("fact_traffic", "loaded_traffic").replace("fact_accident", "loaded_accident")


ORACLES: dict[str, str] = {
    "dq5_quality_report": _STAR + _SPOILT + _constraints(),
    "src1_csv_sensor": _with(_SENSOR_RAW)
    + "SELECT Sensor_ID, Location, Vehicle_Count, Average_Speed, Congestion_Level, Date_Time AS DateTime FROM sensor_raw",
    "src2_csv_accident": _with(_ACCIDENT_RAW)
    + """SELECT Accident_ID, Location, Vehicle_Type, Weather_Condition, Road_Condition, Accident_Severity,
    Number_of_Vehicles, Casualties, Traffic_Density, Date_Time AS DateTime FROM accident_raw""",
    "src3_parquet_prefix": _S + "SELECT traffic_pk, Location, congestion_index FROM sensor",
    "src4_table_read": _A
    + """SELECT Accident_ID AS accident_id, Location AS location_name, Weather_Condition AS weather_condition,
    Vehicle_Type AS vehicle_type, risk_score FROM accident""",
    "snk1_parquet_overwrite": _A
    + f"""SELECT accident_pk, {_int("year(Date_Time)")} AS year, {_int("month(Date_Time)")} AS month, risk_score, hazard_level
    FROM accident""",
    "snk2_idempotent_append": _with(_SENSOR_RAW)
    + "SELECT traffic_pk, Sensor_ID, Location, Congestion_Level FROM sensor_raw",
    "snk2_rerun_safe_load": _STAR
    + """, twice AS (SELECT accident_pk FROM fact_accident WHERE accident_pk % 14 = 7),
    known AS (SELECT accident_pk FROM fact_accident WHERE accident_pk % 10 = 0)
    SELECT 'fact_traffic' AS table_name, count(*) + count(*) FILTER (congestion_level = 'Low') AS row_count,
      count(*) + count(*) FILTER (congestion_level = 'Low') AS keys FROM fact_traffic
    UNION ALL SELECT 'fact_accident', count(*) - (SELECT count(*) FROM twice), count(*) - (SELECT count(*) FROM twice) FROM fact_accident
    UNION ALL SELECT 'reject_traffic', 0, 0
    UNION ALL SELECT 'reject_accident', n, n FROM (SELECT (SELECT count(*) FROM known) + 2 * (SELECT count(*) FROM twice) AS n)
    UNION ALL SELECT 'dim_date', count(*), count(*) FROM dim_date
    UNION ALL SELECT 'dim_weather', count(*), count(*) FROM dim_weather""",
    "snk4_load_audit": _STAR
    + """, n AS (
      SELECT (SELECT count(*) + count(*) FILTER (congestion_level = 'Low') FROM fact_traffic) AS readings,
        (SELECT count(*) FROM fact_accident) AS accidents, (SELECT count(*) FROM fact_accident WHERE accident_pk % 14 = 7) AS twice,
        (SELECT count(*) FROM fact_accident WHERE accident_pk % 10 = 0) AS known)
    SELECT table_name, measure, CAST(batches AS BIGINT) AS batches, row_count FROM (
      SELECT 'fact_traffic' AS table_name, 'rows read' AS measure, 2 AS batches, readings AS row_count FROM n
      UNION ALL SELECT 'fact_traffic', 'rows stored', 2, readings FROM n
      UNION ALL SELECT 'fact_accident', 'rows read', 2, accidents + known + twice FROM n
      UNION ALL SELECT 'fact_accident', 'rows stored', 2, accidents - twice FROM n
      UNION ALL SELECT 'fact_accident', 'rows rejected', 1, known + 2 * twice FROM n
      UNION ALL SELECT 'fact_accident', 'stored accident_id', 1, known FROM n
      UNION ALL SELECT 'fact_accident', 'repeated accident_id', 1, 2 * twice FROM n) WHERE row_count > 0""",
    "adh7_month_of_trend": _STAR
    + """ SELECT d.year, d.month, count(*) AS total_accidents, CAST(sum(casualties) AS BIGINT) AS total_casualties
    FROM fact_accident a JOIN dim_date d USING (date_id)
    WHERE a.accident_pk % 14 <> 7 AND d.year = 2024 AND d.month <= 3 GROUP BY ALL""",
    "snk3_replace_table": _AR + "SELECT * FROM risk",
    "snk4_row_audit": _with(_SENSOR_RAW, _ACCIDENT_RAW)
    + """SELECT 'sensor' AS table_name, count(*) AS row_count FROM sensor_raw
    UNION ALL SELECT 'accident', count(*) FROM accident_raw""",
    "tmp1_parse_timestamp": _with(_SENSOR_RAW)
    + "SELECT traffic_pk, CASE WHEN Congestion_Level <> 'Low' THEN Date_Time END AS DateTime FROM sensor_raw",
    "tmp2_temporal_parts": _with(_TIMED)
    + f"""SELECT id, {_int("year(ts)")} AS year, {_int("month(ts)")} AS month, {_int("day(ts)")} AS day,
    {_int("hour(ts)")} AS hour, {_int("quarter(ts)")} AS quarter, {_int("dayofweek(ts) + 1")} AS day_of_week FROM timed""",
    "tmp3_is_weekend": _with(_TIMED)
    + """SELECT id, CAST(CAST(ts AS DATE) AS VARCHAR) AS d,
    CAST(CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend FROM timed""",
    "tmp4_is_peak_hour": _S + "SELECT traffic_pk, hour, is_peak_hour FROM sensor",
    "tmp5_time_of_day": _S + "SELECT traffic_pk, hour, time_of_day FROM sensor",
    "tmp6_calendar": _with(_TIMED)
    + f"""SELECT id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date_only, monthname(ts) AS month_name, {_int("month(ts)")} AS month_sort,
    {_int("weekofyear(ts)")} AS week, dayname(ts) AS day_name, {_int("isodow(ts)")} AS day_of_week_num FROM timed""",
    "kpi1_congestion_index": _S + "SELECT traffic_pk, congestion_index FROM sensor",
    "kpi2_speed_band": _S + "SELECT traffic_pk, Average_Speed, speed_category FROM sensor",
    "kpi3_volume_band": _S + "SELECT traffic_pk, Vehicle_Count, volume_band FROM sensor",
    "kpi4_risk_score": _A + "SELECT accident_pk, severity_score, risk_score FROM accident",
    "kpi5_hazard_level": _A + "SELECT accident_pk, hazard_level FROM accident",
    "kpi6_adverse_weather": _A + "SELECT accident_pk, Weather_Condition, adverse_weather FROM accident",
    "kpi7_hazardous_road": _A + "SELECT accident_pk, Road_Condition, hazardous_road FROM accident",
    "kpi8_fatal_or_severe": _A + "SELECT accident_pk, Accident_Severity, is_fatal_or_severe FROM accident",
    "kpi9_traffic_density": _A + "SELECT accident_pk, Traffic_Density, traffic_density_num FROM accident",
    "kpi10_vehicle_class": _A + "SELECT accident_pk, Vehicle_Type, vehicle_class FROM accident",
    "kpi11_status": _S + "SELECT sensor_status, count(*) AS readings FROM sensor GROUP BY sensor_status",
    "prj1_conform": _S
    + """SELECT traffic_pk, Sensor_ID AS sensor_id, Vehicle_Count AS vehicle_count, Average_Speed AS average_speed,
    Congestion_Level AS congestion_level, congestion_index, speed_category FROM sensor""",
    "fun1_field_position": _with(_ACCIDENT_RAW)
    + """SELECT accident_pk, CASE Accident_Severity WHEN 'Fatal' THEN 1 WHEN 'Severe' THEN 2 WHEN 'Moderate' THEN 3
    ELSE 0 END AS place FROM accident_raw""",
    "dim1_location": _STAR
    + """SELECT l.*, coalesce(n, 0) AS accidents FROM dim_location l
    LEFT JOIN (SELECT Location, count(*) AS n FROM accident_raw GROUP BY Location) ON Location = location_name""",
    "dim2_vehicle": _STAR
    + """SELECT v.*, coalesce(n, 0) AS accidents FROM dim_vehicle v
    LEFT JOIN (SELECT Vehicle_Type AS t, count(*) AS n FROM accident_raw GROUP BY t) ON t = vehicle_type""",
    "dim3_weather": _STAR + "SELECT weather_condition, is_adverse FROM dim_weather",
    "dim4_date": _STAR + "SELECT * REPLACE (CAST(date_only AS VARCHAR) AS date_only) FROM dim_date",
    "dim5_weather_keys": _STAR + "SELECT weather_id, weather_condition FROM dim_weather",
    "dim5_date_keys": _STAR + "SELECT row_number() OVER (ORDER BY full_datetime) AS date_id, full_datetime FROM dim_date",
    "dim5_fact_keys": _with(_ACCIDENT_RAW)
    + """SELECT count(*) AS n, CAST(1 AS BIGINT) AS first, count(*) AS last, count(DISTINCT Accident_ID) AS different
    FROM accident_raw""",
    "dim6_resolve": _with(_ACCIDENT_RAW)
    + """SELECT accident_pk, CAST(CASE Location WHEN 'AFRICA' THEN 1 WHEN 'AMERICA' THEN 2 WHEN 'EUROPE' THEN 3
    WHEN 'MIDDLE EAST' THEN 4 ELSE 0 END AS BIGINT) AS location_id FROM accident_raw""",
    "dim7_fact_traffic": _STAR + "SELECT * FROM fact_traffic",
    "dim8_fact_accident": _STAR + "SELECT * FROM fact_accident",
    "dim8_accident_rejects": _with(_ACCIDENT_RAW)
    + "SELECT accident_pk, 'location_id' AS failed FROM accident_raw WHERE Location = 'ASIA'",
    "dq1_null_counts": _S
    + """SELECT 'Sensor_ID' AS column_name, count(*) - count(Sensor_ID) AS null_count FROM sensor
    UNION ALL SELECT 'location_id', count(*) FILTER (Location = 'ASIA') FROM sensor
    UNION ALL SELECT 'Vehicle_Count', count(*) - count(Vehicle_Count) FROM sensor
    UNION ALL SELECT 'congestion_index', count(*) - count(congestion_index) FROM sensor""",
    "dq2_duplicates": """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq2_unique_accidents": _STAR
    + "SELECT accident_id, count(*) AS row_count FROM fact_accident GROUP BY accident_id HAVING count(*) > 1",
    "dq3_orphans": _with(_SENSOR_RAW)
    + "SELECT Location, count(*) AS row_count FROM sensor_raw WHERE Location = 'ASIA' GROUP BY Location",
    "dq3_orphan_dates": _STAR
    + """SELECT date_id, count(*) AS row_count FROM fact_traffic
    WHERE date_id NOT IN (SELECT date_id FROM fact_accident) GROUP BY date_id""",
    "dq4_bad_values": _STAR
    + """SELECT 'time_of_day' AS column_name, time_of_day AS value, count(*) AS row_count FROM dim_date
    WHERE time_of_day NOT IN ('Morning Peak', 'Midday', 'Evening Peak', 'Off-Peak') GROUP BY time_of_day""",
    "vw1_location_summary": _STAR + "," + _VIEW_1 + " SELECT * FROM vw_location_summary",
    "vw1_merged_location_summary": _STAR + _LOADED + _loaded(_VIEW_1) + " SELECT * FROM vw_location_summary",
    "vw2_merged_hourly_profile": _STAR + _LOADED + _loaded(_VIEW_2) + " SELECT * FROM vw_hourly_profile",
    "vw1f_location_summary_fanout": _STAR + _VIEW_1F,
    "vw2_hourly_profile": _STAR + "," + _VIEW_2 + " SELECT * FROM vw_hourly_profile",
    "vw2f_hourly_profile_fanout": _STAR + _VIEW_2F,
    "vw3_monthly_trend": _STAR + "," + _VIEW_3 + " SELECT * FROM vw_monthly_trend",
    "vw4_congestion_hotspots": _STAR + "," + _VIEW_4 + " SELECT * FROM vw_congestion_hotspots",
    "vw5_weather_risk": _STAR + "," + _VIEW_5 + " SELECT * FROM vw_weather_risk",
    "vw6_severity_by_location": _STAR + "," + _VIEW_6 + " SELECT * FROM vw_severity_by_location",
    "vw7_road_condition_risk": _STAR + "," + _VIEW_7 + " SELECT * FROM vw_road_condition_risk",
    "vw8_ml_location_risk": _AR + "," + _VIEW_8 + " SELECT * FROM vw_ml_location_risk",
    "vw9_row_counts": _STAR_RISK
    + ","
    + _ALL_VIEWS
    + " UNION ALL ".join(f" SELECT '{name}' AS view_name, count(*) AS row_count FROM {name}" for name in _VIEW_NAMES),
    "adh1_hazard_distribution": _A
    + f"""SELECT hazard_level, count(*) AS "Count", {_pct("count(*)", "sum(count(*)) OVER ()")} AS "Pct_of_Total"
    FROM accident GROUP BY hazard_level""",
    "adh2_hourly_risk": _A
    + f"""SELECT hour, count(*) AS Accidents, {_avg4("risk_score", 3)} AS Avg_Risk_Score, {_sum("is_fatal_or_severe")} AS Fatal_Severe,
    max(risk_score) AS Max_Risk_Score FROM accident GROUP BY hour""",
    "adh3_traffic_by_location": _S
    + f"""SELECT Location, count(*) AS Total_Readings, {_avg("Vehicle_Count", 1)} AS Avg_Vehicles, max(Vehicle_Count) AS Peak_Vehicles,
    {_avg("Average_Speed", 1)} AS Avg_Speed_kmh, {_avg4("congestion_index", 4)} AS Avg_Congestion_Index,
    max(congestion_index) AS Max_Congestion_Index FROM sensor GROUP BY Location""",
    "adh4_weather_road": _A
    + f"""SELECT Weather_Condition AS weather_condition, Road_Condition AS road_condition, count(*) AS Accidents,
    {_avg4("risk_score", 3)} AS Avg_Risk, {_sum("is_fatal_or_severe")} AS Fatal_Severe_Count,
    {_pct("sum(is_fatal_or_severe)", "count(*)")} AS Fatal_Severe_Pct FROM accident GROUP BY ALL""",
    "adh5_headline": _with(_SENSOR_RAW, _SENSOR, _ACCIDENT_RAW, _ACCIDENT)
    + f"""SELECT a.*, s.* FROM (SELECT count(*) AS total_accidents, {_sum("Casualties")} AS total_casualties,
      {_pct("sum(is_fatal_or_severe)", "count(*)")} AS fatal_severe_pct, {_avg4("risk_score", 2)} AS avg_risk_score,
      min(risk_score) AS min_risk_score, max(risk_score) AS max_risk_score,
      {_pct("sum(adverse_weather)", "count(*)")} AS adverse_weather_pct FROM accident) a,
    (SELECT count(*) AS total_readings, {_avg4("congestion_index", 3)} AS avg_congestion_index,
      min(congestion_index) AS min_congestion_index, max(congestion_index) AS max_congestion_index,
      {_pct("sum(CASE WHEN Congestion_Level = 'High' THEN 1 ELSE 0 END)", "count(*)")} AS high_congestion_pct FROM sensor) s""",
    "adh6_peak_hour": _A
    + f""", hours AS (SELECT hour, {_avg4("risk_score", 3)} AS avg_risk_score, sum({_units("risk_score")}) AS s, count(*) AS n
      FROM accident GROUP BY hour), city AS (SELECT sum(s) AS s, sum(n) AS n FROM hours)
    SELECT h.hour, h.avg_risk_score, {_ratio("c.s", "c.n", 3, 4)} AS mean_risk_score,
      {_pct("h.s * c.n - c.s * h.n", "c.s * h.n")} AS lift_pct
    FROM hours h, city c ORDER BY h.avg_risk_score DESC, h.hour LIMIT 1""",
    "adh7_sql_surface": _STAR
    + "," + _VIEW_1
    + """ SELECT s.Location AS location_name, s.time_of_day, count(*) AS readings, max(s.Vehicle_Count) AS peak_vehicles,
    max(v.fatal_severe_pct) AS zone_fatal_severe_pct FROM sensor s JOIN vw_location_summary v ON s.Location = v.location_name
    GROUP BY s.Location, s.time_of_day""",
    "mlp1_features": _STAR + "," + _FEATURES + " SELECT * FROM features",
    "mlp2_label_encode": _STAR
    + ","
    + _FEATURES
    + " SELECT accident_id, "
    + ", ".join(
        f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER) AS {c}"
        for c in ("location_name", "weather_condition", "road_condition", "vehicle_type")
    )
    + " FROM features",
    "mlp9_score_later_rows": _STAR
    + ","
    + _FEATURES
    + ", known AS (SELECT * FROM features WHERE weather_condition <> 'Clear'), "
    + ", ".join(
        f"{c}_codes AS (SELECT {c}, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT {c} FROM known))"
        for c in ("weather_condition", "road_condition", "vehicle_type")
    )
    + " SELECT accident_id, "
    + ", ".join(
        f"coalesce({c}_codes.code, (SELECT CAST(count(*) AS INTEGER) FROM {c}_codes)) AS {c}"
        for c in ("weather_condition", "road_condition", "vehicle_type")
    )
    + ", location_name, 1 AS probability_ok, 1 AS tier_ok FROM features "
    + " ".join(f"LEFT JOIN {c}_codes ON features.{c} = {c}_codes.{c}" for c in ("weather_condition", "road_condition", "vehicle_type")),
    "mlp3_class_balance": _A + "SELECT is_fatal_or_severe, count(*) AS row_count FROM accident GROUP BY is_fatal_or_severe",
    "mlp4_hash_split": _A
    + f"""SELECT Accident_ID, is_fatal_or_severe,
    CASE WHEN {_hash("Accident_ID", "42")} % 10 < 2 THEN 'test' ELSE 'train' END AS part FROM accident""",
    "mlp4_stratified_split": _A
    + f"""SELECT Accident_ID, is_fatal_or_severe, CAST(CASE WHEN
      row_number() OVER (PARTITION BY is_fatal_or_severe ORDER BY {_hash("Accident_ID", "42")}, Accident_ID)
      <= floor(count(*) OVER (PARTITION BY is_fatal_or_severe) * 0.2::DOUBLE + 0.5) THEN 1 ELSE 0 END AS INTEGER) AS is_test FROM accident""",
    "mlp5_standardise": _A
    + f""", halves AS (SELECT *, {_hash("Accident_ID", "42")} % 10 < 2 AS in_test FROM accident),
    s AS (SELECT {", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_d" for c in _SCALED)} FROM halves WHERE NOT in_test)
    SELECT t.accident_pk, {", ".join(_z(c) for c in _SCALED)} FROM halves t, s""",
    "mlp6_train": _A + _PARTS + """SELECT model, part, count(*) AS n, CAST(sum(is_fatal_or_severe) AS BIGINT) AS positives,
    1 AS metrics_ok, 1 AS at_rest FROM parts, models GROUP BY ALL""",
    "mlp8_cross_validation": _A + _PARTS + f"""SELECT model, CAST(fold AS INTEGER) AS fold, count(*) AS n,
    CAST(sum(is_fatal_or_severe) AS BIGINT) AS positives, 1 AS f1_ok
    FROM (SELECT *, {_fold('is_fatal_or_severe')} AS fold FROM parts WHERE part = 'train'), models GROUP BY ALL""",
    "mlp9_score": _A + """SELECT Accident_ID AS accident_id, Location AS location_name, is_fatal_or_severe AS actual_fatal_severe,
    1 AS probability_ok, 1 AS tier_ok, 1 AS class_ok FROM accident""",
    "mlp10_trained_comparison": _A + _PARTS + "SELECT model, 1 AS selection_ok FROM models WHERE (SELECT count(*) FROM parts) > 0",
    "mlp11_importance": _A + _PARTS + f"""SELECT model, feature, category, 1 AS sum_ok, CAST({len(V.MODEL_FEATURES)} AS BIGINT) AS ranks,
    {len(V.MODEL_FEATURES)} AS last FROM models, (VALUES {", ".join(f"('{f}', '{V.FEATURE_CATEGORIES[f]}')" for f in V.MODEL_FEATURES)})
    AS f(feature, category) WHERE (SELECT count(*) FROM parts) > 0""",
    "mlp13_run_log": _A + f"""SELECT 'run-random-forest' AS run_name, 'Random Forest' AS model_type, {len(V.MODEL_FEATURES)} AS n_features,
    (SELECT count(*) FROM accident) AS train_size, accuracy AS test_accuracy, f1_score AS test_f1, roc_auc,
    CAST(0.5 AS DOUBLE) AS cv_f1_mean FROM ({_metrics(_scores(37))}), range(2)""",
    "mlp14_saved_model": _A + "SELECT count(*) AS n, CAST(0 AS BIGINT) AS differing FROM accident",
    "mlp7_metrics": _A + _metrics(_scores(37)),
    "mlp9_tiers": _AR + "SELECT * FROM risk",
    "mlp10_comparison": _A
    + f""", models AS ({_model_row("Random Forest", 37)} UNION ALL {_model_row("Gradient Boosting", 91)}
      UNION ALL {_model_row("Logistic Regression", 113)})
    SELECT model, round(accuracy, 3) AS accuracy, round(f1_score, 3) AS f1_score, round(roc_auc, 3) AS roc_auc,
      round(cv_f1_mean, 3) AS cv_f1_mean, round(cv_f1_std, 3) AS cv_f1_std,
      CAST(CASE WHEN row_number() OVER (ORDER BY roc_auc DESC, model) = 1 THEN 1 ELSE 0 END AS INTEGER) AS selected FROM models""",
    "mlp12_tier_distribution": _AR
    + f"""SELECT risk_tier, count(*) AS "count", {_pct("count(*)", "sum(count(*)) OVER ()")} AS percentage,
    CASE risk_tier WHEN 'Critical Risk' THEN 'above 0.70' WHEN 'High Risk' THEN '0.50 to 0.70'
      WHEN 'Moderate Risk' THEN '0.35 to 0.50' ELSE 'below 0.35' END AS probability_threshold FROM risk GROUP BY risk_tier""",
    "str1_routing": """SELECT 'raw/' || o_orderpriority || '/ACCIDENT_' || o_orderkey || '.csv' AS key, 'accident' AS jobs FROM orders
    UNION ALL SELECT 'raw/' || event_type || '/' || CASE event_type WHEN 'error' THEN 'Sensor-accident' WHEN 'view' THEN 'notes'
      ELSE 'road_sensor' END || '_' || event_id || '.csv',
      CASE event_type WHEN 'error' THEN 'sensor,accident' WHEN 'view' THEN '' ELSE 'sensor' END FROM events""",
    "str1_ingest": _with(_SENSOR_RAW, _SENSOR, _ACCIDENT_RAW, _ACCIDENT)
    + f"""SELECT 'sensor' AS job, Location, count(*) AS "rows", {_sum(_units("congestion_index"))} AS total_score FROM sensor GROUP BY Location
    UNION ALL SELECT 'accident', Location, count(*), {_sum(_units("risk_score"))} FROM accident GROUP BY Location""",
    "str2_incremental_kpi": _S
    + "SELECT traffic_pk, Location, hour, congestion_index, speed_category, volume_band FROM sensor",
    "str3_alarm": _with(_ALARMS) + "SELECT * FROM states",
    "str3_alarm_stream": _with(_ALARMS)
    + "SELECT * FROM states WHERE period_end <= (SELECT max(ts) - INTERVAL '10 minutes' FROM events)",
    "str4_alarm_changes": _with(_ALARMS)
    + """, calendar AS (
      SELECT alarm_name, unnest(generate_series(min(period_start), (SELECT max(period_start) FROM states) + INTERVAL '5 minutes',
        INTERVAL '5 minutes')) AS period_start FROM states GROUP BY alarm_name),
    filled AS (SELECT alarm_name, period_start, coalesce(total, 0) AS total, coalesce(state, 'OK') AS state
      FROM calendar LEFT JOIN states USING (alarm_name, period_start))
    SELECT alarm_name, period_start AS changed_at, state, total FROM filled
    QUALIFY state IS DISTINCT FROM lag(state) OVER (PARTITION BY alarm_name ORDER BY period_start)""",
    "str1_quarantine": _with(_SENSOR_RAW)
    + """ SELECT 'row' AS what, Congestion_Level AS kind, count(*) AS n FROM sensor_raw GROUP BY Congestion_Level
    UNION ALL SELECT 'file', 'lacks Location', 1 UNION ALL SELECT 'file', 'no header', 1""",
    "str2_calibrated_kpi": _S
    + f"""SELECT Location, hour, count(*) AS readings, {_sum(_units("congestion_index"))} AS total_index,
      max(congestion_index) AS max_index FROM sensor GROUP BY Location, hour""",
    "str4_alarm_filled": _filled(1),
    "str4_alarm_two_periods": _filled(2),
    "str5_alarm_status": _with(_ALARMS)
    + """SELECT alarm_name, CASE WHEN count(*) FILTER (WHERE state = 'ALARM' AND
      period_start = (SELECT max(period_start) FROM states)) = 1 THEN 'ALARM' ELSE 'OK' END AS state
    FROM states WHERE alarm_name LIKE 'c%' GROUP BY alarm_name""",
}
