"""Fixed values that define the domain.

Every function takes these as parameters; the values below are only the defaults. They
have to stay as they are for results to agree with the published definitions.
"""

# Raw timestamp format.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Time features. Day numbers count from Sunday = 1; hour ranges are inclusive.
WEEKEND_DAYS = (1, 7)
PEAK_HOURS = ((7, 10), (17, 20))
DAY_PERIODS = (
    ("Morning Peak", ((7, 10),)),
    ("Midday", ((11, 13),)),
    ("Evening Peak", ((17, 20),)),
    ("Off-Peak Night", ((21, 23), (0, 5))),
)
OTHER_PERIOD = "Off-Peak Day"

# Sensor KPIs.
CONGESTION_WEIGHTS = (0.6, 0.4)
SPEED_EDGES = (20, 40, 60, 80)
SPEED_LABELS = ("Very Slow", "Slow", "Moderate", "Fast", "Very Fast")
VOLUME_EDGES = (100, 200, 300, 400)
VOLUME_LABELS = ("Very Low", "Low", "Medium", "High", "Very High")
SENSOR_STATUS = "Active"

# Accident KPIs.
SEVERITY_SCORES = {"Minor": 1, "Moderate": 2, "Severe": 3}
TOP_SEVERITY_SCORE = 4
SEVERITY_ORDER = ("Fatal", "Severe", "Moderate", "Minor")
HAZARD_EDGES = (5, 15, 30)
HAZARD_LABELS = ("Low Hazard", "Moderate Hazard", "High Hazard", "Critical Hazard")
ADVERSE_WEATHER = ("Fog", "Snow", "Storm")
HAZARDOUS_ROADS = ("Icy", "Under Construction")
FATAL_OR_SEVERE = ("Fatal", "Severe")
DENSITY_RANKS = {"Low": 1, "Moderate": 2}
TOP_DENSITY_RANK = 3
VEHICLE_CLASSES = {
    "Bicycle": "Non-Motorised",
    "Motorcycle": "Two-Wheeler",
    "Car": "Light Motor",
    "Bus": "Heavy Motor",
    "Truck": "Heavy Motor",
}
OTHER_VEHICLE_CLASS = "Other"

# Warehouse names of the raw columns.
TRAFFIC_NAMES = {
    "Sensor_ID": "sensor_id",
    "Vehicle_Count": "vehicle_count",
    "Average_Speed": "average_speed",
    "Congestion_Level": "congestion_level",
}
ACCIDENT_NAMES = {
    "Accident_ID": "accident_id",
    "Vehicle_Type": "vehicle_type",
    "Weather_Condition": "weather_condition",
    "Road_Condition": "road_condition",
    "Accident_Severity": "accident_severity",
    "Number_of_Vehicles": "number_of_vehicles",
    "Casualties": "casualties",
    "Traffic_Density": "traffic_density",
}

# City zones.
ZONE_TYPES = {
    "Downtown": "Urban Core",
    "Highway": "Highway",
    "Residential Zone": "Residential",
    "Industrial Area": "Industrial",
    "Suburbs": "Suburban",
}

# Documented domains of the warehouse columns.
DOCUMENTED_DOMAINS = {
    "zone_type": ("Urban Core", "Highway", "Residential", "Industrial", "Suburban"),
    "time_of_day": ("Morning Peak", "Midday", "Evening Peak", "Off-Peak"),
    "vehicle_class": ("Heavy Motor", "Light Motor", "Two-Wheeler", "Non-Motorised"),
    "is_adverse": (0, 1),
    "risk_tier": ("Low Risk", "Moderate Risk", "High Risk", "Critical Risk"),
}

# The severity model.
MODEL_FEATURES = (
    "location_name", "weather_condition", "road_condition", "vehicle_type",
    "hour", "is_peak_hour", "is_weekend", "month", "quarter",
    "number_of_vehicles", "traffic_density_num", "adverse_weather", "hazardous_road",
)
CATEGORICAL_FEATURES = ("location_name", "weather_condition", "road_condition", "vehicle_type")
TARGET = "is_fatal_or_severe"
FEATURE_CATEGORIES = {
    "hour": "Temporal",
    "month": "Temporal",
    "is_weekend": "Temporal",
    "quarter": "Temporal",
    "is_peak_hour": "Temporal",
    "location_name": "Spatial",
    "vehicle_type": "Vehicle",
    "number_of_vehicles": "Traffic",
    "traffic_density_num": "Traffic",
    "weather_condition": "Environmental",
    "road_condition": "Environmental",
    "hazardous_road": "Environmental",
    "adverse_weather": "Environmental",
}
MODEL_SEED = 42
TEST_SHARE = 0.2
CV_FOLDS = 5
FOREST = {"numTrees": 150, "maxDepth": 10}
BOOSTING = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 5}
LOGISTIC = {"maxIter": 1000}
TIER_EDGES = (0.35, 0.50, 0.70)
TIER_LABELS = ("Low Risk", "Moderate Risk", "High Risk", "Critical Risk")
TIER_RANGES = {
    "Critical Risk": "above 0.70",
    "High Risk": "0.50 to 0.70",
    "Moderate Risk": "0.35 to 0.50",
    "Low Risk": "below 0.35",
}
DANGEROUS_FROM = 0.505

# File routing words and alarm settings.
ROUTES = ("sensor", "accident")
ALARM_PERIOD_SECONDS = 300
ALARM_THRESHOLD = 1
ALARM_PERIODS = 1
