"""Column names and types of the incident tables."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names and constants the results depend on ---------------------------------------

INCIDENT_ID = "ID"
SEVERITY = "Severity"
START_TIME = "Start_Time"
END_TIME = "End_Time"

# Columns removed while cleaning.
DROPPED = ["End_Lat", "End_Lng", "Wind_Chill(F)", "Precipitation(in)"]

# Text columns whose gaps become UNKNOWN.
LABELLED = [
    "Timezone",
    "Wind_Direction",
    "Weather_Condition",
    "Sunrise_Sunset",
    "Civil_Twilight",
    "Nautical_Twilight",
    "Astronomical_Twilight",
]
UNKNOWN = "Unknown"

# Measures whose gaps become the median.
MEASURED = ["Temperature(F)", "Humidity(%)", "Pressure(in)", "Visibility(mi)", "Wind_Speed(mph)"]

ROAD_FLAGS = [
    "Amenity",
    "Bump",
    "Crossing",
    "Give_Way",
    "Junction",
    "Railway",
    "Roundabout",
    "Stop",
    "Traffic_Signal",
    "Station",
]

CALENDAR = [
    "Accident_Year",
    "Accident_Month",
    "Accident_DayOfWeek",
    "Accident_Hour",
    "Is_Weekend",
    "Is_Rush_Hour",
]
DURATION = "Accident_Duration_Minutes"

# The 36 columns of the engineered table, in order.
ENGINEERED = (
    [INCIDENT_ID, SEVERITY, START_TIME, END_TIME, "Start_Lat", "Start_Lng", "Distance(mi)"]
    + MEASURED
    + ["Weather_Condition", "Wind_Direction", "State", "City", "Street", "County"]
    + ROAD_FLAGS
    + ["Weather_Timestamp"]
    + CALENDAR
    + [DURATION]
)

CLUSTER = "cluster_id"
CLUSTER_FEATURES = ["Start_Lat", "Start_Lng", "Severity"]
CLUSTER_COUNTS = range(3, 9)
SEED = 42

RISK = "Risk_Category"
PREDICTED_RISK = "Predicted_Risk"
RISK_OF_SEVERITY = {1: "Low", 2: "Medium", 3: "High", 4: "High"}
RISK_CLASSES = ["Low", "Medium", "High"]

RISK_NUMERIC = (
    ["Start_Lat", "Start_Lng", "Distance(mi)"]
    + MEASURED
    + [
        "Accident_Month",
        "Accident_DayOfWeek",
        "Accident_Hour",
        "Is_Weekend",
        "Is_Rush_Hour",
        "Accident_Duration_Minutes",
    ]
)
RISK_CATEGORICAL = ["Weather_Condition", "Wind_Direction", "State"]
RISK_BINARY = ROAD_FLAGS

# Columns carried next to each prediction.
PREDICTION_CONTEXT = [INCIDENT_ID, START_TIME, "Start_Lat", "Start_Lng", SEVERITY, RISK]

# Presentation names of the hotspot summary.
HOTSPOT_TITLES = {
    "cluster_id": "Cluster ID",
    "accident_count": "Accident Count",
    "average_severity": "Average Severity",
    "average_latitude": "Avg Latitude",
    "average_longitude": "Avg Longitude",
    "minimum_latitude": "Min Latitude",
    "maximum_latitude": "Max Latitude",
    "minimum_longitude": "Min Longitude",
    "maximum_longitude": "Max Longitude",
}

# Columns of the prediction table shown to a reader, in order.
PREDICTION_DISPLAY = PREDICTION_CONTEXT + [
    PREDICTED_RISK,
    "Probability_High",
    "Probability_Medium",
    "Probability_Low",
]

# --- Schemas ----------------------------------------------------------------------------------------


def _fields(names, dtype):
    return [T.StructField(name, dtype, True) for name in names]


RAW = T.StructType(
    _fields([INCIDENT_ID], T.StringType())
    + _fields([SEVERITY], T.IntegerType())
    + _fields([START_TIME, END_TIME], T.TimestampType())
    + _fields(["Start_Lat", "Start_Lng", "End_Lat", "End_Lng", "Distance(mi)"], T.DoubleType())
    + _fields(["Street", "City", "County", "State", "Timezone"], T.StringType())
    + _fields(["Weather_Timestamp"], T.TimestampType())
    + _fields(
        ["Temperature(F)", "Wind_Chill(F)", "Humidity(%)", "Pressure(in)", "Visibility(mi)"],
        T.DoubleType(),
    )
    + _fields(["Wind_Direction"], T.StringType())
    + _fields(["Wind_Speed(mph)", "Precipitation(in)"], T.DoubleType())
    + _fields(["Weather_Condition"], T.StringType())
    + _fields(ROAD_FLAGS, T.BooleanType())
    + _fields(
        ["Sunrise_Sunset", "Civil_Twilight", "Nautical_Twilight", "Astronomical_Twilight"],
        T.StringType(),
    )
)

_CALENDAR_FIELDS = _fields(CALENDAR, T.IntegerType()) + _fields([DURATION], T.DoubleType())

ENGINEERED_SCHEMA = T.StructType(
    [RAW[name] for name in ENGINEERED if name in RAW.names] + _CALENDAR_FIELDS
)
CLUSTERED_SCHEMA = T.StructType(ENGINEERED_SCHEMA.fields + _fields([CLUSTER], T.IntegerType()))

EVALUATION = T.StructType(
    _fields(["k"], T.IntegerType()) + _fields(["silhouette_score"], T.DoubleType())
)
IMPORTANCE = T.StructType(
    _fields(["feature"], T.StringType()) + _fields(["importance"], T.DoubleType())
)
METRICS = T.StructType(
    _fields(["metric", "class"], T.StringType()) + _fields(["value"], T.DoubleType())
)
