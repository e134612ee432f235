"""Column names and types of the raw file, the clean file and the typed table."""

from __future__ import annotations

from pyspark.sql import types as T

# Header names of the clean file and their names in the table.
# The raw file has the first 42 of them and the dropped ones.
RENAME = {
    "ID": "source_id",
    "Source": "source",
    "Severity": "severity",
    "Start_Time": "start_time",
    "End_Time": "end_time",
    "Start_Lat": "start_lat",
    "Start_Lng": "start_lng",
    "Distance(mi)": "distance_mi",
    "Description": "description",
    "Street": "street",
    "City": "city",
    "County": "county",
    "State": "state",
    "Zipcode": "zipcode",
    "Timezone": "timezone",
    "Airport_Code": "airport_code",
    "Weather_Timestamp": "weather_timestamp",
    "Temperature(F)": "temperature_f",
    "Humidity(%)": "humidity_pct",
    "Pressure(in)": "pressure_in",
    "Visibility(mi)": "visibility_mi",
    "Wind_Direction": "wind_direction",
    "Wind_Speed(mph)": "wind_speed_mph",
    "Precipitation(in)": "precipitation_in",
    "Weather_Condition": "weather_condition",
    "Amenity": "amenity",
    "Bump": "bump",
    "Crossing": "crossing",
    "Give_Way": "give_way",
    "Junction": "junction",
    "No_Exit": "no_exit",
    "Railway": "railway",
    "Roundabout": "roundabout",
    "Station": "station",
    "Stop": "stop",
    "Traffic_Calming": "traffic_calming",
    "Traffic_Signal": "traffic_signal",
    "Turning_Loop": "turning_loop",
    "Sunrise_Sunset": "sunrise_sunset",
    "Civil_Twilight": "civil_twilight",
    "Nautical_Twilight": "nautical_twilight",
    "Astronomical_Twilight": "astronomical_twilight",
    "duration_mins": "duration_mins",
    "hour_of_day": "hour_of_day",
    "day_of_week": "day_of_week",
    "is_weekend": "is_weekend",
    "is_rush_hour": "is_rush_hour",
    "temp_bucket": "temp_bucket",
    "visibility_bucket": "visibility_bucket",
    "light_condition_category": "light_condition_category",
    "incident_context": "incident_context",
}
# Raw columns that cleaning leaves out.
DROPPED = ("End_Lat", "End_Lng", "Country", "Wind_Chill(F)")
ENGINEERED = tuple(RENAME)[42:]
KEPT = tuple(RENAME)[:42]

# The 13 road-feature flags.
FLAGS = (
    "amenity", "bump", "crossing", "give_way", "junction", "no_exit", "railway",
    "roundabout", "station", "stop", "traffic_calming", "traffic_signal", "turning_loop",
)
TWILIGHTS = ("sunrise_sunset", "civil_twilight", "nautical_twilight", "astronomical_twilight")
RAW_FLAGS = tuple(raw for raw, name in RENAME.items() if name in FLAGS)
RAW_TWILIGHTS = tuple(raw for raw, name in RENAME.items() if name in TWILIGHTS)
RAW_TIMES = ("Start_Time", "End_Time")
RAW_NUMBERS = (
    "Start_Lat", "Start_Lng", "Distance(mi)", "Temperature(F)", "Humidity(%)", "Pressure(in)",
    "Visibility(mi)", "Wind_Speed(mph)", "Precipitation(in)",
)

# Types of the table where a column is not text.
TYPES = {
    "source_id": "bigint",
    "severity": "int",
    "start_time": "timestamp_ntz",
    "end_time": "timestamp_ntz",
    "duration_mins": "decimal(10,2)",
    "start_lat": "double",
    "start_lng": "double",
    "distance_mi": "decimal(8,3)",
    "weather_timestamp": "timestamp_ntz",
    "temperature_f": "decimal(5,2)",
    "humidity_pct": "decimal(5,2)",
    "pressure_in": "decimal(5,2)",
    "visibility_mi": "decimal(6,2)",
    "wind_speed_mph": "decimal(6,2)",
    "precipitation_in": "decimal(6,2)",
    "hour_of_day": "int",
    **{flag: "boolean" for flag in (*FLAGS, "is_weekend", "is_rush_hour")},
}
# Longest text the table takes, where it is limited.
MAX_LENGTH = {
    "state": 2, "zipcode": 10, "airport_code": 10, "wind_direction": 20, "sunrise_sunset": 10,
    "civil_twilight": 10, "nautical_twilight": 10, "astronomical_twilight": 10, "day_of_week": 10,
    "temp_bucket": 15, "visibility_bucket": 15, "light_condition_category": 25, "incident_context": 40,
}
REQUIRED = ("severity", "start_time")
#: Marks rows of a raw file with a field that is there but cannot be read.
UNREADABLE = "_unreadable"
# Column order of the table: core, place, weather, flags, light, engineered, text.
TABLE_COLUMNS = (
    "source_id", "source", "severity", "start_time", "end_time", "duration_mins",
    "start_lat", "start_lng", "distance_mi", "street", "city", "county", "state", "zipcode",
    "timezone", "airport_code",
    "weather_timestamp", "temperature_f", "humidity_pct", "pressure_in", "visibility_mi",
    "wind_direction", "wind_speed_mph", "precipitation_in", "weather_condition",
    *FLAGS, *TWILIGHTS,
    "hour_of_day", "day_of_week", "is_weekend", "is_rush_hour", "temp_bucket",
    "visibility_bucket", "light_condition_category", "incident_context",
    "description",
)
# Texts that stand for a missing value in the raw file.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def raw_schema(columns) -> T.StructType:
    """Types of a raw file, never inferred: numbers and flags by name, all else text."""
    types = {
        "Severity": T.IntegerType(),
        **{c: T.DoubleType() for c in RAW_NUMBERS},
        **{c: T.BooleanType() for c in RAW_FLAGS},
    }
    return T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in columns])


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
