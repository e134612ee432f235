"""Star schema: four dimensions and the fact table, all from the staged rows.

A key is a hash of the natural key's text, so the fact computes it from its own
columns: building the star needs no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions import calendar
from roadlens.functions.keys import text_key
from roadlens.sources.schema import FLAGS, TWILIGHTS

LOCATION = ("city", "county", "state", "zipcode", "street", "timezone", "airport_code")
WEATHER = (
    "weather_condition", "wind_direction", "temp_bucket", "visibility_bucket",
    "light_condition_category", *TWILIGHTS,
)
ROAD = ("incident_context", *FLAGS)


def location_key():
    return text_key(LOCATION)


def time_key():
    return text_key(["start_time"], null_as=None)


def weather_key():
    return text_key(WEATHER)


def road_key():
    """NULL if any flag is; only the context may be missing."""
    return text_key(["coalesce(incident_context, 'null')", *FLAGS], null_as=None)


def _dimension(staged: DataFrame, columns, name: str, key) -> DataFrame:
    return staged.select(*columns).distinct().select(key.alias(name), *columns)


def dim_location(staged: DataFrame) -> DataFrame:
    return _dimension(staged, LOCATION, "location_id", location_key())


def dim_weather(staged: DataFrame) -> DataFrame:
    return _dimension(staged, WEATHER, "weather_id", weather_key())


def dim_road(staged: DataFrame) -> DataFrame:
    return _dimension(staged, ROAD, "road_id", road_key())


def dim_time(staged: DataFrame, pad_day: bool = False) -> DataFrame:
    """One row per start time; ``pad_day`` blank-pads the weekday to nine characters."""
    ts = F.col("start_time")
    hour = F.hour(ts)
    attributes = {
        "hour_of_day": hour,
        "day_of_week": calendar.day_name(ts, pad_day),
        "is_weekend": calendar.is_weekend(ts),
        "is_rush_hour": hour.isin(*calendar.DIMENSION_RUSH_HOURS),
        "month_num": F.month(ts),
        "month_name": calendar.month_name(ts),
        "year_num": F.year(ts),
        "quarter_num": F.quarter(ts),
        "month_start": calendar.month_start(ts),
        "year_start": calendar.year_start(ts),
        "is_covid_lockdown_period": calendar.in_period(ts, *calendar.LOCKDOWN),
    }
    return _dimension(staged, ["start_time"], "time_id", time_key()).withColumns(attributes)


def fact(staged: DataFrame) -> DataFrame:
    return staged.select(
        "accident_id", "source_id", "source",
        location_key().alias("location_id"), time_key().alias("time_id"),
        weather_key().alias("weather_id"), road_key().alias("road_id"),
        "severity", "duration_mins", "distance_mi", "start_lat", "start_lng", "temperature_f",
        "humidity_pct", "pressure_in", "visibility_mi", "wind_speed_mph", "precipitation_in",
        "start_time", "hour_of_day", "day_of_week", "is_weekend", "is_rush_hour",
        "description",
    )


DIMENSIONS = {
    "location_id": dim_location, "time_id": dim_time, "weather_id": dim_weather, "road_id": dim_road,
}
