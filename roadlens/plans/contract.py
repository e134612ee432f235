"""What the tables promise: 85 checks on 14 models and their source."""

from __future__ import annotations

_SEVERITIES = [1, 2, 3, 4]
_GRANULARITIES = ["monthly", "yearly", "hourly"]
_LEVELS = ["city", "state"]
_DIMENSIONS = ["overall", "by_light", "by_context", "monthly_cohort"]
_CALENDAR = ["hour_of_day", "day_of_week", "is_weekend", "is_rush_hour"]

# The checks per model.
CONTRACT = {
    "incidents": {
        "unique": ["id"],
        "not_null": ["id", "severity", "start_time", "state", "source", "junction", "crossing", "traffic_signal", *_CALENDAR],
        "accepted": {"severity": _SEVERITIES},
    },
    "staged": {
        "unique": ["accident_id"],
        "not_null": [
            "accident_id", "source", "severity", "start_time", "state", "junction", "crossing",
            "traffic_signal", "roundabout", *_CALENDAR,
        ],
    },
    "int_temporal": {
        "not_null": ["granularity", "period", "accident_count"],
        "accepted": {"granularity": _GRANULARITIES},
    },
    "int_geo_hotspots": {
        "not_null": ["geo_level", "state", "accident_count"],
        "accepted": {"geo_level": _LEVELS},
    },
    "int_weather_poi": {"not_null": ["analysis_type", "category"]},
    "int_funnel": {
        "not_null": ["funnel_dimension", "dimension_value", "total"],
        "accepted": {"funnel_dimension": _DIMENSIONS},
    },
    "dim_location": {"unique": ["location_id"], "not_null": ["location_id", "state"]},
    "dim_time": {"unique": ["time_id"], "not_null": ["time_id", "start_time"]},
    "dim_weather": {
        "unique": ["weather_id"],
        "not_null": ["weather_id", "light_condition_category"],
        "accepted": {"light_condition_category": ["Full_Day", "Full_Night", "Dawn_Dusk_Transition"]},
    },
    "dim_road": {"unique": ["road_id"], "not_null": ["road_id", "incident_context", "junction", "crossing"]},
    "fact": {
        "unique": ["accident_id"],
        "not_null": ["accident_id", "location_id", "time_id", "weather_id", "road_id", "severity", "start_time"],
        "accepted": {"severity": _SEVERITIES},
        "relationships": {
            "location_id": ("dim_location", "location_id"),
            "time_id": ("dim_time", "time_id"),
            "weather_id": ("dim_weather", "weather_id"),
            "road_id": ("dim_road", "road_id"),
        },
    },
    "mart_temporal": {
        "not_null": ["granularity", "period_date", "accident_count"],
        "accepted": {"granularity": _GRANULARITIES},
    },
    "mart_geo": {
        "not_null": ["geo_level", "state", "accident_count"],
        "accepted": {"geo_level": _LEVELS},
    },
    "mart_weather_poi": {"not_null": ["analysis_type", "category", "display_rank"]},
    "mart_funnel": {
        "not_null": ["funnel_dimension", "dimension_value", "total"],
        "accepted": {"funnel_dimension": _DIMENSIONS},
    },
}
