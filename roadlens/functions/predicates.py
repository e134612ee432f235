"""One predicate from a dictionary of user choices."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadlens.functions.calendar import years_between

# The duration range that means "no restriction".
WHOLE_DAY = (0, 1440)

_LISTS = {
    "states": "state",
    "severities": "severity",
    "weather_conditions": "weather_condition",
    "incident_contexts": "incident_context",
}
_SWITCHES = {"weekend_only": "is_weekend", "rush_hour_only": "is_rush_hour", "junction_only": "junction"}


def build_predicate(filters: Mapping[str, Any]) -> Column:
    """All chosen restrictions joined by AND; nothing chosen keeps every row.

    Keys: ``states``, ``severities``, ``weather_conditions``,
    ``incident_contexts`` (lists, empty means any), ``year_range``,
    ``hour_range``, ``duration_range`` (inclusive pairs) and ``weekend_only``,
    ``rush_hour_only``, ``junction_only`` (switches).
    """
    known = {*_LISTS, *_SWITCHES, "year_range", "hour_range", "duration_range"}
    if unknown := set(filters) - known:
        raise ValueError(f"unknown filters: {sorted(unknown)}")
    parts = [F.col(column).isin(list(filters[key])) for key, column in _LISTS.items() if filters.get(key)]
    if years := filters.get("year_range"):
        parts.append(years_between(F.col("start_time"), *years))
    if hours := filters.get("hour_range"):
        parts.append(F.col("hour_of_day").between(*hours))
    parts += [F.col(column) for key, column in _SWITCHES.items() if filters.get(key)]
    minutes = filters.get("duration_range")
    if minutes and tuple(minutes) != WHOLE_DAY:
        parts.append(F.col("duration_mins").between(*minutes))
    return reduce(and_, parts) if parts else F.lit(True)
