"""Rule-based text classes and small string repairs."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_
from string import ascii_letters

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rules = Sequence[tuple[str, Sequence[str]]]

# Context labels with their patterns. The order matters, the
# first label with a matching pattern wins.
CONTEXT_RULES: Rules = (
    ("road_closure", (r"road closed", r"closed due to", r"all lanes (?:blocked|closed)")),
    ("lane_closure", (r"\b(?:right|left|center) lane\b", r"lane (?:blocked|closed)")),
    ("shoulder_blocked", (r"\b(?:right|left) shoulder\b",)),
    ("injury_reported", (r"with injur", r"injur\w+ report", r"serious accident")),
    ("vehicle_type", (r"overturned", r"jackknif", r"tractor.trailer", r"\btruck\b", r"big rig")),
    ("pedestrian", (r"pedestrian", r"vs\.? pedestrian", r"hit.and.run")),
    ("road_work", (r"construct\w+", r"utility work", r"road work", r"lane shift")),
    ("weather_related", (r"black ice", r"flood\w*", r"reduced visibility", r"\bfog\b")),
    ("slow_traffic", (r"slow traffic", r"traffic slower", r"congestion due to", r"rear.end")),
    ("multi_vehicle", (r"multi.vehicle", r"\d+.vehicle")),
    ("disabled_vehicle", (r"\bstalled\b", r"disabled vehicle", r"vehicle fire")),
    ("debris_hazard", (r"\bdebris\b", r"object on road", r"\bhazard\b", r"fallen tree")),
)
# The pattern and labels of the location fallback.
RAMP_PATTERN = r"\bexit\b|\bramp\b"
OTHER = "other"


def matches_any(lowered: Column, patterns: Sequence[str]) -> Column:
    """Whether any pattern is found anywhere; word classes cover all of Unicode.

    Patterns that are plain words are searched for as such, which is several
    times faster than an expression.
    """
    plain = [p for p in patterns if re.fullmatch(r"[a-z0-9 ]+", p)]
    others = [p for p in patterns if p not in plain]
    tests = [lowered.contains(p) for p in plain]
    if others:
        tests.append(lowered.rlike("(?U)" + "|".join(others)))
    return F.coalesce(reduce(or_, tests), F.lit(False))


def classify(
    df: DataFrame,
    text: str,
    name: str,
    rules: Rules = CONTEXT_RULES,
    fallback: Sequence[tuple[Column, str]] = (),
    default: str = OTHER,
) -> DataFrame:
    """Adds ``name``: the first rule whose pattern occurs, else the first true
    fallback condition, else ``default``.

    The text is lowered once, in a projection of its own; later rules are only
    tried on rows that no earlier one took.
    """
    lowered = F.col("_lowered")
    label = F.when(F.lit(False), F.lit(None).cast("string"))
    for value, patterns in rules:
        label = label.when(matches_any(lowered, patterns), F.lit(value))
    for condition, value in fallback:
        label = label.when(F.coalesce(condition, F.lit(False)), F.lit(value))
    return (
        df.withColumn("_lowered", F.lower(F.col(text)))
        .withColumn(name, label.otherwise(F.lit(default)))
        .drop("_lowered")
    )


def location_fallback(junction: str, crossing: str, signal: str) -> list[tuple[Column, str]]:
    """Road-context labels for texts that say where but not what."""
    on_ramp = matches_any(F.col("_lowered"), [RAMP_PATTERN])
    return [
        (F.col(junction) & on_ramp, "location_highway_exit"),
        (F.col(junction), "location_junction"),
        (F.col(crossing), "location_crossing"),
        (F.col(signal), "location_signalized_intersection"),
    ]


def strip_id_prefix(text: Column) -> Column:
    """The number after any leading letters and hyphens."""
    return F.ltrim(text, F.lit(ascii_letters + "-")).try_cast("bigint")


def zip_base(text: Column) -> Column:
    """The part before the first hyphen, kept as text for its leading zeros."""
    return F.substring_index(text, "-", 1)


def strip_zone_prefix(text: Column) -> Column:
    return F.when(text.startswith("US/"), F.substr(text, F.lit(4))).otherwise(text)


def contains_any(value: Column, words: Sequence[str]) -> Column:
    """Case-insensitive LIKE on any of the words."""
    found = value.ilike(f"%{words[0]}%")
    for word in words[1:]:
        found = found | value.ilike(f"%{word}%")
    return found
