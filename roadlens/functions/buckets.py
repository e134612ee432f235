"""Right-closed numeric buckets and category labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper edges (inclusive) and labels.
TEMPERATURE = ((32, 50, 70, 90), ("Freezing", "Cold", "Mild", "Warm", "Hot"))
VISIBILITY = ((1, 5), ("Low", "Moderate", "Clear"))
# Labels derived from the four twilight columns.
LIGHT = ("Full_Day", "Full_Night", "Dawn_Dusk_Transition")


def bucket(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``labels[i]`` for the first edge that ``value`` does not exceed; NULL and NaN stay NULL."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges is needed")
    label = F.when(value.isNull() | F.isnan(value.cast("double")), F.lit(None))
    for edge, name in zip(edges, labels, strict=False):
        label = label.when(value <= F.lit(edge), F.lit(name))
    return label.otherwise(F.lit(labels[-1]))


def temperature_bucket(value: Column) -> Column:
    return bucket(value, *TEMPERATURE)


def visibility_bucket(value: Column) -> Column:
    return bucket(value, *VISIBILITY)


def light_condition(columns: Sequence[Column]) -> Column:
    """All say Day, all say Night, or the twilight in between."""
    day, night, between = LIGHT
    return (
        F.when(reduce(and_, [c == "Day" for c in columns]), F.lit(day))
        .when(reduce(and_, [c == "Night" for c in columns]), F.lit(night))
        .otherwise(F.lit(between))
    )


def position_in(value: Column, order: Sequence[str]) -> Column:
    """1-based place of a category in a given order, for sorting; NULL if not listed."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), value)
    return F.nullif(place, F.lit(0).cast("bigint"))


def compound_flags(first: Column, second: Column, first_name: str, second_name: str) -> Column:
    """Both, one only, or neither of two flags; a NULL flag counts as neither."""
    return (
        F.when(first & second, F.lit(f"{first_name} + {second_name}"))
        .when(first & ~second, F.lit(f"{first_name} only"))
        .when(~first & second, F.lit(f"{second_name} only"))
        .otherwise(F.lit("neither"))
    )
