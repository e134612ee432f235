"""Joining a fact table to its dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def star_join(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """The fact rows with the attributes of every dimension, joined on its key.

    Every fact row stays: where a key is NULL or has no dimension row, the
    attributes are NULL. Spark chooses broadcast or shuffle per dimension from
    its measured size, and cuts the rows of a hot key over several tasks while
    the join runs (``session.TUNING``); a dimension has one row per key, so
    nothing multiplies. Attributes the fact has already are taken from the fact.
    """
    joined = fact
    for key, dim in dims.items():
        joined = joined.join(dim.select(*[c for c in dim.columns if c == key or c not in joined.columns]), key, "left")
    return joined


def unmatched(joined: DataFrame, attributes: Mapping[str, str]) -> DataFrame:
    """Fact rows without a dimension row, counted per key; ``attributes`` names a never-NULL attribute per key."""
    counts = [F.count_if(F.col(a).isNull()).alias(key) for key, a in attributes.items()]
    return joined.agg(*counts)
