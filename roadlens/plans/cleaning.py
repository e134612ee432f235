"""From the raw file's text columns to the clean file's 51 columns.

Every step looks at one row only, so the whole of it is a single projection
and filter over the input splits, for batches and streams alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from roadlens.functions import buckets, calendar, text
from roadlens.functions.numbers import percent
from roadlens.sources.schema import (
    DROPPED, KEPT, RAW_FLAGS, RAW_NUMBERS, RAW_TIMES, RAW_TWILIGHTS, RENAME, UNREADABLE,
)

# Columns whose missing values get past the null rule in the observed output,
# because they are turned to text first. The stated rule exempts none.
OBSERVED_EXEMPT = ("Zipcode", "Timezone")


def parse(raw: DataFrame) -> DataFrame:
    """Repairs and types; what cannot be read as its type becomes NULL. The mark of unreadable rows stays."""
    types = {"Severity": "int", "Weather_Timestamp": "timestamp_ntz"}
    types |= dict.fromkeys(RAW_NUMBERS, "double") | dict.fromkeys(RAW_FLAGS, "boolean")
    read_as = dict(raw.dtypes)
    repairs = {c: F.expr(f"try_cast(`{c}` AS {t}) AS `{c}`") for c, t in types.items() if read_as[c] != t}
    repairs |= {
        "ID": text.strip_id_prefix(F.col("ID")).alias("ID"),
        "Zipcode": text.zip_base(F.col("Zipcode")).alias("Zipcode"),
        "Timezone": text.strip_zone_prefix(F.col("Timezone")).alias("Timezone"),
        **{c: calendar.parse_wall_clock(F.col(c)).alias(c) for c in RAW_TIMES},
    }
    marks = [UNREADABLE] if UNREADABLE in raw.columns else []
    return raw.drop(*DROPPED).select(*[repairs.get(c, f"`{c}`") for c in KEPT], *marks)


def fill(parsed: DataFrame) -> DataFrame:
    """No recorded precipitation is 0.0."""
    return parsed.withColumn("Precipitation(in)", F.coalesce(F.col("`Precipitation(in)`"), F.lit(0.0)))


def _must_hold(null_exempt: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in KEPT if c not in null_exempt]


def drop_incomplete(filled: DataFrame, null_exempt: Sequence[str] = ()) -> DataFrame:
    """Drops every row with a NULL left, and rows marked as unreadable.

    The filter also looks at the split's number. Spark does not move such a
    filter below the projection, which would repair and parse every field twice.
    """
    whole = filled.withColumn("_split", F.spark_partition_id()).dropna(how="any", subset=_must_hold(null_exempt))
    if UNREADABLE in filled.columns:
        whole = whole.filter(f"NOT {UNREADABLE}")
    return whole.filter("_split >= 0").drop("_split", UNREADABLE)


def accounting(filled: DataFrame, null_exempt: Sequence[str] = ()) -> list[Column]:
    """Aggregates over the filled rows: seen, unreadable, dropped by the null rule, kept."""
    whole = " AND ".join(f"{c} IS NOT NULL" for c in _must_hold(null_exempt))
    bad = UNREADABLE if UNREADABLE in filled.columns else "false"
    counts = {
        "rows_seen": "count(*)", "rows_unreadable": f"count_if({bad})",
        "rows_dropped": f"count_if(NOT {bad} AND NOT ({whole}))", "rows_kept": f"count_if(NOT {bad} AND {whole})",
    }
    return [F.expr(count).alias(name) for name, count in counts.items()]


def rejected(raw: DataFrame) -> DataFrame:
    """The rows of a raw file that hold an unreadable field or the wrong number of fields."""
    return raw.filter(UNREADABLE).drop(UNREADABLE)


def engineered(start: Column, end: Column, temperature: Column, visibility: Column, twilights) -> dict[str, Column]:
    """The derived columns that need no text."""
    hour = F.hour(start)
    return {
        "duration_mins": calendar.minutes_between(start, end),
        "hour_of_day": hour,
        "day_of_week": calendar.day_name(start),
        "is_weekend": calendar.is_weekend(start),
        "is_rush_hour": calendar.in_hour_ranges(hour),
        "temp_bucket": buckets.temperature_bucket(temperature),
        "visibility_bucket": buckets.visibility_bucket(visibility),
        "light_condition_category": buckets.light_condition(list(twilights)),
    }


def add_features(rows: DataFrame) -> DataFrame:
    derived = engineered(
        F.col("Start_Time"), F.col("End_Time"), F.col("`Temperature(F)`"), F.col("`Visibility(mi)`"),
        [F.col(c) for c in RAW_TWILIGHTS],
    )
    fallback = text.location_fallback("Junction", "Crossing", "Traffic_Signal")
    return text.classify(rows.withColumns(derived), "Description", "incident_context", fallback=fallback)


def clean(raw: DataFrame, null_exempt: Sequence[str] = (), totals: Observation | None = None) -> DataFrame:
    """The 51 clean columns. ``totals`` receives the row counts of the run that reads the result."""
    rows = fill(parse(raw))
    if totals is not None:
        rows = rows.observe(totals, *accounting(rows, null_exempt))
    return add_features(drop_incomplete(rows, null_exempt)).select(*[f"`{c}`" for c in RENAME])


def reading_totals(raw: DataFrame, null_exempt: Sequence[str] = ()) -> DataFrame:
    """Rows seen, unreadable, dropped by the null rule and kept, without cleaning them."""
    rows = fill(parse(raw))
    counts = rows.agg(*accounting(rows, null_exempt))
    share = percent(F.col("rows_dropped"), F.col("rows_seen"), 3)
    return counts.withColumn("dropped_pct", F.coalesce(share, F.lit(0).cast("decimal(18,3)")))


def clean_totals(raw: DataFrame, null_exempt: Sequence[str] = ()) -> DataFrame:
    """Rows seen, dropped by the null rule and kept, without cleaning them."""
    return reading_totals(raw, null_exempt).drop("rows_unreadable")
