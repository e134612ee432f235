"""Data behind a map: samples, cells, statistics of a selection, single records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions.geo import from_morton, grid_cell, hex_cell, hex_centre, morton, severity_colour
from roadlens.functions.numbers import mean, percent, ratio
from roadlens.functions.predicates import build_predicate
from roadlens.operators.aggregate import avg_duration, avg_severity, critical_rate, distinct_values, incidents

# Columns of a map point and of a record.
POINT = ("city", "state", "incident_context", "start_time", "duration_mins", "weather_condition", "hour_of_day")
RECORD = (
    "source_id", "severity", "start_time", "end_time", "duration_mins", "start_lat", "start_lng",
    "distance_mi", "city", "county", "state", "zipcode", "street", "timezone", "weather_condition",
    "temperature_f", "humidity_pct", "visibility_mi", "wind_speed_mph", "precipitation_in",
    "wind_direction", "incident_context", "light_condition_category", "junction", "crossing",
    "traffic_signal", "roundabout", "is_rush_hour", "is_weekend", "description",
)


def select_incidents(df: DataFrame, filters: Mapping[str, Any]) -> DataFrame:
    return df.filter(build_predicate(filters))


def sample_rows(df: DataFrame, n: int, seed: int, key: str = "id") -> DataFrame:
    """A uniform sample of ``n`` rows, the same for the same seed: those with the smallest hash.

    A first pass counts the hashes below falling powers of two. The smallest
    bound with at least ``n`` below it is enough to hold the whole sample, so
    the second pass sorts about ``n`` to ``2 n`` rows however large the table is.
    """
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    bounds = [f"{1 << bit:08x}" for bit in range(32)]
    below = df.select(draw.alias("_draw")).agg(
        *[F.count_if(F.col("_draw") < b).alias(f"b{i}") for i, b in enumerate(bounds)]
    )
    everything = F.lit("g")  # above any hexadecimal text
    enough = F.coalesce(*[F.when(F.col(f"b{i}") >= n, F.lit(b)) for i, b in enumerate(bounds)], everything)
    bound = below.select(enough).scalar()
    return df.withColumn("_draw", draw).filter(F.col("_draw") < bound).orderBy("_draw", key).limit(n).drop("_draw")


def point_sample(df: DataFrame, filters: Mapping[str, Any], n: int = 10000, seed: int = 0) -> DataFrame:
    """Sampled points of a selection with their map colour."""
    points = select_incidents(df, filters).select(
        "id", F.col("start_lat").alias("lat"), F.col("start_lng").alias("lng"), "severity", *POINT
    )
    return (
        sample_rows(points, n, seed)
        .withColumn("start_time", F.col("start_time").cast("string"))
        .withColumn("colour", severity_colour(F.col("severity")))
    )


def hex_density(df: DataFrame, radius: float = 8000.0) -> DataFrame:
    """Incidents and average severity per hexagon, with its centre; hexagons without incidents are absent."""
    q, r = hex_cell(F.col("start_lat"), F.col("start_lng"), radius)
    cells = df.filter("start_lat IS NOT NULL AND start_lng IS NOT NULL").groupBy(
        q.alias("cell_q"), r.alias("cell_r")
    )
    lat, lng = hex_centre(F.col("cell_q"), F.col("cell_r"), radius)
    return cells.agg(incidents(), avg_severity()).withColumns({"lat": lat, "lng": lng})


def heat_grid(df: DataFrame, step: float = 0.5, weight: Column | None = None, scale: int = 6) -> DataFrame:
    """Incidents and the mean weight (severity unless given) per square cell, with its centre.

    Weights are taken to ``scale`` places.
    """
    row, col = grid_cell(F.col("start_lat"), F.col("start_lng"), step)
    average = mean(F.col("severity"), 3) if weight is None else mean(weight.cast(f"decimal(18,{scale})"), 3, scale)
    cells = df.filter("start_lat IS NOT NULL AND start_lng IS NOT NULL").groupBy(
        row.alias("cell_row"), col.alias("cell_col")
    )
    half = F.lit(0.5)
    return cells.agg(incidents(), average.alias("mean_weight")).withColumns(
        {"lat": (F.col("cell_row") + half) * F.lit(step), "lng": (F.col("cell_col") + half) * F.lit(step)}
    )


#: Bits of a cell's row and column in a pyramid, half of them below zero.
CELL_BITS = 20


def heat_pyramid(df: DataFrame, step: float = 0.5, levels: int = 6) -> DataFrame:
    """``heat_grid`` at ``step`` and at ``levels`` - 1 steps that double each time, from one scan.

    Rows are added up to cells of the finest level, each known by a Morton code.
    Shifted by two bits that is the code of the cell four of them make, so every
    coarser level is added up from cells, not rows. Columns: level (0: the
    finest), step, cell (the code), cell_row, cell_col, accident_count,
    mean_weight (of severity), lat and lng of the centre.
    """
    row, col = grid_cell(F.col("start_lat"), F.col("start_lng"), step)
    half = 1 << CELL_BITS - 1
    code = morton([row + half, col + half], CELL_BITS)
    located = df.filter("start_lat IS NOT NULL AND start_lng IS NOT NULL")
    finest = located.groupBy(code.alias("cell")).agg(
        incidents(), F.sum("severity").alias("severity_sum"), F.count("severity").alias("severity_n")
    )
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))
    sums = (
        finest.withColumn("level", level)
        .groupBy("level", F.expr("shiftright(cell, 2 * level)").alias("cell"))
        .agg(*[F.sum(c).alias(c) for c in ("accident_count", "severity_sum", "severity_n")])
    )
    place = [n - F.call_function("shiftright", F.lit(half).cast("bigint"), F.col("level")) for n in from_morton(F.col("cell"), 2, CELL_BITS)]
    size = F.lit(step) * F.pow(F.lit(2.0), "level")
    return sums.select(
        F.col("level").cast("bigint").alias("level"), size.alias("step"), "cell", place[0].alias("cell_row"),
        place[1].alias("cell_col"), "accident_count", ratio(F.col("severity_sum"), F.col("severity_n"), 3).alias("mean_weight"),
    ).withColumns({c: (F.col(f"cell_{n}") + F.lit(0.5)) * F.col("step") for c, n in (("lat", "row"), ("lng", "col"))})


def selection_statistics(df: DataFrame, filters: Mapping[str, Any]) -> DataFrame:
    """One row on a selection: count, averages, critical rate, and count and share per severity."""
    levels = (1, 2, 3, 4)
    one = select_incidents(df, filters).agg(
        F.count("*").alias("total"),
        avg_severity(),
        avg_duration(1, "avg_duration"),
        critical_rate("critical_rate"),
        *[F.count_if(F.col("severity") == s).alias(f"sev{s}") for s in levels],
    )
    no_share = F.lit(0).cast("decimal(18,1)")
    shares = {f"pct{s}": F.coalesce(percent(F.col(f"sev{s}"), F.col("total"), 1), no_share) for s in levels}
    return one.withColumns(shares)


def record_detail(df: DataFrame, record: int | Column, id_column: str = "id") -> DataFrame:
    """All display columns of one incident; the id is compared in the file scan."""
    times = ("start_time", "end_time")
    return df.filter(F.col(id_column) == record).select(
        F.col(id_column).alias("id"), *[F.col(c).cast("string").alias(c) if c in times else F.col(c) for c in RECORD]
    )


def filter_options(df: DataFrame, columns: Sequence[str] = ("state", "weather_condition", "incident_context")) -> DataFrame:
    """The values to choose from, as (filter_name, value), in one scan."""
    cells = [F.struct(F.lit(c).alias("filter_name"), F.col(c).alias("value")) for c in columns]
    kept = F.col("value").isNotNull() | (F.col("filter_name") != "weather_condition")
    return df.select(F.inline(F.array(*cells))).filter(kept).distinct().orderBy("filter_name", "value")


def options_of(df: DataFrame, column: str, keep_null: bool = True) -> DataFrame:
    return distinct_values(df, column, keep_null)
