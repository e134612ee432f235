"""Positions and running totals over a whole table, without one task holding it.

The table is cut into key ranges. Each range is sorted and counted on its own;
the counts, one row per range, give where each range starts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.session import settle

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row in partition below


def in_ranges(df: DataFrame, order_by: Sequence[Column], ranges: int | None = None) -> DataFrame:
    """Sorted key ranges, numbered by ``_range`` and ``_place`` (from 0) and written down.

    Range bounds are sampled, so the layout is written once and all readers see
    the same one. Rows that tie on every key may still go to several ranges, as
    the arrival number is the last key. Without keys the input's own partitions
    are the ranges and nothing is moved. Unless ``ranges`` says how many, there
    are as many as the input has partitions, or as Spark shuffles to if those are
    more, and Spark joins neighbouring ranges that came out small.
    """
    mid = F.monotonically_increasing_id()
    if order_by:
        keys = [*order_by, F.col("_arrival").asc()]
        df = df.withColumn("_arrival", mid)
        df = df.repartitionByRange(ranges, *keys) if ranges else _in_many_ranges(df, keys)
        df = df.sortWithinPartitions(*keys).drop("_arrival")
    return (
        settle(df.withColumn("_mid", mid))
        .withColumn("_range", F.shiftright("_mid", _POSITION_BITS))
        .withColumn("_place", F.col("_mid").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
        .drop("_mid")
    )


def ranges_of(df: DataFrame) -> int:
    """Partitions that ``df`` is read in, which follow its bytes."""
    return max(1, df.rdd.getNumPartitions())


def _in_many_ranges(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = ranges_of(df)
    return df.repartitionByRange(many, *keys) if many > least else df.repartitionByRange(*keys)


def number_rows(df: DataFrame, order_by: Sequence[Column], name: str, ranges: int | None = None) -> DataFrame:
    """Adds the 1-based position of each row in the order of ``order_by``."""
    laid = in_ranges(df, order_by, ranges)
    sizes = laid.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range, so this window and this broadcast hold at most `ranges` rows
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (
        laid.join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_start") + F.col("_place") + 1)
        .drop("_range", "_place", "_start")
    )


def number_by_key(table: DataFrame, key: str, name: str, ranges: int) -> DataFrame:
    """Adds the 1-based position of each row in the order of a whole-number key, NULLs first.

    For a written table: a pass over the key alone counts its values in
    ``16 * ranges`` cells of equal width, which gives the position each cell
    starts at. The rows are then shuffled once, by cell, and numbered inside. If
    the keys lie so unevenly that a cell holds several ranges' rows, sorted
    ranges are used instead.
    """
    cells = 16 * max(1, ranges)
    low, high, rows = table.agg(F.min(key), F.max(key), F.count("*")).collect()[0]
    if low is None:
        return number_rows(table, [F.col(key).asc_nulls_first()], name, ranges)
    width = max(1, -(-(high - low + 1) // cells))
    cell = F.coalesce(F.floor((F.col(key) - F.lit(low)) / F.lit(width)), F.lit(-1)).cast("bigint")
    counts = table.groupBy(cell.alias("_cell")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    # at most `cells` + 1 rows
    starts = settle(counts.select("_cell", "_size", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")))
    if starts.agg(F.max("_size")).collect()[0][0] > 4 * max(1, rows // max(1, ranges)):
        return number_rows(table, [F.col(key).asc_nulls_first()], name, ranges)
    place = F.row_number().over(Window.partitionBy("_cell").orderBy(F.col(key).asc_nulls_first()))
    numbered = table.withColumn("_cell", cell).withColumn("_place", place)
    return (
        numbered.join(F.broadcast(starts.drop("_size")), "_cell")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_cell", "_place", "_start")
    )
