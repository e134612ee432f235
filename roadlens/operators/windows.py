"""Change over time, running totals and ranks.

Windows without a partition only ever run over aggregated rows: one per month,
hour, state or category. Where the groups themselves can be many (cities),
``ranks_by_value`` ranks the distinct values instead and joins the ranks back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from roadlens.functions.numbers import percent

_KINDS = {"rank": F.rank, "dense_rank": F.dense_rank}


def order_window(order: str | Column, within: Sequence[str] = ()) -> WindowSpec:
    return Window.partitionBy(*within).orderBy(order) if within else Window.orderBy(order)


def previous(value: str, w: WindowSpec) -> Column:
    return F.lag(value).over(w)


def change(value: str, w: WindowSpec) -> Column:
    """Difference to the row before; NULL on the first."""
    return F.col(value) - F.lag(value).over(w)


def percent_change(value: str, w: WindowSpec, digits: int = 2) -> Column:
    """Change in percent of the row before; NULL on the first row and after a zero."""
    return percent(change(value, w), F.lag(value).over(w), digits)


def running_total(value: str, w: WindowSpec) -> Column:
    return F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def following(value: str | Column, w: WindowSpec) -> Column:
    return F.lead(value).over(w)


def rank(by: str | Column, kind: str = "rank", within: Sequence[str] = (), nulls: str = "first") -> Column:
    """Rank from the largest value down, ``rank`` or ``dense_rank``, NULLs first or last."""
    column = F.col(by) if isinstance(by, str) else by
    order = column.desc_nulls_first() if nulls == "first" else column.desc_nulls_last()
    return _KINDS[kind]().over(order_window(order, within)).cast("bigint")


def divergence(first: str, second: str) -> Column:
    return F.abs(F.col(first) - F.col(second))


def ranks_by_value(df: DataFrame, ranks: Mapping[str, tuple[str, str, Sequence[str]]]) -> DataFrame:
    """Adds ranks over any number of rows, as ``{name: (by, kind, within)}``, NULLs first.

    Rows are counted per distinct value, the values are ranked, and the rank is
    joined back. A window sees one row per distinct value: with counts as
    values at most sqrt(2 * rows counted), with rounded rates a few thousand.
    ``df`` is read once more per rank; give it a written table.
    """
    ranked = df
    for name, (by, kind, within) in ranks.items():
        values = df.groupBy(*within, by).agg(F.count("*").alias("_ties"))
        w = order_window(F.col(by).desc_nulls_first(), within)
        if kind == "rank":
            before = F.sum("_ties").over(w.rowsBetween(Window.unboundedPreceding, -1))
            place = F.coalesce(before, F.lit(0)) + 1
        else:
            place = F.row_number().over(w)
        keys = [*within, by]
        places = values.select(*[F.col(c).alias(f"_{c}") for c in keys], place.cast("bigint").alias(name))
        match = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
        ranked = ranked.join(places, match, "left").drop(*[f"_{c}" for c in keys])
    return ranked


def top_ranked(df: DataFrame, by: str, n: int, name: str, within: Sequence[str] = ()) -> DataFrame:
    """Rows with rank up to ``n``, ties included; Spark keeps only those per task before it shuffles."""
    return df.withColumn(name, rank(by, "rank", within)).filter(F.col(name) <= n)
