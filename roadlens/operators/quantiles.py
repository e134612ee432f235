"""Exact quantiles: sketches say between which values they lie, counts decide among the values between."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Size of a sketch, and how far in ranks its answers may be off: twice what it promises for 99 in 100 of them.
SKETCH = 2000
MARGIN = 2 * 2.296 / SKETCH**0.9021
#: Rows between the bounds of a column, below which no further pass narrows them.
INSIDE = 1_000_000


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`").cast("double")


@dataclass
class _Between:
    """Rows with values from ``low`` to ``high``, ``below`` rows less than these, and the places sought there."""

    name: str
    low: float
    high: float
    below: int = 0
    rows: int = 0
    places: set[int] = field(default_factory=set)

    def holds(self) -> Column:
        return column(self.name).between(self.low, self.high)


def _bounds(df: DataFrame, asked: Sequence[tuple[bytearray, int, int, int]]) -> list[tuple[float, float]]:
    """Per (sketch, n, first, last): values that the rows ranked ``first`` to ``last`` of ``n`` lie between, all but surely.

    Sketches, some 30 KB each, are read back in one row.
    """
    if not asked:
        return []
    distinct = list({bytes(sketch): None for sketch, *_ in asked})
    one = df.sparkSession.createDataFrame([tuple(distinct)], ", ".join(f"s{i} binary" for i in range(len(distinct))))
    ends = []
    for sketch, n, first, last in asked:
        name = f"s{distinct.index(bytes(sketch))}"
        for rank in (max(0.0, first / n - MARGIN), min(1.0, (last + 1) / n + MARGIN)):
            ends.append(F.kll_sketch_get_quantile_double(name, F.lit(rank)))
    row = one.select(*[e.alias(f"e{i}") for i, e in enumerate(ends)]).collect()[0]
    return list(zip(row[::2], row[1::2], strict=True))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], inside: int = INSIDE
) -> DataFrame | None:
    """Quantiles with linear interpolation between neighbours, as (column_name, p, value).

    One scan makes a sketch per column, which bounds each quantile. Where more
    than ``inside`` rows lie between two bounds, further scans narrow them. The
    last scan counts the rows below and between, and groups only the latter by
    value: of all other rows one count per task and column is shuffled. NULLs
    are left out. None if a bound misses its quantile, which sketches allow in
    rare cases, or if a column holds NaN, which they leave out.
    """
    names = {f"c{i}": c for i, c in enumerate(columns)}
    shares = [float(p) for p in probabilities]
    sizes, sought = {}, []
    first = df.agg(*[
        agg for k, c in names.items()
        for agg in (F.count(column(c)).alias(f"{k}n"), F.count_if(F.isnan(column(c))).alias(f"{k}nan"),
                    F.kll_sketch_agg_double(column(c), SKETCH).alias(f"{k}s"))
    ])
    row = first.collect()[0]
    if any(row[f"{k}nan"] for k in names):
        return None
    asked, places = [], []
    for k, c in names.items():
        sizes[c] = n = row[f"{k}n"]
        for p in shares if n else ():
            places.append((c, {math.floor(p * (n - 1)), math.ceil(p * (n - 1))}))
            asked.append((row[f"{k}s"], n, min(places[-1][1]), max(places[-1][1])))
    found = list(zip(places, _bounds(df, asked), strict=True))
    for c, n in sizes.items():
        sought += _disjoint(c, [(*ends, at) for (name, at), ends in found if name == c], n)
    if max((b.rows for b in sought), default=0) * 2 * MARGIN > inside:
        sought = _narrowed(df, sought, inside)
    values = _values(df, sought)
    out = []
    for c, n in sizes.items():
        for p in shares if n else ():
            at = p * (n - 1)
            ends = [values.get((c, place)) for place in (math.floor(at), math.ceil(at))]
            if None in ends:
                return None
            out.append((c, p, ends[0] + (ends[1] - ends[0]) * (at - math.floor(at))))
    return df.sparkSession.createDataFrame(out, "column_name string, p double, value double")


def _disjoint(name: str, bounds: list[tuple[float, float, set[int]]], rows: int) -> list[_Between]:
    """Bounds in ascending order, those that touch made one."""
    out: list[_Between] = []
    for low, high, places in sorted(bounds, key=lambda b: b[:2]):
        if out and low <= out[-1].high:
            out[-1].high = max(out[-1].high, high)
            out[-1].places |= places
        else:
            out.append(_Between(name, low, high, rows=rows, places=set(places)))
    return out


def _narrowed(df: DataFrame, sought: list[_Between], inside: int) -> list[_Between]:
    """The same bounds, with their rows counted, and as close as it takes that ``inside`` rows or one value lie between."""
    counted = False
    while not counted or any(b.rows > inside and b.low < b.high for b in sought):
        one = df.agg(*[
            agg for i, b in enumerate(sought)
            for agg in (F.count_if(column(b.name) < b.low).alias(f"below{i}"), F.count_if(b.holds()).alias(f"rows{i}"),
                        F.kll_sketch_agg_double(F.when(b.holds(), column(b.name)), SKETCH).alias(f"s{i}"))
        ])
        row, asked, of = one.collect()[0], [], []
        for i, b in enumerate(sought):
            b.below, b.rows = row[f"below{i}"], row[f"rows{i}"]
            for place in sorted(b.places) if b.rows else ():
                at = max(0, min(place - b.below, b.rows - 1))
                asked.append((row[f"s{i}"], b.rows, at, at))
                of.append((i, place))
        closer = list(zip(of, _bounds(df, asked), strict=True))
        now: list[_Between] = []
        for i, b in enumerate(sought):
            bounds = [(*ends, {place}) for (j, place), ends in closer if j == i]
            smaller = _disjoint(b.name, bounds, b.rows)
            same = len(smaller) == 1 and (smaller[0].low, smaller[0].high) == (b.low, b.high)
            now += [b] if b.rows <= inside or not smaller or same else smaller
            counted = True
        if [(b.low, b.high) for b in now] == [(b.low, b.high) for b in sought]:
            return now
        sought = now
    return sought


def inside_values(df: DataFrame, sought: Sequence[_Between]) -> DataFrame:
    """(column_name, segment, value, n): values between bounds with their counts; without a value, the rows before them."""
    by_name: dict[str, list[_Between]] = {}
    for b in sought:
        by_name.setdefault(b.name, []).append(b)
    cells = []
    for name, bounds in by_name.items():
        v = column(name)
        segment, value = F.when(F.lit(False), F.lit(0)), F.when(F.lit(False), v)
        for i, b in enumerate(sorted(bounds, key=lambda b: b.low)):
            segment = segment.when(v < b.low, 2 * i).when(v <= b.high, 2 * i + 1)
            value = value.when((v >= b.low) & (v <= b.high), v)
        cells.append(F.struct(F.lit(name).alias("column_name"), segment.alias("segment"), value.alias("value")))
    rows = df.select(F.inline(F.array(*cells))).filter("segment IS NOT NULL")
    return rows.groupBy("column_name", "segment", "value").agg(F.count("*").alias("n"))


def _values(df: DataFrame, sought: Sequence[_Between]) -> dict[tuple[str, int], float]:
    """The value at each place sought; places that the bounds missed are absent."""
    if not sought:
        return {}
    counts = inside_values(df, sought)
    so_far = Window.partitionBy("column_name").orderBy("segment", "value").rowsBetween(Window.unboundedPreceding, 0)
    places = [F.struct(F.lit(b.name).alias("of"), F.lit(p).cast("long").alias("place")) for b in sought for p in sorted(b.places)]
    found = (
        counts.withColumn("upto", F.sum("n").over(so_far))
        .filter("value IS NOT NULL")
        .withColumn("at", F.explode(F.array(*places)))
        .filter("at.of = column_name AND at.place < upto AND at.place >= upto - n")
    )
    return {(r["column_name"], r["place"]): r["value"] for r in found.select("column_name", "at.place", "value").collect()}
