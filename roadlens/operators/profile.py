"""Column profiles: missing values, value frequencies, numeric summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.functions.numbers import percent
from roadlens.operators import quantiles
from roadlens.operators.ordering import in_ranges

# Fixed values of the report.
FULL_BREAKDOWN_UP_TO = 20
TOP_N = 15
CATEGORICAL_UP_TO = 25
OTHER = "__other__"
SKIPPED = ("ID", "Description", "id", "source_id", "description")


def column(name: str) -> Column:
    """A column by its name, whatever characters that holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def null_audit(df: DataFrame) -> DataFrame:
    """Type, missing rows and their share per column, worst first, with the table's totals.

    One scan that ends in one row, which is then turned into a row per column.
    """
    fields = df.schema.fields
    counts = [F.count_if(column(f.name).isNull()).alias(f"m{i}") for i, f in enumerate(fields)]
    with_missing = reduce(add, [(F.col(f"m{i}") > 0).cast("bigint") for i in range(len(fields))])
    rows = [
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("dtype"),
                 F.col(f"m{i}").alias("missing_count"))
        for i, f in enumerate(fields)
    ]
    one = df.agg(F.count("*").alias("total_rows"), *counts)
    audit = one.select(
        F.inline(F.array(*rows)), "total_rows", F.lit(len(fields)).cast("bigint").alias("total_columns"),
        with_missing.alias("columns_with_missing_values"),
    )
    missing_pct = percent(F.col("missing_count"), F.col("total_rows"), 3)
    return audit.withColumn("missing_pct", missing_pct).orderBy(F.desc("missing_pct"), F.asc("column_name"))


def _is_number(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def classify_columns(df: DataFrame, skip: Sequence[str] = SKIPPED, limit: int = CATEGORICAL_UP_TO) -> dict[str, str]:
    """``categorical`` or ``numeric`` per column: numbers with many distinct values are numeric.

    One scan of sketches; only columns whose estimate is near the limit are
    counted exactly.
    """
    fields = [f for f in df.schema.fields if f.name not in skip]
    numbers = [f.name for f in fields if _is_number(f)]
    kinds = {f.name: "categorical" for f in fields}
    if not numbers:
        return kinds
    guess = df.agg(*[F.approx_count_distinct(column(c), 0.02).alias(c) for c in numbers]).first().asDict()
    near = [c for c in numbers if limit / 2 < guess[c] < limit * 2]
    if near:
        values = unpivot(df, near).distinct().groupBy("column_name").count()
        guess.update({r["column_name"]: r["count"] for r in values.collect()})  # one row per column
    kinds.update({c: "numeric" for c in numbers if guess[c] > limit})
    return kinds


def unpivot(df: DataFrame, columns: Sequence[str], dtype: str = "string") -> DataFrame:
    """(column_name, value) for every non-null value of the columns, in one pass over the rows."""
    cells = [
        F.struct(F.lit(c).alias("column_name"), column(c).cast(dtype).alias("value")) for c in columns
    ]
    return df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull())


def value_frequencies(
    df: DataFrame, columns: Sequence[str], full: int = FULL_BREAKDOWN_UP_TO, top: int = TOP_N
) -> DataFrame:
    """Per column all values with count and share, or the most frequent ones and the rest as one row.

    Ties are ordered by value. Values are counted with a combine before the
    shuffle; for the ranking each task keeps only its ``full + 1`` best rows
    per column, and the rest is the column's total less the rows kept.
    """
    counts = unpivot(df, columns).groupBy("column_name", "value").agg(F.count("*").alias("count"))
    totals = counts.groupBy("column_name").agg(
        F.sum("count").alias("_total"), F.count("*").alias("unique_values_total")
    )
    best = Window.partitionBy("column_name").orderBy(F.desc("count"), F.asc("value"))
    leading = counts.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= full)
    kept = leading.join(totals, "column_name").filter(
        (F.col("unique_values_total") <= full) | (F.col("_place") <= top)
    )
    rest = (
        kept.groupBy("column_name", "unique_values_total", "_total")
        .agg((F.col("_total") - F.sum("count")).alias("count"))
        .filter("count > 0")
        .withColumn("value", F.lit(OTHER))
        .withColumn("_place", F.lit(top + 1))
    )
    return kept.unionByName(rest).select(
        "column_name",
        "unique_values_total",
        (F.col("unique_values_total") > full).alias("truncated_to_top_n"),
        F.col("_place").cast("bigint").alias("place"),
        "value",
        "count",
        percent(F.col("count"), F.col("_total"), 3).alias("pct"),
    )


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Quantiles with linear interpolation between neighbours, as (column_name, p, value).

    Sketches bound them, and only values near a quantile are shuffled
    (``quantiles``); the scans run when this is called. Where bounds fail, all
    values are.
    """
    found = quantiles.exact_quantiles(df, columns, probabilities)
    return quantiles_in_ranges(df, columns, probabilities) if found is None else found


def quantiles_in_ranges(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """The same from all values, without sketches.

    Equal values are counted first. The distinct values are laid out in key
    ranges; from each range's total follows which ranges hold a wanted rank,
    and only those are searched.
    """
    counts = unpivot(df, columns, "double").groupBy("column_name", "value").agg(F.count("*").alias("n"))
    laid = in_ranges(counts, [F.col("column_name").asc(), F.col("value").asc()])
    # at most one row per range and column
    ranges = laid.groupBy("column_name", "_range").agg(F.sum("n").alias("size"))
    earlier = Window.partitionBy("column_name").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("start", F.coalesce(F.sum("size").over(earlier), F.lit(0))).withColumn(
        "total", F.sum("size").over(Window.partitionBy("column_name"))
    )
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    exact = F.col("p") * (F.col("total") - 1)
    targets = (
        ranges.withColumn("p", F.explode(wanted))
        .withColumn("fraction", exact - F.floor(exact))
        .withColumn("place", F.explode(F.array(F.floor(exact), F.ceil(exact))))
        .filter((F.col("place") >= F.col("start")) & (F.col("place") < F.col("start") + F.col("size")))
        .select("column_name", "_range", "start", "p", "fraction", "place")
        .distinct()
    )
    inside = Window.partitionBy("column_name", "_range").orderBy("_place")
    searched = (
        laid.join(F.broadcast(targets.select("column_name", "_range").distinct()), ["column_name", "_range"])
        .withColumn("upto", F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )
    found = (
        searched.join(targets, ["column_name", "_range"])
        .withColumn("local", F.col("place") - F.col("start"))
        .filter((F.col("local") < F.col("upto")) & (F.col("local") >= F.col("upto") - F.col("n")))
    )
    low, high = F.min("value"), F.max("value")
    return found.groupBy("column_name", "p").agg((low + (high - low) * F.first("fraction")).alias("value"))


def numeric_summary(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Count, extremes, mean, population deviation and quartiles per column, to three places.

    ``exact=False`` estimates the quartiles in the same scan as the rest.
    """
    def value(c: str) -> Column:
        return column(c).cast("double")

    aggregates = []
    for i, c in enumerate(columns):
        v = value(c)
        aggregates += [
            F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"),
            F.avg(v).alias(f"mean{i}"), F.stddev_pop(v).alias(f"std{i}"),
        ]
        if not exact:
            aggregates.append(F.percentile_approx(v, [0.25, 0.5, 0.75], 10000).alias(f"q{i}"))
    rows = []
    for i, c in enumerate(columns):
        quartiles = [] if exact else [F.col(f"q{i}")[k].alias(n) for k, n in enumerate(("q1", "q2", "q3"))]
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"), F.col(f"lo{i}").alias("min"),
                F.col(f"hi{i}").alias("max"), F.col(f"mean{i}").alias("mean"), F.col(f"std{i}").alias("std"),
                *quartiles,
            )
        )
    basics = df.agg(*aggregates).select(F.inline(F.array(*rows)))
    if exact:
        q = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
        quartiles = q.groupBy("column_name").agg(
            *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n)
              for p, n in ((0.25, "q1"), (0.5, "q2"), (0.75, "q3"))]
        )
        basics = basics.join(quartiles, "column_name", "left")
    return basics.select(
        "column_name",
        "count",
        *[F.round(c, 3).alias(c) for c in ("min", "max", "mean")],
        F.round("q2", 3).alias("median"),
        F.round("std", 3).alias("std"),
        F.round("q1", 3).alias("q1_25pct"),
        F.round("q3", 3).alias("q3_75pct"),
    )


def classification(df: DataFrame, skip: Sequence[str] = SKIPPED, limit: int = CATEGORICAL_UP_TO) -> DataFrame:
    """(column_name, kind) per column, as ``classify_columns`` finds it; the scan runs when this is called."""
    kinds = classify_columns(df, skip, limit)
    return df.sparkSession.createDataFrame(list(kinds.items()), "column_name string, kind string")


def profile(df: DataFrame, skip: Sequence[str] = SKIPPED, exact: bool = True) -> tuple[DataFrame, DataFrame]:
    """Frequencies of the categorical columns and summaries of the numeric ones."""
    kinds = classify_columns(df, skip)
    categorical = [c for c, kind in kinds.items() if kind == "categorical"]
    numeric = [c for c, kind in kinds.items() if kind == "numeric"]
    return value_frequencies(df, categorical), numeric_summary(df, numeric, exact)


def stats_report(df: DataFrame, skip: Sequence[str] = SKIPPED, exact: bool = True) -> DataFrame:
    """The whole statistics report in one table: frequencies and summaries, and on each row the report's header.

    Columns are told apart and quartiles bounded when this is called; the rest runs with the result.
    """
    skipped = [c for c in df.columns if c in skip]
    frequencies, summaries = profile(df, skip, exact)
    rows = frequencies.drop("unique_values_total", "truncated_to_top_n").withColumn("kind", F.lit("categorical"))
    rows = rows.unionByName(summaries.withColumn("kind", F.lit("numeric")), allowMissingColumns=True)
    return rows.withColumns({
        "total_rows": df.agg(F.count("*")).scalar(),
        "total_columns_analyzed": F.lit(len(df.columns) - len(skipped)).cast("bigint"),
        "columns_skipped": F.lit(",".join(skipped)),
    })
