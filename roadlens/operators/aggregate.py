"""Grouped measures of incidents.

The measure functions return aggregate Columns, so a query takes all it needs
in one ``groupBy(...).agg(...)``: one scan, combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions.numbers import mean, percent, ratio
from roadlens.functions.text import contains_any

# Durations strictly between these minutes are trusted.
VALID_MINUTES = (0, 1440)


def incidents() -> Column:
    return F.count("*").alias("accident_count")


def avg_severity(where: Column | None = None, name: str = "avg_severity") -> Column:
    return mean(F.col("severity"), 3, where=where).alias(name)


def valid_duration() -> Column:
    low, high = VALID_MINUTES
    return (F.col("duration_mins") > low) & (F.col("duration_mins") < high)


def avg_duration(digits: int = 2, name: str = "avg_duration_mins") -> Column:
    """Average over trusted durations only; the other rows still count in their group."""
    return mean(F.col("duration_mins"), digits, scale=2, where=valid_duration()).alias(name)


def critical(name: str = "critical_count") -> Column:
    return F.count_if(F.col("severity") == 4).alias(name)


def critical_rate(name: str = "critical_rate_pct") -> Column:
    return percent(F.count_if(F.col("severity") == 4), F.count("*")).alias(name)


def share_of_total(count: str = "accident_count", total: Column | None = None) -> Column:
    """Percent of ``total``, or of the sum over all groups, for which one task reads every group: give a total
    unless the groups are few."""
    return percent(F.col(count), F.sum(count).over(Window.partitionBy()) if total is None else total)


def distribution(df: DataFrame, by: str | Column, *measures: Column) -> DataFrame:
    """Count and share per group, then any further measures.

    The total is a count of rows apart, which reads no column; groups may be any number.
    """
    name = by if isinstance(by, str) else "value"
    key = F.col(by) if isinstance(by, str) else by.alias(name)
    grouped = df.groupBy(key).agg(incidents(), *measures)
    rest = [c for c in grouped.columns if c not in (name, "accident_count")]
    rows = df.agg(F.count("*")).scalar()
    return grouped.select(name, "accident_count", share_of_total(total=rows).alias("pct_of_total"), *rest)


def funnel(df: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Incidents at or above each severity, with percentages of the total."""
    counted = df.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("severity") >= 2).alias("sev_2_plus"),
        F.count_if(F.col("severity") >= 3).alias("sev_3_plus"),
        critical("critical"),
    )
    return with_funnel_rates(counted)


def with_funnel_rates(counted: DataFrame) -> DataFrame:
    total = F.col("total")
    return counted.withColumns(
        {
            "pct_sev_2_plus": percent(F.col("sev_2_plus"), total),
            "pct_sev_3_plus": percent(F.col("sev_3_plus"), total),
            "critical_rate_pct": percent(F.col("critical"), total),
        }
    )


def flag_comparison(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Per flag: average severity where it is true and where it is false, and how often it is true.

    One pass sums severities per combination of flags; the few combinations
    are then added up for every flag, to one row that becomes one row per flag.
    """
    combinations = df.groupBy(*flags).agg(
        F.sum("severity").alias("_sum"), F.count("severity").alias("_n"), F.count("*").alias("_rows")
    )
    sums = []
    for f in flags:
        for side, condition in (("yes", f), ("no", f"NOT {f}")):
            sums += [
                f"sum(CASE WHEN {condition} THEN _sum END) AS {f}_{side}_sum",
                f"sum(CASE WHEN {condition} THEN _n END) AS {f}_{side}_n",
            ]
        sums.append(f"coalesce(sum(CASE WHEN {f} THEN _rows END), 0) AS {f}_true")
    rows = ", ".join(
        f"struct('{f}' AS poi_feature, {f}_yes_sum AS yes_sum, {f}_yes_n AS yes_n, {f}_no_sum AS no_sum, "
        f"{f}_no_n AS no_n, {f}_true AS count_true)"
        for f in flags
    )
    return combinations.agg(*[F.expr(e) for e in sums]).selectExpr(f"inline(array({rows}))").select(
        "poi_feature",
        ratio(F.col("yes_sum"), F.col("yes_n"), 3).alias("avg_sev_true"),
        ratio(F.col("no_sum"), F.col("no_n"), 3).alias("avg_sev_false"),
        "count_true",
    )


def category_pivot(
    df: DataFrame, by: str, column: str, categories: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Counts of rows whose text holds any word of a category, one column each, and the total.

    A text may fall in several categories.
    """
    counts = [F.count_if(contains_any(F.col(column), words)).alias(name) for name, words in categories.items()]
    return df.groupBy(by).agg(*counts, F.count("*").alias("total"))


def distinct_values(df: DataFrame, column: str, keep_null: bool = True) -> DataFrame:
    values = df.select(column).distinct()
    return (values if keep_null else values.filter(F.col(column).isNotNull())).orderBy(column)


# -- measures kept as sums, so that one aggregated table can be added up again --


def additive() -> list[Column]:
    """Sums and counts from which every average and rate of a group can be made."""
    minutes = F.when(valid_duration(), (F.col("duration_mins") * 100).cast("bigint"))
    return [
        F.count("*").alias("n"),
        F.sum(F.col("severity").cast("bigint")).alias("severity_sum"),
        F.count("severity").alias("severity_n"),
        F.sum(minutes).alias("minutes_sum"),
        F.count(minutes).alias("minutes_n"),
        F.count_if(F.col("severity") == 4).alias("critical_n"),
    ]


ADDITIVE = ("n", "severity_sum", "severity_n", "minutes_sum", "minutes_n", "critical_n")


def add_up(cells: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    return cells.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ADDITIVE])


def finished() -> dict[str, Column]:
    """The reported measures of an added-up row."""
    return {
        "accident_count": F.col("n"),
        "avg_severity": ratio(F.col("severity_sum"), F.col("severity_n"), 3),
        "avg_duration_mins": ratio(F.col("minutes_sum"), F.col("minutes_n") * 100, 2),
        "critical_count": F.col("critical_n"),
        "critical_rate_pct": percent(F.col("critical_n"), F.col("n")),
    }
