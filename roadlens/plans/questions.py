"""The analytical questions, each a function of the incident table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions import buckets, calendar
from roadlens.functions.numbers import mean, percent, quotient
from roadlens.operators import aggregate as agg
from roadlens.operators import windows as win
from roadlens.sources.schema import FLAGS

# Words that place a weather text in a column of the pivot, and its states.
PIVOT_WORDS = {
    "clear": ("clear",),
    "rain": ("rain", "shower"),
    "snow": ("snow", "sleet"),
    "fog": ("fog", "mist"),
    "cloudy": ("cloud", "overcast"),
}
PIVOT_STATES = ("CA", "FL", "TX", "SC", "NY")


# ------------------------------------------------------------- distributions


def total_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_accidents"))


def by_severity(df: DataFrame) -> DataFrame:
    return agg.distribution(df, "severity").orderBy("severity")


def by_state(df: DataFrame) -> DataFrame:
    ranked = agg.distribution(df, "state").withColumn("state_rank", win.rank("accident_count"))
    return ranked.orderBy(F.desc("accident_count"), "state")


def by_source(df: DataFrame) -> DataFrame:
    return agg.distribution(df, "source").orderBy(F.desc("accident_count"), "source")


def by_context(df: DataFrame) -> DataFrame:
    return agg.distribution(df, "incident_context").orderBy(F.desc("accident_count"), "incident_context")


def by_hour(df: DataFrame) -> DataFrame:
    return agg.distribution(df, "hour_of_day").orderBy("hour_of_day")


def by_weekday(df: DataFrame) -> DataFrame:
    place = buckets.position_in(F.col("day_of_week"), calendar.WEEKDAYS)
    return agg.distribution(df, "day_of_week").orderBy(place.asc_nulls_last())


def top_weather(df: DataFrame, n: int = 15) -> DataFrame:
    rows = agg.distribution(df, "weather_condition", agg.avg_severity())
    return rows.orderBy(F.desc("accident_count"), "weather_condition").limit(n)


def by_temperature(df: DataFrame) -> DataFrame:
    rows = df.groupBy("temp_bucket").agg(agg.incidents(), agg.avg_severity(), agg.avg_duration())
    return rows.orderBy(buckets.position_in(F.col("temp_bucket"), buckets.TEMPERATURE[1]).asc_nulls_last())


# ------------------------------------------------------------------ over time


def _per_month(df: DataFrame, count: str) -> DataFrame:
    month = calendar.month_start(F.col("start_time")).alias("accident_month")
    return df.groupBy(month).agg(F.count("*").alias(count))


def monthly_change(df: DataFrame) -> DataFrame:
    w = win.order_window("accident_month")
    return _per_month(df, "accident_count").select(
        "accident_month",
        "accident_count",
        win.previous("accident_count", w).alias("prev_month_count"),
        win.change("accident_count", w).alias("mom_change"),
        win.percent_change("accident_count", w).alias("mom_pct_change"),
    ).orderBy("accident_month")


def yearly_change(df: DataFrame) -> DataFrame:
    w = win.order_window("accident_year")
    years = df.groupBy(F.year("start_time").alias("accident_year")).agg(agg.incidents())
    return years.select(
        "accident_year",
        "accident_count",
        win.previous("accident_count", w).alias("prev_year_count"),
        win.change("accident_count", w).alias("yoy_change"),
        win.percent_change("accident_count", w).alias("yoy_pct_change"),
    ).orderBy("accident_year")


def running_total(df: DataFrame) -> DataFrame:
    total = win.running_total("monthly_count", win.order_window("accident_month"))
    return _per_month(df, "monthly_count").withColumn("running_total", total).orderBy("accident_month")


def _ranked_on_unrounded(df: DataFrame, by: str, kind: str) -> DataFrame:
    """Count, average severity and the ranks of both; the average is ranked before rounding."""
    raw = df.groupBy(by).agg(
        agg.incidents(),
        agg.avg_severity(),
        quotient(F.sum(F.col("severity").cast("bigint")), F.count("severity")).alias("_average"),
    )
    return raw.withColumns(
        {"severity_rank": win.rank("_average", kind), "volume_rank": win.rank("accident_count", kind)}
    ).drop("_average")


def hour_ranks(df: DataFrame) -> DataFrame:
    rows = _ranked_on_unrounded(df, "hour_of_day", "rank")
    return rows.orderBy(F.col("avg_severity").desc_nulls_first(), "hour_of_day")


def rush_hour_split(df: DataFrame) -> DataFrame:
    return agg.distribution(df, "is_rush_hour", agg.avg_severity(), agg.avg_duration()).orderBy("is_rush_hour")


def weekend_split(df: DataFrame) -> DataFrame:
    return df.groupBy("is_weekend").agg(agg.incidents(), agg.avg_severity(), agg.avg_duration())


# ------------------------------------------------------------------- hotspots


def top_cities(df: DataFrame, n: int = 20) -> DataFrame:
    cities = df.groupBy("city", "state").agg(agg.incidents(), agg.avg_severity(), agg.avg_duration())
    return win.top_ranked(cities, "accident_count", n, "city_rank").orderBy("city_rank", "state", "city")


def top_cities_per_state(df: DataFrame, n: int = 5) -> DataFrame:
    cities = df.groupBy("state", "city").agg(agg.incidents(), agg.avg_severity())
    ranked = win.top_ranked(cities, "accident_count", n, "rank_within_state", ["state"])
    return ranked.orderBy("state", "rank_within_state", "city")


def state_ranks(df: DataFrame) -> DataFrame:
    rows = _ranked_on_unrounded(df, "state", "dense_rank")
    return rows.orderBy(F.col("avg_severity").desc_nulls_first(), "state")


def state_rank_divergence(df: DataFrame, n: int = 15) -> DataFrame:
    rows = _ranked_on_unrounded(df, "state", "dense_rank")
    rows = rows.withColumn("rank_divergence", win.divergence("severity_rank", "volume_rank"))
    return rows.orderBy(F.desc("rank_divergence"), "state").limit(n)


# ---------------------------------------------------------- weather and roads


def by_visibility(df: DataFrame) -> DataFrame:
    distance = mean(F.col("distance_mi"), 3, scale=3).alias("avg_distance_mi")
    rows = df.groupBy("visibility_bucket").agg(agg.incidents(), agg.avg_severity(), distance)
    return rows.orderBy(buckets.position_in(F.col("visibility_bucket"), buckets.VISIBILITY[1]).asc_nulls_last())


def by_light(df: DataFrame) -> DataFrame:
    rows = df.groupBy("light_condition_category").agg(agg.incidents(), agg.avg_severity())
    return rows.orderBy(F.col("avg_severity").desc_nulls_first(), "light_condition_category")


def flags_compared(df: DataFrame, flags: Sequence[str] = FLAGS) -> DataFrame:
    return agg.flag_comparison(df, flags).orderBy(F.col("avg_sev_true").desc_nulls_last(), "poi_feature")


def compound_flags(df: DataFrame) -> DataFrame:
    label = buckets.compound_flags(F.col("junction"), F.col("traffic_signal"), "junction", "signal")
    rows = df.groupBy(label.alias("road_context")).agg(agg.incidents(), agg.avg_severity(), agg.avg_duration())
    return rows.orderBy(F.col("avg_severity").desc_nulls_first(), "road_context")


def weather_pivot(
    df: DataFrame,
    states: Sequence[str] = PIVOT_STATES,
    categories: Mapping[str, Sequence[str]] = PIVOT_WORDS,
) -> DataFrame:
    chosen = df.filter(F.col("state").isin(*states))
    return agg.category_pivot(chosen, "state", "weather_condition", categories).orderBy(F.desc("total"), "state")


# -------------------------------------------------------------------- funnels


def severity_funnel(df: DataFrame) -> DataFrame:
    return agg.funnel(df).select(
        F.col("total").alias("total_accidents"),
        F.col("sev_2_plus").alias("severity_2_plus"),
        F.col("sev_3_plus").alias("severity_3_plus"),
        F.col("critical").alias("severity_4_critical"),
        "pct_sev_2_plus",
        "pct_sev_3_plus",
        F.col("critical_rate_pct").alias("pct_sev_4"),
    )


def funnel_by_light(df: DataFrame) -> DataFrame:
    rows = agg.funnel(df, ["light_condition_category"]).select(
        "light_condition_category", "total", "sev_2_plus", "sev_3_plus",
        F.col("critical").alias("sev_4"), F.col("critical_rate_pct").alias("pct_critical"),
    )
    return rows.orderBy(F.col("pct_critical").desc_nulls_first(), "light_condition_category")


def funnel_by_context(df: DataFrame) -> DataFrame:
    rows = agg.funnel(df, ["incident_context"]).select(
        "incident_context", "total", F.col("sev_3_plus").alias("serious_or_worse"), "critical", "critical_rate_pct"
    )
    return rows.orderBy(F.col("critical_rate_pct").desc_nulls_first(), "incident_context")


def monthly_cohorts(df: DataFrame) -> DataFrame:
    month = calendar.month_start(F.col("start_time")).alias("cohort_month")
    counted = df.groupBy(month).agg(F.count("*").alias("total"), agg.critical("critical"))
    rates = counted.withColumn("critical_rate_pct", percent(F.col("critical"), F.col("total")))
    following = win.following("critical_rate_pct", win.order_window("cohort_month"))
    return rates.withColumn("next_month_critical_rate", following).orderBy("cohort_month")


def state_funnel(df: DataFrame) -> DataFrame:
    """Critical rate per state; the rank is on the unrounded rate."""
    counted = df.groupBy("state").agg(
        F.count("*").alias("total_accidents"), agg.critical("critical"), agg.avg_severity()
    )
    rate = quotient(F.col("critical"), F.col("total_accidents"))
    return counted.select(
        "state",
        "total_accidents",
        "critical",
        percent(F.col("critical"), F.col("total_accidents")).alias("critical_rate_pct"),
        win.rank(rate).alias("critical_rate_rank"),
        "avg_severity",
    ).orderBy("critical_rate_rank", "state")


QUESTIONS = {
    "scan_count": total_count,
    "severity_share": by_severity,
    "state_share_rank": by_state,
    "source_share": by_source,
    "context_share": by_context,
    "hour_share": by_hour,
    "weekday_order": by_weekday,
    "top15_category": top_weather,
    "bucket_stats": by_temperature,
    "monthly_change": monthly_change,
    "yearly_change": yearly_change,
    "running_total": running_total,
    "hour_ranks": hour_ranks,
    "flag_split": rush_hour_split,
    "weekend_split": weekend_split,
    "top20_city": top_cities,
    "top5_per_state": top_cities_per_state,
    "state_dense_rank": state_ranks,
    "rank_divergence": state_rank_divergence,
    "visibility_stats": by_visibility,
    "light_stats": by_light,
    "flag_compare": flags_compared,
    "compound_flags": compound_flags,
    "category_pivot": weather_pivot,
    "funnel_overall": severity_funnel,
    "funnel_by_light": funnel_by_light,
    "funnel_by_context": funnel_by_context,
    "monthly_cohort": monthly_cohorts,
    "state_funnel": state_funnel,
}
