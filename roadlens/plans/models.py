"""The four intermediate models and the four marts.

Each model reads the staged rows once: they are aggregated to small cells of
additive sums, and every granularity of the model is added up from the cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions import calendar
from roadlens.functions.numbers import percent, ratio
from roadlens.operators import aggregate as agg
from roadlens.operators import windows as win

# Fixed value: from this year on the data is partial and left out of yearly figures.
PARTIAL_YEAR = 2023
# How many leading rows the marts keep.
TOP_CITIES, TOP_IN_STATE, TOP_WEATHER = 20, 5, 15


def _facets(*pairs: tuple[str, Column]) -> Column:
    """An array of (tag, value) structs, to count one cell under several headings."""
    return F.array(*[F.struct(F.lit(tag).alias("tag"), value.alias("value")) for tag, value in pairs])


def _nothing(df: DataFrame, heading: Column, counts: Sequence[str]) -> DataFrame:
    """Rows of zeros under headings that are reported in any case."""
    return df.sparkSession.range(1).select(heading, *[F.lit(0).cast("bigint").alias(c) for c in counts])


# ---------------------------------------------------------------- temporal --


def temporal_cells(staged: DataFrame) -> DataFrame:
    """Additive measures per month and hour, from which all of the temporal model is made."""
    return staged.groupBy(
        calendar.month_start(F.col("start_time")).alias("month"), F.col("hour_of_day").alias("hour")
    ).agg(*agg.additive())


def int_temporal(staged: DataFrame, partial_year: int = PARTIAL_YEAR) -> DataFrame:
    """Monthly and yearly counts with change, and hourly counts.

    The hourly period is the hour on a reference day; ``avg_duration_mins``
    carries the hour there, as it does in the published layout.
    """
    return temporal_model(temporal_cells(staged), partial_year)


def temporal_model(cells: DataFrame, partial_year: int = PARTIAL_YEAR) -> DataFrame:
    """``int_temporal`` from cells; a cell may come in several rows, which are added up."""
    month = F.col("month").cast("timestamp_ntz")
    year = F.when(F.year("month") < partial_year, F.trunc("month", "year").cast("timestamp_ntz"))
    hour = calendar.hour_on_reference_day(F.col("hour"))
    split = cells.select(
        F.explode(_facets(("monthly", month), ("yearly", year), ("hourly", hour))).alias("f"), *agg.ADDITIVE
    ).filter((F.col("f.tag") != "yearly") | F.col("f.value").isNotNull())
    sums = agg.add_up(split, [F.col("f.tag").alias("granularity"), F.col("f.value").alias("period")])
    done = agg.finished()
    w = win.order_window("period", ["granularity"])
    hourly = F.col("granularity") == "hourly"
    return sums.select(
        "granularity",
        "period",
        done["accident_count"].alias("accident_count"),
        done["avg_severity"].alias("avg_severity"),
        F.when(hourly, F.hour("period")).cast("decimal(18,2)").alias("avg_duration_mins"),
    ).select(
        "*",
        F.when(~hourly, win.previous("accident_count", w)).alias("prev_period_count"),
        F.when(~hourly, win.percent_change("accident_count", w)).alias("pct_change"),
    )


def mart_temporal(temporal: DataFrame) -> DataFrame:
    """Adds the running total of months, and the ranks of hours on rounded averages."""
    is_month = F.col("granularity") == "monthly"
    is_hour = F.col("granularity") == "hourly"
    group = ["granularity"]
    return temporal.select(
        "granularity",
        F.col("period").alias("period_date"),
        "accident_count",
        "avg_severity",
        "prev_period_count",
        F.col("pct_change").alias("mom_pct_change"),
        F.when(is_month, win.running_total("accident_count", win.order_window("period", group))).alias("running_total"),
        F.when(is_hour, win.rank("avg_severity", within=group)).alias("severity_rank"),
        F.when(is_hour, win.rank("accident_count", within=group)).alias("volume_rank"),
    )


# --------------------------------------------------------------------- geo --


def city_sums(staged: DataFrame) -> DataFrame:
    """Additive measures per city, from which all of the geographic model is made."""
    return staged.groupBy("city", "state").agg(*agg.additive())


def int_geo_hotspots(cities: DataFrame) -> DataFrame:
    """Measures and ranks per city and per state, from ``city_sums``.

    The sums are read several times: give them as a written table.
    """
    measures = [c.alias(name) for name, c in agg.finished().items()]
    city = cities.select(F.lit("city").alias("geo_level"), "city", "state", *measures)
    city = win.ranks_by_value(
        city,
        {
            "volume_rank": ("accident_count", "rank", ()),
            "severity_rank": ("avg_severity", "rank", ()),
            "rank_within_state": ("accident_count", "rank", ("state",)),
        },
    )
    state = agg.add_up(cities, ["state"]).select(
        F.lit("state").alias("geo_level"), F.lit(None).cast("string").alias("city"), "state", *measures
    )
    state = state.withColumns(
        {
            "volume_rank": win.rank("accident_count"),
            "severity_rank": win.rank("avg_severity", "dense_rank"),
            "rank_within_state": win.rank("critical_rate_pct"),
        }
    )
    return city.unionByName(state)


def mart_geo(geo: DataFrame) -> DataFrame:
    """All states, and the cities that lead overall or within their state.

    For states ``critical_rate_rank`` ranks the critical rate; for cities the
    column holds the rank within the state.
    """
    is_state = F.col("geo_level") == "state"
    leading = (F.col("volume_rank") <= TOP_CITIES) | (F.col("rank_within_state") <= TOP_IN_STATE)
    return (
        geo.filter(is_state | leading)
        .withColumnRenamed("rank_within_state", "critical_rate_rank")
        .withColumn("rank_divergence", F.when(is_state, win.divergence("volume_rank", "severity_rank")))
    )


# ------------------------------------------------------- weather and flags --

ENVIRONMENT = {
    "weather_condition": "weather_condition",
    "visibility_bucket": "visibility_bucket",
    "light_condition": "light_condition_category",
}
MODEL_FLAGS = ("junction", "crossing", "traffic_signal", "roundabout")


def int_weather_poi(
    staged: DataFrame, flags: Sequence[str] = MODEL_FLAGS, pair: tuple[str, str] = ("junction", "traffic_signal")
) -> DataFrame:
    """Per weather, visibility and light; and per flag, severity where true and where false."""
    return weather_poi_model(weather_poi_cells(staged, flags, pair), flags, pair)


def weather_poi_cells(
    staged: DataFrame, flags: Sequence[str] = MODEL_FLAGS, pair: tuple[str, str] = ("junction", "traffic_signal")
) -> DataFrame:
    """Additive measures per weather, visibility, light and flags."""
    return staged.groupBy(*ENVIRONMENT.values(), *dict.fromkeys([*flags, *pair])).agg(*agg.additive())


def weather_poi_model(
    cells: DataFrame, flags: Sequence[str] = MODEL_FLAGS, pair: tuple[str, str] = ("junction", "traffic_signal")
) -> DataFrame:
    """``int_weather_poi`` from cells; a cell may come in several rows, which are added up."""
    a, b = (F.col(c) for c in pair)
    both_names = ("junction_and_signal", "junction + signal")
    states = {f: (f, F.col(f)) for f in flags}
    states[both_names[0]] = (both_names[1], F.when(a & b, True).when(~a & ~b, False))
    yes = F.lit(True)

    def facet(kind: str, category: Column, side: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), category.alias("category"), side.alias("side"))

    facets = [facet(kind, F.col(column), yes) for kind, column in ENVIRONMENT.items()]
    facets += [facet(kind, F.lit(label), side) for kind, (label, side) in states.items()]
    split = cells.select(F.explode(F.array(*facets)).alias("f"), *agg.ADDITIVE)
    # the flags have a row each, also where nothing was selected
    flag_facets = F.array(*[facet(kind, F.lit(label), yes) for kind, (label, _) in states.items()])
    split = split.unionByName(_nothing(cells, F.explode(flag_facets).alias("f"), agg.ADDITIVE))
    sides = agg.add_up(split, ["f.kind", "f.category", "f.side"])

    def on(side: bool, column: str) -> Column:
        return F.sum(F.when(F.col("side") == F.lit(side), F.col(column)))

    rows = sides.groupBy("kind", "category").agg(
        *[on(True, c).alias(c) for c in agg.ADDITIVE],
        ratio(on(False, "severity_sum"), on(False, "severity_n"), 3).alias("avg_sev_false"),
    )
    done = agg.finished()
    is_flag = F.col("kind").isin(*states)
    share = percent(F.col("n"), F.sum("n").over(Window.partitionBy("kind")))
    no_flag = {c: F.when(~is_flag, done[c]) for c in ("avg_duration_mins", "critical_count", "critical_rate_pct")}
    return rows.select(
        F.col("kind").alias("analysis_type"),
        "category",
        F.coalesce(done["accident_count"], F.lit(0)).alias("accident_count"),
        done["avg_severity"].alias("avg_severity"),
        *[c.alias(name) for name, c in no_flag.items()],
        "avg_sev_false",
        F.when(~is_flag, share).alias("pct_of_total"),
    )


def mart_weather_poi(weather_poi: DataFrame, top: int = TOP_WEATHER) -> DataFrame:
    """The most frequent weather conditions and everything else, each with its place for display."""
    kind = F.col("analysis_type")
    weather = kind == "weather_condition"
    group = F.when(kind.isin(*ENVIRONMENT), kind).otherwise(F.lit("flag"))
    by = F.when(weather, F.col("accident_count")).otherwise(F.col("avg_severity"))
    # among visibilities and lights a missing average leads, among flags it comes last
    leads = by.isNull() & kind.isin("visibility_bucket", "light_condition")
    order = Window.partitionBy(group).orderBy(leads.desc(), by.desc_nulls_last())
    place = F.rank().over(order).cast("bigint")
    return weather_poi.withColumn("display_rank", place).filter(~weather | (F.col("display_rank") <= top))


# ------------------------------------------------------------------ funnel --


#: The steps of a severity funnel.
STEPS = ("total", "sev_2_plus", "sev_3_plus", "critical")


def funnel_cells(staged: DataFrame) -> DataFrame:
    """Funnel steps per light, context and month, from which all funnels are made."""
    return staged.groupBy(
        "light_condition_category", "incident_context", calendar.month_start(F.col("start_time")).alias("month")
    ).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("severity") >= 2).alias("sev_2_plus"),
        F.count_if(F.col("severity") >= 3).alias("sev_3_plus"),
        agg.critical("critical"),
    )


def int_funnel(staged: DataFrame, partial_year: int = PARTIAL_YEAR) -> DataFrame:
    """Severity funnels overall, by light and by context, and monthly cohorts."""
    return funnel_model(funnel_cells(staged), partial_year)


def funnel_model(cells: DataFrame, partial_year: int = PARTIAL_YEAR) -> DataFrame:
    """``int_funnel`` from cells; a cell may come in several rows, which are added up."""
    counts = STEPS
    month = F.when(F.year("month") < partial_year, F.date_format("month", "yyyy-MM"))
    facets = _facets(
        ("overall", F.lit("all")),
        ("by_light", F.col("light_condition_category")),
        ("by_context", F.col("incident_context")),
        ("monthly_cohort", month),
    )
    cohort = F.col("funnel_dimension") == "monthly_cohort"
    sums = (
        cells.select(F.explode(facets).alias("f"), *counts)
        .unionByName(_nothing(cells, F.explode(_facets(("overall", F.lit("all")))).alias("f"), counts))
        .select(F.col("f.tag").alias("funnel_dimension"), F.col("f.value").alias("dimension_value"), *counts)
        .filter(~cohort | F.col("dimension_value").isNotNull())
        .groupBy("funnel_dimension", "dimension_value")
        .agg(*[F.sum(c).alias(c) for c in counts])
    )
    period = F.to_date(F.concat("dimension_value", F.lit("-01")))
    w = win.order_window("cohort_period", ["funnel_dimension"])
    rates = agg.with_funnel_rates(sums).withColumn("cohort_period", F.when(cohort, period))
    partial = {c: F.when(~cohort, F.col(c)) for c in ("sev_2_plus", "sev_3_plus", "pct_sev_2_plus", "pct_sev_3_plus")}
    # the rate is rounded already; the next row's rounded rate is the rounded next rate
    following = F.when(cohort, win.following("critical_rate_pct", w))
    return rates.withColumn("next_period_critical_rate", following).withColumns(partial).select(
        "funnel_dimension", "dimension_value", "total", "sev_2_plus", "sev_3_plus", "critical",
        "pct_sev_2_plus", "pct_sev_3_plus", "critical_rate_pct", "cohort_period", "next_period_critical_rate",
    )


def mart_funnel(funnels: DataFrame) -> DataFrame:
    """Adds the rank by critical rate within lights and within contexts."""
    ranked = F.col("funnel_dimension").isin("by_light", "by_context")
    place = win.rank("critical_rate_pct", within=["funnel_dimension"])
    return funnels.withColumn("context_rank", F.when(ranked, place))


# -------------------------------------------------------------- highlights --


def highlights(funnels: DataFrame, geo: DataFrame, weather_poi: DataFrame, state: str = "CA") -> DataFrame:
    """Nine figures from the written marts in one row; a figure whose row is missing is NULL."""
    dimension, value, rate = F.col("funnel_dimension"), F.col("dimension_value"), F.col("critical_rate_pct")
    light, context = dimension == "by_light", dimension == "by_context"
    from_funnel = {
        "national_critical_rate": F.max(F.when(dimension == "overall", rate)),
        "night_critical_rate": F.max(F.when(light & (value == "Full_Night"), rate)),
        "day_critical_rate": F.max(F.when(light & (value == "Full_Day"), rate)),
        # highest rate, then first name
        "top_context_name": F.min_by(F.when(context, value), F.when(context, F.struct(-rate, value))),
        "top_context_rate": F.max(F.when(context, rate)),
    }
    from_geo = {"state_accidents": F.max("accident_count"), "state_critical_rate": F.max(rate)}
    kind, severity = F.col("analysis_type"), F.col("avg_severity")
    from_weather = {f"{k}_severity": F.max(F.when(kind == k, severity)) for k in ("roundabout", "junction")}
    parts = [
        (funnels.filter(dimension.isin("overall", "by_light", "by_context")), from_funnel),
        (geo.filter((F.col("geo_level") == "state") & (F.col("state") == state)), from_geo),
        (weather_poi.filter(kind.isin("roundabout", "junction")), from_weather),
    ]
    one_row = [df.agg(*[c.alias(n) for n, c in cols.items()]) for df, cols in parts]
    both = one_row[0].unionByName(one_row[1], allowMissingColumns=True).unionByName(one_row[2], allowMissingColumns=True)
    order = (
        "national_critical_rate", "night_critical_rate", "day_critical_rate", "state_accidents",
        "state_critical_rate", "roundabout_severity", "junction_severity", "top_context_name", "top_context_rate",
    )
    return both.agg(*[F.max(c).alias(c) for c in order])
