"""The whole pipeline as tables under one folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from roadlens.operators.quality import check_all
from roadlens.plans import models, star
from roadlens.plans.cleaning import clean
from roadlens.plans.contract import CONTRACT
from roadlens.sources.delimited import export_csv, read_raw
from roadlens.sources.tables import load_table, materialise, stage

def mart_order(name: str) -> list:
    """The published row order of a mart, with ties settled by the row's own names."""
    return {
        "mart_temporal": ["granularity", "period_date"],
        "mart_geo": [F.desc("geo_level"), "volume_rank", "state", "city"],
        "mart_weather_poi": ["analysis_type", "display_rank", "category"],
        "mart_funnel": [
            "funnel_dimension", F.col("context_rank").asc_nulls_last(),
            F.col("cohort_period").asc_nulls_last(), "dimension_value",
        ],
    }[name]


def load_raw_file(
    spark: SparkSession, raw_path: str, root: str, null_exempt: Sequence[str] = (), totals: Observation | None = None
) -> DataFrame:
    """Cleans a raw file and replaces the incident table under ``root``.

    ``totals`` receives the rows seen, dropped and kept, counted on the way.
    """
    return load_table(clean(read_raw(spark, raw_path), null_exempt, totals), f"{root}/incidents")


def views(incidents: DataFrame, cities: DataFrame | None = None) -> dict[str, DataFrame]:
    """The staged rows and the intermediate models, all lazy; ``cities`` may be written ``city_sums``."""
    staged = stage(incidents)
    cities = models.city_sums(staged) if cities is None else cities
    return {
        "staged": staged,
        "int_temporal": models.int_temporal(staged),
        "int_geo_hotspots": models.int_geo_hotspots(cities),
        "int_weather_poi": models.int_weather_poi(staged),
        "int_funnel": models.int_funnel(staged),
    }


def star_tables(staged: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_location": star.dim_location(staged),
        "dim_time": star.dim_time(staged),
        "dim_weather": star.dim_weather(staged),
        "dim_road": star.dim_road(staged),
        "fact": star.fact(staged),
    }


def marts(view: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "mart_temporal": models.mart_temporal(view["int_temporal"]),
        "mart_geo": models.mart_geo(view["int_geo_hotspots"]),
        "mart_weather_poi": models.mart_weather_poi(view["int_weather_poi"]),
        "mart_funnel": models.mart_funnel(view["int_funnel"]),
    }


def build(incidents: DataFrame, root: str, export: bool = False) -> dict[str, DataFrame]:
    """Writes star schema and marts; returns every model by name.

    The intermediate models are a few hundred rows (a row per city for the
    geographic one) and are written too, so that marts and checks do not read
    the incident table again.
    """
    cities = materialise(models.city_sums(stage(incidents)), f"{root}/city_sums")
    view = views(incidents, cities)
    tables = {"incidents": incidents, "staged": view["staged"]}
    for name, df in view.items():
        if name != "staged":
            tables[name] = materialise(df, f"{root}/{name}")
    for name, df in {**star_tables(view["staged"]), **marts(tables)}.items():
        tables[name] = materialise(df, f"{root}/{name}")
    if export:
        for name in tables:
            if name.startswith("mart_"):
                export_csv(tables[name], f"{root}/export/{name}", order_by=mart_order(name))
    return tables


def check(tables: dict[str, DataFrame]) -> DataFrame:
    """All promised checks over built tables."""
    return check_all(tables, CONTRACT)
