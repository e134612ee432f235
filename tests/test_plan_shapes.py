"""What the physical plans must and must not hold."""

from __future__ import annotations

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from roadlens.operators import aggregate as agg
from roadlens.operators import joins, maps, profile, windows
from roadlens.plans import build, models, star
from roadlens.plans.questions import QUESTIONS
from roadlens.sources import tables
from roadlens.sources.schema import FLAGS
from workload import registry


@pytest.fixture(scope="module")
def table(incidents, tmp_path_factory):
    return tables.materialise(incidents, str(tmp_path_factory.mktemp("t") / "incidents"))


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def scans(df) -> int:
    return len(re.findall(r"^\(\d+\) Scan parquet", plan(df), re.M))


@pytest.mark.parametrize("name", sorted(QUESTIONS))
def test_questions_scan_once_and_never_cross_join(table, name):
    text = plan(QUESTIONS[name](table))
    assert "Cartesian" not in text and "NestedLoop" not in text
    read = re.findall(r"^ReadSchema: (.*)$", text, re.M)
    # a count of rows for a total reads no column
    assert len([r for r in read if r != "struct<>"]) == 1 or read == ["struct<>"]
    assert len(read) <= 2


def test_shares_of_many_groups_need_no_single_task(table):
    text = plan(agg.distribution(table, "street"))
    assert "Window" not in text and "SinglePartition" not in text.split("Subqueries")[0]


def test_models_start_no_job(spark, table):
    staged = tables.stage(table)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("models", "")
    try:
        build.views(table)
        build.marts(build.views(table))
        star.fact(staged)
        assert not tracker.getJobIdsForGroup("models")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_highlights_make_their_marts_in_each_call(spark, monkeypatch):
    written, materialise = [], registry.tables.materialise
    monkeypatch.setattr(registry.tables, "materialise", lambda df, path, *a: written.append(path) or materialise(df, path, *a))
    first, again = (registry.highlights(spark, SMALL).collect() for _ in range(2))
    assert first == again and len(set(written)) == 6


def test_highlights_leave_out_the_cities(table):
    view = build.views(table)
    text = plan(models.highlights(*[build.marts(view)[m] for m in ("mart_funnel", "mart_geo", "mart_weather_poi")]))
    assert "city" not in " ".join(re.findall(r"^Keys \[.*$", text, re.M)) or "_ties" not in text


def test_star_join_reads_the_fact_once(spark, table, tmp_path):
    made = {n: tables.materialise(df, str(tmp_path / n)) for n, df in build.star_tables(tables.stage(table)).items()}
    dims = {key: made[make.__name__] for key, make in star.DIMENSIONS.items()}
    text = plan(joins.star_join(made["fact"], dims))
    assert len(re.findall(r"^Location: .*/fact/v-\w+\]", text, re.M)) == 1
    assert "LeftOuter" in text and "Cartesian" not in text


@pytest.mark.parametrize("model", [models.int_temporal, models.int_weather_poi, models.int_funnel])
def test_models_scan_once(table, model):
    assert scans(model(tables.stage(table))) == 1


def test_marts_scan_once(table):
    staged = tables.stage(table)
    assert scans(models.mart_temporal(models.int_temporal(staged))) == 1
    assert scans(models.mart_weather_poi(models.int_weather_poi(staged))) == 1
    assert scans(models.mart_funnel(models.int_funnel(staged))) == 1


def test_only_needed_columns_are_read(table):
    text = plan(agg.distribution(table, "severity"))
    assert "ReadSchema: struct<severity:int>" in text


def test_filters_reach_the_scan(table):
    filters = {"states": ["CA"], "year_range": (1996, 1997), "hour_range": (7, 9), "junction_only": True}
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan(maps.selection_statistics(table, filters))).group(1)
    for column in ("state", "start_time", "hour_of_day", "junction"):
        assert column in pushed
    assert "EqualTo(id,7)" in plan(maps.record_detail(table, 7))


def test_fact_needs_no_shuffle(table):
    assert "Exchange" not in plan(star.fact(tables.stage(table)))


def test_top_ranks_are_cut_before_the_shuffle(table):
    text = plan(windows.top_ranked(table.groupBy("state", "city").agg(agg.incidents()), "accident_count", 5, "r", ["state"]))
    assert "WindowGroupLimit" in text
    assert "WindowGroupLimit" in plan(profile.value_frequencies(table, ["street", "city"]))


def test_flags_need_one_row_of_shuffle(table):
    text = plan(agg.flag_comparison(table, FLAGS))
    assert "Expand" not in text and "SinglePartition" in text


def test_layout_prunes_years(spark, table, tmp_path):
    path = str(tmp_path / "layout")
    tables.write_layout(table, path, files=4)
    df = spark.read.parquet(path).filter((F.col("year") == 1997) & (F.col("state") == "CA"))
    assert "PartitionFilters: [isnotnull(year" in plan(df) and "EqualTo(state,CA)" in plan(df)
    assert df.count() == table.filter((F.year("start_time") == 1997) & (F.col("state") == "CA")).count()
