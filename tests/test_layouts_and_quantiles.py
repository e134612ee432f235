"""Clustered, bucketed and filtered tables, quantiles from sketches, orphans from bitmaps, the cell pyramid."""

from __future__ import annotations

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from roadlens.functions.geo import from_morton, morton
from roadlens.operators import joins, maps, profile, quality, quantiles
from roadlens.plans import star
from roadlens.sources import tables


def files_of(df) -> list[str]:
    return sorted(f.removeprefix("file://") for f in df.inputFiles())


def may_hold(file: str, column: str, value) -> bool:
    """Whether the file's row groups may hold ``value`` by their minima and maxima."""
    meta = pq.ParquetFile(file).metadata
    i = meta.schema.names.index(column)
    stats = [meta.row_group(g).column(i).statistics for g in range(meta.num_row_groups)]
    return any(s is None or not s.has_min_max or s.min <= value <= s.max for s in stats)


def test_morton_codes_there_and_back(spark):
    rows = spark.range(200).select(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1 << 5)).alias(f"n{i}") for i in range(3)])
    code = morton([F.col(f"n{i}") for i in range(3)], 5)
    back = from_morton(code, 3, 5)
    assert rows.select(*[(F.col(f"n{i}") == back[i]).alias(f"s{i}") for i in range(3)]).filter("NOT (s0 AND s1 AND s2)").isEmpty()
    half = from_morton(F.shiftright(code, 3), 3, 5)
    assert rows.filter(F.shiftright("n1", 1) != half[1]).isEmpty()


def test_each_filter_of_a_clustered_table_skips_most_files(spark, tmp_path):
    states = F.concat(F.lit("S"), F.lpad((F.col("id") * 7919 % 48).cast("string"), 2, "0"))
    rows = spark.range(40_000).select(
        "id", F.when(F.col("id") % 3 == 0, "S07").otherwise(states).alias("state"),  # a hot state
        (F.pmod(F.xxhash64("id"), F.lit(4)) + 1).cast("int").alias("severity"),
        F.concat(F.lit("c"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9)).cast("string")).alias("incident_context"),
        F.when(F.col("id") % 50 != 0, F.pmod(F.xxhash64("id", F.lit(2)), F.lit(24)).cast("int")).alias("hour_of_day"),
    )
    laid = tables.write_clustered(rows, str(tmp_path / "t"), files=256)
    files = files_of(laid)
    assert laid.count() == 40_000 and len(files) >= 200
    assert max(pq.ParquetFile(f).metadata.num_rows for f in files) < 4 * 40_000 / len(files)
    for column, value in (("state", "S31"), ("state", "S07"), ("severity", 4), ("incident_context", "c3"), ("hour_of_day", 8)):
        read = sum(may_hold(f, column, value) for f in files)
        assert read <= 0.5 * len(files), (column, read, len(files))
    both = sum(may_hold(f, "hour_of_day", 8) and may_hold(f, "severity", 4) and may_hold(f, "state", "S31") for f in files)
    assert both <= 0.1 * len(files)
    with pytest.raises(ValueError, match="too many values"):
        tables.write_clustered(rows, str(tmp_path / "u"), by=["id"])


def rows_scanned(df) -> int:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.nodeName().startswith("AdaptiveSparkPlan"):
        plan = plan.executedPlan()
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if "Scan" in node.nodeName():
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_a_lookup_reads_one_row_group(spark, tmp_path):
    rows = spark.range(40_000).select(
        (F.xxhash64("id") % 1_000_000_007).alias("id"), F.concat(F.lit("City "), F.col("id").cast("string")).alias("city"),
        F.lit("x" * 20).alias("text"),
    ).repartition(2, "text", F.rand(3))
    found = tables.write_lookup(rows, str(tmp_path / "t"), rows=1000)
    rows.write.parquet(str(tmp_path / "plain"))
    one = found.filter("city = 'City 12345'").select("text")
    assert one.count() == 1 and rows_scanned(one) <= 3000
    key = found.filter("city = 'City 777'").collect()[0]["id"]
    assert rows_scanned(found.filter(F.col("id") == key).select("text")) <= 3000
    assert rows_scanned(spark.read.parquet(str(tmp_path / "plain")).filter("city = 'City 12345'").select("text")) >= 10_000


def test_bucketed_facts_join_without_a_shuffle(spark, incidents, tmp_path):
    staged = tables.stage(incidents)
    fact, dim = star.fact(staged), star.DIMENSIONS["location_id"](staged)
    made = [tables.save_bucketed(df, f"{n}_of_test", "location_id", 4, str(tmp_path / n)) for n, df in (("fact", fact), ("dim", dim))]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.star_join(made[0], {"location_id": made[1]})
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        plain = joins.star_join(fact, {"location_id": dim})
        assert sorted(map(str, joined.collect())) == sorted(map(str, plain.select(*joined.columns).collect()))
        hot = fact.withColumn("location_id", F.lit("one"))
        with pytest.raises(ValueError, match="one task"):
            tables.save_bucketed(hot, "hot_of_test", "location_id", 8, str(tmp_path / "hot"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in ("fact_of_test", "dim_of_test"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def plain_quantile(values: list[float], p: float) -> float:
    at = p * (len(values) - 1)
    low = int(at)
    high = min(low + (at > low), len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


@pytest.mark.parametrize("inside", [10**6, 200])
def test_quantiles_from_sketches_are_exact(spark, inside):
    draw = random.Random(inside)
    columns = {
        "spread": [draw.gauss(0, 1e6) for _ in range(30_000)],
        "hot": [7.5] * 20_000 + [draw.random() * 10 for _ in range(10_000)],
        "few": [float(draw.randint(0, 3)) for _ in range(29_000)] + [None] * 1000,
        "none": [None] * 30_000,
        "ends": [float("-inf")] * 10 + [1.0] * 29_980 + [float("inf")] * 10,
        "one": [4.25] + [None] * 29_999,
    }
    rows = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns)).repartition(7)
    chances = (0.0, 0.25, 0.5, 0.75, 0.999, 1.0)
    found = quantiles.exact_quantiles(rows, list(columns), chances, inside)
    got = {(r["column_name"], r["p"]): r["value"] for r in found.collect()}
    for c, values in columns.items():
        known = sorted(v for v in values if v is not None)
        for p in chances if known else ():
            if c != "ends":
                assert got[c, p] == pytest.approx(plain_quantile(known, p), rel=1e-12), (c, p)
        assert bool(known) or not any(k[0] == c for k in got)
    assert got["ends", 0.5] == 1.0
    ranges = {(r["column_name"], r["p"]): r["value"] for r in profile.quantiles_in_ranges(rows, list(columns)[:3], chances).collect()}
    assert all(got[k] == pytest.approx(v, rel=1e-12) for k, v in ranges.items())


def test_only_values_near_quantiles_are_shuffled(spark):
    rows = spark.range(200_000).select((F.col("id") * 1.37).alias("v"))
    between = quantiles._Between("v", 0.49 * 200_000 * 1.37, 0.51 * 200_000 * 1.37)
    cells = quantiles.inside_values(rows, [between])
    assert cells.count() <= 0.021 * 200_000 + 1
    assert quantiles.MARGIN < 0.006


def test_not_a_number_goes_the_other_way(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "v double")
    assert quantiles.exact_quantiles(rows, ["v"], [0.5]) is None
    assert profile.exact_quantiles(rows, ["v"], [0.5]).collect()[0]["value"] == 2.0


@pytest.mark.parametrize("gap", [1, 50_000_000_000])
def test_orphans_from_bitmaps(spark, gap):
    draw = random.Random(gap)
    parents = sorted(draw.sample(range(-70_000, 140_000), 60_000))
    keys = [draw.choice(parents) for _ in range(5000)] + [None, None, 99_999_999, 99_999_999, -70_001, 0, -1, 1, 32_768, -32_768]
    child = spark.createDataFrame([(k * gap if k is not None else None, "x") for k in keys], "k long, bucket string")
    parent = spark.createDataFrame([(p * gap, "y") for p in [*parents, *parents[:9]]], "p long, bucket string")
    expected = sorted(tuple(r) for r in quality.orphans(child, "k", parent, "p").collect())
    assert sorted(tuple(r) for r in quality.orphans_by_bitmap(child, "k", parent, "p").collect()) == expected
    none = quality.orphans_by_bitmap(child.limit(0), "k", parent, "p")
    assert none.count() == 0 and quality.orphans_by_bitmap(child.filter("k > 0"), "k", parent.limit(0), "p").count() > 0
    text = quality.orphans_by_bitmap(child.select(F.col("k").cast("string")), "k", parent.select(F.col("p").cast("string")), "p")
    assert text.count() == len(expected)


def test_each_level_of_the_pyramid_is_the_grid_of_its_step(spark, incidents):
    rows = incidents.unionByName(incidents.limit(3).withColumn("start_lat", F.lit(None).cast("double")))
    pyramid = maps.heat_pyramid(rows, 0.25, 5)
    plan = pyramid._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == plan.count("FileScan parquet") <= 2
    names = ["cell_row", "cell_col", "accident_count", "mean_weight", "lat", "lng"]
    for level in range(5):
        grid = maps.heat_grid(rows, 0.25 * 2**level).select(*names)
        own = pyramid.filter(F.col("level") == level).select(*names)
        assert sorted(map(str, own.collect())) == sorted(map(str, grid.collect()))
