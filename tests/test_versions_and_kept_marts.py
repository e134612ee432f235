"""Refreshed tables, and marts that batches are added to."""

from __future__ import annotations

import glob

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from roadlens.plans import models
from roadlens.sources import tables, versions
from roadlens.streaming import marts


def numbers(spark, n):
    return spark.range(n).select(F.col("id"), (F.col("id") % 3).alias("k"))


def failing(spark):
    return spark.range(1000).select(F.when(F.col("id") == 777, F.raise_error(F.lit("stopped"))).otherwise(F.col("id")).alias("id"))


def test_a_failed_refresh_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no committed version"):
        versions.read_version(spark, path)
    versions.publish(numbers(spark, 10), path)
    with pytest.raises(PySparkException, match="stopped"):
        versions.publish(failing(spark), path)
    assert versions.read_version(spark, path).count() == 10 and versions.committed(spark, path) == 1
    assert len(glob.glob(f"{path}/v-*")) == 1 and len(glob.glob(f"{path}/_commits/*")) == 1


def test_a_first_load_that_fails_leaves_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(PySparkException):
        versions.publish(failing(spark), path)
    assert not versions.is_versioned(spark, path) and not glob.glob(f"{path}/v-*")


def test_readers_hold_on_to_their_version(spark, tmp_path):
    path = str(tmp_path / "t")
    held = versions.publish(numbers(spark, 10), path)
    versions.publish(versions.read_version(spark, path).filter("k = 0"), path)  # made from the table itself
    assert (held.count(), versions.read_version(spark, path).count(), versions.read_version(spark, path, 1).count()) == (10, 4, 10)
    versions.publish(numbers(spark, 5), path)
    assert versions.read_version(spark, path).count() == 5 and len(glob.glob(f"{path}/v-*")) == versions.KEPT
    with pytest.raises(ValueError):
        versions.read_version(spark, path, 1)


def test_of_two_updates_of_one_version_one_is_committed(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.publish(numbers(spark, 10), path)
    seen = versions.committed(spark, path)
    versions.publish(numbers(spark, 20), path, after=seen)
    with pytest.raises(versions.Conflict):
        versions.publish(numbers(spark, 30), path, after=seen)
    assert versions.read_version(spark, path).count() == 20
    versions.publish(numbers(spark, 40), path)
    assert tables.read_table(spark, str(tmp_path), "t").count() == 40


def test_several_tables_by_one_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.publish_together({"a": numbers(spark, 3), "b": numbers(spark, 4)}, path)
    with pytest.raises(PySparkException):
        versions.publish_together({"a": numbers(spark, 9), "b": failing(spark)}, path)
    assert {n: df.count() for n, df in versions.read_together(spark, path).items()} == {"a": 3, "b": 4}
    assert versions.read_together(spark, str(tmp_path / "none")) == {}


def same(left, right) -> bool:
    return sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


def test_marts_from_batches_equal_the_build(spark, incidents, tmp_path):
    path, rows = str(tmp_path / "cells"), tables.stage(incidents)
    hot = rows.filter("severity >= 3")
    parts = [rows.filter(F.pmod(F.xxhash64("accident_id"), F.lit(3)) == i) for i in range(3)]
    for batch, part in enumerate([parts[0], parts[1], parts[1].limit(0), parts[2]]):
        assert marts.add_batch(part, batch, path)
        assert not marts.add_batch(part, batch, path)  # sent again
    assert marts.add_batch(hot, 0, path, source="other")  # numbers of another source are its own
    whole = rows.unionByName(hot)
    year = 2001
    built = {
        "mart_temporal": models.mart_temporal(models.int_temporal(whole, year)),
        "mart_geo": models.mart_geo(models.int_geo_hotspots(models.city_sums(whole))),
        "mart_weather_poi": models.mart_weather_poi(models.int_weather_poi(whole)),
        "mart_funnel": models.mart_funnel(models.int_funnel(whole, year)),
    }
    for name, mart in built.items():
        assert same(marts.read_mart(spark, path, name, year), mart), name


def test_a_batch_that_fails_is_not_counted(spark, incidents, tmp_path):
    path, rows = str(tmp_path / "cells"), tables.stage(incidents)
    assert marts.add_batch(rows, 0, path, marts=["mart_funnel"])
    before = marts.read_mart(spark, path, "mart_funnel").collect()
    broken = rows.withColumn("severity", F.when(F.col("accident_id") % 7 == 3, F.raise_error(F.lit("stopped")).cast("int")).otherwise(F.col("severity")))
    with pytest.raises(PySparkException):
        marts.add_batch(broken, 1, path, marts=["mart_funnel"])
    assert marts.read_mart(spark, path, "mart_funnel").collect() == before
    assert marts.add_batch(rows, 1, path, marts=["mart_funnel"])
    total = marts.read_mart(spark, path, "mart_funnel").filter("funnel_dimension = 'overall'").collect()[0]["total"]
    assert total == 2 * rows.count()


def test_cells_do_not_grow_with_batches(spark, incidents, tmp_path):
    path, rows = str(tmp_path / "cells"), tables.stage(incidents)
    sizes = []
    for batch in range(3):
        marts.add_batch(rows, batch, path, marts=["mart_temporal"])
        sizes.append(versions.read_together(spark, path)["mart_temporal"].count())
    assert len(set(sizes)) == 1
