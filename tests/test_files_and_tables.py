"""Raw files, typed tables, checks, exports and arrivals."""

from __future__ import annotations

import csv
import glob
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from roadlens.operators import quality
from roadlens.plans import cleaning
from roadlens.plans.build import build, check, load_raw_file
from roadlens.plans.contract import CONTRACT
from roadlens.sources import delimited, reports, tables
from roadlens.sources.schema import DROPPED, KEPT, MAX_LENGTH, RAW_FLAGS, RENAME, TABLE_COLUMNS
from roadlens.streaming.arrivals import clean_arrivals

GOOD = {
    "ID": "A-1", "Source": "Source2", "Severity": "3", "Start_Time": "2016-02-08 05:46:00", "End_Time": "2016-02-08 11:00:00.000000000",
    "Start_Lat": "39.865147", "Start_Lng": "-84.058723", "Distance(mi)": "0.01", "Description": 'Right lane "blocked", at Exit 41',
    "Street": "I-70 E", "City": "Dayton", "County": "Montgomery", "State": "OH", "Zipcode": "02134-1234", "Timezone": "US/Eastern",
    "Airport_Code": "KFFO", "Weather_Timestamp": "2016-02-08 05:58:00", "Temperature(F)": "36.9", "Humidity(%)": "91.0",
    "Pressure(in)": "29.68", "Visibility(mi)": "10.0", "Wind_Direction": "Calm", "Wind_Speed(mph)": "3.5", "Precipitation(in)": "",
    "Weather_Condition": "Light Rain", **{f: "False" for f in RAW_FLAGS}, "Sunrise_Sunset": "Night", "Civil_Twilight": "Night",
    "Nautical_Twilight": "Night", "Astronomical_Twilight": "Day", "End_Lat": "", "End_Lng": "", "Country": "US", "Wind_Chill(F)": "",
}


def write_raw(folder, rows, name="raw.csv"):
    folder.mkdir(exist_ok=True)
    columns = list(GOOD)
    with open(folder / name, "w", newline="") as f:
        writer = csv.DictWriter(f, columns)
        writer.writeheader()
        writer.writerows([{**GOOD, **row} for row in rows])
    return str(folder)


CASES = [
    {},
    {"ID": "A-2", "Wind_Speed(mph)": "NA"},          # missing: dropped
    {"ID": "A-3", "Start_Time": "soon"},             # unreadable: dropped
    {"ID": "A-4", "Zipcode": ""},                    # missing: dropped unless exempt
    {"ID": "A-5", "Precipitation(in)": "0.12", "Junction": "True", "Description": "Accident at Exit 3"},
    {"ID": "A-6", "Temperature(F)": "NaN"},          # not a number: dropped
]


def test_column_lists():
    assert len(RENAME) == 51 and len(KEPT) == 42 and sorted(RENAME.values()) == sorted(TABLE_COLUMNS)
    assert not set(DROPPED) & set(RENAME)


def test_clean_from_file(spark, tmp_path):
    raw = delimited.read_raw(spark, write_raw(tmp_path / "raw", CASES))
    rows = {r.ID: r for r in cleaning.clean(raw).collect()}
    assert sorted(rows) == [1, 5]
    one = rows[1]
    assert one.Zipcode == "02134" and one.Timezone == "Eastern" and one["Precipitation(in)"] == 0.0
    assert one.Start_Time == datetime(2016, 2, 8, 5, 46) and one.duration_mins == Decimal("314.00")
    assert one.Description == 'Right lane "blocked", at Exit 41' and one.incident_context == "lane_closure"
    assert (one.temp_bucket, one.visibility_bucket, one.light_condition_category) == ("Cold", "Clear", "Dawn_Dusk_Transition")
    assert (one.hour_of_day, one.day_of_week, one.is_weekend, one.is_rush_hour) == (5, "Monday", False, False)
    assert rows[5].incident_context == "location_highway_exit" and rows[5].Junction is True
    assert cleaning.clean(raw).columns == list(RENAME)


def test_null_rule_as_stated_and_as_observed(spark, tmp_path):
    raw = delimited.read_raw(spark, write_raw(tmp_path / "raw", CASES))
    assert cleaning.clean_totals(raw).collect()[0][:] == (6, 4, 2, Decimal("66.667"))
    observed = cleaning.clean(raw, cleaning.OBSERVED_EXEMPT)
    assert sorted(r.ID for r in observed.collect()) == [1, 4, 5]
    assert cleaning.clean_totals(raw, cleaning.OBSERVED_EXEMPT).collect()[0].rows_kept == 3


def test_totals_are_counted_while_loading(spark, tmp_path):
    totals = Observation("totals")
    loaded = load_raw_file(spark, write_raw(tmp_path / "raw", CASES), str(tmp_path / "root"), totals=totals)
    assert loaded.count() == 2
    assert totals.get == {"rows_seen": 6, "rows_unreadable": 0, "rows_dropped": 4, "rows_kept": 2}


def test_rows_in_order_of_arrival(spark, tmp_path):
    clean = cleaning.clean(delimited.read_raw(spark, write_raw(tmp_path / "raw", CASES)))
    loaded = tables.load_table(clean, str(tmp_path / "table"), order_by=())
    assert sorted(r.id for r in loaded.collect()) == [1, 2]


def test_layout_cuts_a_hot_state_over_many_files(spark, tmp_path):
    rows = spark.range(4000).selectExpr(
        "id", "timestamp_ntz'2020-05-01 00:00:00' AS start_time", "'CA' AS state", "2 AS severity")
    tables.write_layout(rows, str(tmp_path / "layout"), files=4)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "layout")).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000


def test_totals_of_nothing(spark, tmp_path):
    raw = delimited.read_raw(spark, write_raw(tmp_path / "raw", []))
    assert cleaning.clean_totals(raw).collect()[0][:] == (0, 0, 0, Decimal("0.000"))


def test_clean_file_round_trip(spark, tmp_path):
    clean = cleaning.clean(delimited.read_raw(spark, write_raw(tmp_path / "raw", CASES)))
    delimited.write_clean(clean, str(tmp_path / "clean"))
    back = delimited.read_clean(spark, str(tmp_path / "clean"))
    assert {r.Zipcode for r in back.collect()} == {"02134"}
    again, first = (tables.typed(tables.rename_columns(df)).collect() for df in (back, clean))
    assert sorted(again) == sorted(first) and len(first) == 2


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = write_raw(tmp_path / "raw", [{"Description": "two\nlines"}])
    raw = delimited.read_raw(spark, path)
    assert raw.collect()[0].Description == "two\nlines"
    delimited.write_clean(cleaning.clean(raw), str(tmp_path / "clean"))
    assert delimited.read_clean(spark, str(tmp_path / "clean")).collect()[0].Description == "two\nlines"
    split = cleaning.reading_totals(delimited.read_raw(spark, path, multi_line=False)).collect()[0]
    assert split.rows_kept == 0 and split.rows_unreadable > 0


def test_unreadable_fields_are_no_missing_values(spark, tmp_path):
    bad = [{"ID": "A-7", "Temperature(F)": "hot"}, {"ID": "A-8", "Junction": "maybe"}, {"ID": "A-9", "Weather_Timestamp": "noon"}]
    path = write_raw(tmp_path / "raw", CASES + bad)
    with open(f"{path}/raw.csv", "a") as f:
        f.write("A-10,too,few\n")
    raw = delimited.read_raw(spark, path)
    assert cleaning.reading_totals(raw).collect()[0][:4] == (10, 4, 4, 2)
    assert sorted(r.ID for r in cleaning.rejected(raw).collect()) == ["A-10", "A-7", "A-8", "A-9"]
    assert sorted(r.ID for r in cleaning.clean(raw).collect()) == [1, 5]


def test_columns_are_found_by_name(spark, tmp_path):
    path = write_raw(tmp_path / "raw", [{"ID": "A-1"}])
    swapped = [{"City": "County", "County": "City"}.get(c, c) for c in GOOD]
    with open(f"{path}/swapped.csv", "w", newline="") as f:
        writer = csv.DictWriter(f, swapped)
        writer.writeheader()
        writer.writerow({**GOOD, "ID": "A-2"})
    rows = cleaning.clean(delimited.read_raw(spark, path)).collect()
    assert {(r.ID, r.City, r.County) for r in rows} == {(1, "Dayton", "Montgomery"), (2, "Dayton", "Montgomery")}
    with pytest.raises(Exception, match="header does not conform"):
        delimited.read_raw(spark, path, columns=list(GOOD)).collect()
    query = clean_arrivals(spark, path, list(GOOD), str(tmp_path / "out"), str(tmp_path / "done"))
    with pytest.raises(PySparkException):
        query.awaitTermination()
    assert not glob.glob(str(tmp_path / "out" / "*.parquet"))


def test_required_columns(spark, tmp_path):
    clean = cleaning.clean(delimited.read_raw(spark, write_raw(tmp_path / "raw", CASES)))
    rows = tables.typed(tables.rename_columns(clean)).withColumn("severity", F.lit(None).cast("int"))
    with pytest.raises(PySparkException, match="severity"):
        tables.require(rows).collect()


def test_values_that_do_not_fit_are_errors(spark, tmp_path):
    raw = delimited.read_raw(spark, write_raw(tmp_path / "raw", [{"Temperature(F)": "123456.7"}]))
    with pytest.raises(PySparkException):
        tables.typed(tables.rename_columns(cleaning.clean(raw))).collect()


def test_arrivals_are_cleaned_once(spark, tmp_path):
    folder = write_raw(tmp_path / "in", CASES[:2], "a.csv")
    out, done = str(tmp_path / "out"), str(tmp_path / "done")
    columns = delimited.header_of(spark, folder)
    clean_arrivals(spark, folder, columns, out, done).awaitTermination()
    assert [r.ID for r in spark.read.parquet(out).collect()] == [1]
    write_raw(tmp_path / "in", CASES[4:], "b.csv")
    clean_arrivals(spark, folder, columns, out, done).awaitTermination()
    assert sorted(r.ID for r in spark.read.parquet(out).collect()) == [1, 5]



def test_arrivals_are_read_in_splits(spark, tmp_path):
    """A large arrived file is cut over tasks like any other read, and gives the rows of the batch reader."""
    rows = [{"ID": f"A-{i}", "Description": f'lane "{i}",\nblocked'} for i in range(1, 400)]
    folder = write_raw(tmp_path / "in", rows)
    out, done = str(tmp_path / "out"), str(tmp_path / "done")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        clean_arrivals(spark, folder, delimited.header_of(spark, folder), out, done).awaitTermination()
        expected = cleaning.clean(delimited.read_raw(spark, folder)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = spark.read.parquet(out).drop("batch").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected)) and len(got) == 399
    # one file of the sink per task: the file was not read by one
    assert len(glob.glob(f"{out}/**/*.parquet", recursive=True)) > 1

def test_contract_has_85_checks():
    kinds = {"not_null": 0, "unique": 0, "accepted": 0, "relationships": 0}
    for rules in CONTRACT.values():
        for kind, columns in rules.items():
            kinds[kind] += len(columns)
    assert kinds == {"not_null": 65, "unique": 7, "accepted": 9, "relationships": 4}


def test_build_and_contract(spark, tmp_path):
    rows = [{"ID": f"A-{i}", "Severity": str(1 + i % 4), "State": ["OH", "CA"][i % 2], "Start_Time": f"20{16 + i % 8}-0{1 + i % 9}-08 0{i % 10}:46:00",
             "End_Time": f"20{16 + i % 8}-0{1 + i % 9}-08 23:46:00", "City": f"C{i % 7}"} for i in range(60)]
    incidents = load_raw_file(spark, write_raw(tmp_path / "raw", rows), str(tmp_path / "root"))
    assert sorted(r.id for r in incidents.collect()) == list(range(1, 61))
    made = build(incidents, str(tmp_path / "root"), export=True)
    results = check(made)
    assert results.count() == 85 and results.filter("failures > 0").isEmpty()
    assert {tuple(r) for r in quality.summarise(results).collect()} == {
        ("not_null", 65, 65, 0), ("unique", 7, 7, 0), ("accepted_values", 9, 9, 0), ("relationships", 4, 4, 0)}
    assert made["fact"].count() == 60
    years = {r.period_date.year for r in made["mart_temporal"].filter("granularity = 'yearly'").collect()}
    assert years == set(range(2016, 2023))
    assert any(r.period_date.year == 2023 for r in made["mart_temporal"].filter("granularity = 'monthly'").collect())
    (export,) = glob.glob(str(tmp_path / "root/export/mart_temporal/*.csv"))
    lines = open(export).read().splitlines()
    assert lines[0].startswith("granularity,period_date,accident_count") and len(lines) == made["mart_temporal"].count() + 1


def test_failing_checks_are_counted(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "zz"), (9, "a")], "k int, v string")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    got = quality.check_rows(child, "t", ["k", "v"], {"v": ["a", "b"]}, {"v": 1}).collect()
    assert [(r.column_name, r.check, r.failures) for r in got] == [
        ("k", "not_null", 1), ("v", "not_null", 1), ("v", "accepted_values", 1), ("v", "max_length", 1)]
    assert quality.check_unique(child, "t", ["k"]).collect()[0].failures == 1
    assert [tuple(r) for r in quality.duplicates(child, ["k"]).collect()] == [(1, 2)]
    assert quality.check_relationship(child, "t", "k", parent, "k").collect()[0].failures == 1
    assert [r.v for r in quality.violating_rows(child, "v", ["a", "b"]).collect()] == ["zz"]
    assert [r.k for r in quality.violating_rows(child, "v").collect()] == [2]


def test_lengths_of_the_table(incidents):
    got = quality.check_rows(incidents, "incidents", max_length=MAX_LENGTH)
    assert got.count() == len(MAX_LENGTH) and got.filter("failures > 0").isEmpty()


def test_report(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "column_name string, missing_count int")
    reports.write_report(df, str(tmp_path / "report"), "somewhere")
    row = spark.read.json(str(tmp_path / "report")).collect()[0]
    assert row.source_file == "somewhere" and row.column_name == "a" and row.generated_at


def test_first_rows(incidents):
    assert delimited.head(incidents, 5).count() == 5
