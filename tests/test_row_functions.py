"""Row-local functions on rows written by hand."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadlens.functions import buckets, calendar, geo, keys, text
from roadlens.functions.numbers import mean, percent, ratio
from roadlens.functions.predicates import build_predicate


def values(spark, rows, schema, column):
    if not isinstance(rows[0], tuple):
        rows = [(r,) for r in rows]
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_strings(spark):
    assert values(spark, ["A-1", "A-7728394", "x", None], "v string", text.strip_id_prefix(F.col("v"))) == [
        1, 7728394, None, None]
    assert values(spark, ["78701-1234", "02134"], "v string", text.zip_base(F.col("v"))) == ["78701", "02134"]
    assert values(spark, ["US/Eastern", "Central"], "v string", text.strip_zone_prefix(F.col("v"))) == ["Eastern", "Central"]


def test_parse_wall_clock(spark):
    got = values(
        spark,
        ["2016-02-08 05:46:00", "2016-02-08 05:46:00.000000000", "2016-02-08 05:46:00.9", "garbage", "2016-13-01 00:00:00", None],
        "v string", calendar.parse_wall_clock(F.col("v")),
    )
    t = datetime(2016, 2, 8, 5, 46)
    assert got == [t, t, t, None, None, None]


def test_wall_clock_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = values(spark, ["2016-03-13 02:30:00"], "v string", calendar.parse_wall_clock(F.col("v")))
        months = values(spark, ["2016-03-13 02:30:00"], "v string", calendar.month_start(calendar.parse_wall_clock(F.col("v"))))
        hours = values(spark, ["2016-03-13 02:30:00"], "v string", F.hour(calendar.parse_wall_clock(F.col("v"))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [datetime(2016, 3, 13, 2, 30)]
    assert str(months[0]) == "2016-03-01" and hours == [2]


@pytest.mark.parametrize(
    "start,end,minutes",
    [("07:00:00", "07:00:07", "0.12"), ("07:00:00", "06:59:00", "-1.00"), ("07:00:00", "08:30:00", "90.00")],
)
def test_minutes_between(spark, start, end, minutes):
    a, b = (F.col(c).cast("timestamp_ntz") for c in ("a", "b"))
    got = values(spark, [(f"2020-01-01 {start}", f"2020-01-01 {end}")], "a string, b string", calendar.minutes_between(a, b))
    assert got == [Decimal(minutes)]


def test_temperature_edges(spark):
    got = values(spark, [32.0, 32.1, 50.0, 70.0, 90.0, 90.1, None, float("nan")], "v double", buckets.temperature_bucket(F.col("v")))
    assert got == ["Freezing", "Cold", "Cold", "Mild", "Warm", "Hot", None, None]


def test_visibility_edges(spark):
    got = values(spark, [1.0, 1.1, 5.0, 5.1], "v double", buckets.visibility_bucket(F.col("v")))
    assert got == ["Low", "Moderate", "Moderate", "Clear"]


def test_rush_hours_of_cleaning_and_dimension_differ_at_nine(spark):
    hours = [6, 7, 9, 10, 15, 16, 18, 19]
    assert values(spark, hours, "v int", calendar.in_hour_ranges(F.col("v"))) == [
        False, True, True, False, False, True, True, False]
    assert values(spark, hours, "v int", F.col("v").isin(*calendar.DIMENSION_RUSH_HOURS)) == [
        False, True, False, False, False, True, True, False]


def test_weekend_and_day_names(spark):
    days = [datetime(2020, 3, d) for d in (7, 8, 9)]
    ts = F.col("v").cast("timestamp_ntz")
    assert values(spark, days, "v timestamp_ntz", calendar.is_weekend(ts)) == [True, True, False]
    assert values(spark, days, "v timestamp_ntz", calendar.day_name(ts)) == ["Saturday", "Sunday", "Monday"]
    assert values(spark, days, "v timestamp_ntz", calendar.day_name(ts, pad=True)) == ["Saturday ", "Sunday   ", "Monday   "]


def test_lockdown(spark):
    days = [datetime(2020, 2, 29, 23), datetime(2020, 3, 1), datetime(2020, 6, 30, 23), datetime(2020, 7, 1), datetime(2021, 4, 1)]
    got = values(spark, days, "v timestamp_ntz", calendar.in_period(F.col("v"), *calendar.LOCKDOWN))
    assert got == [False, True, True, False, False]


def test_light_condition(spark):
    rows = [tuple("DDDD"), tuple("NNNN"), tuple("NDDD")]
    rows = [tuple({"D": "Day", "N": "Night"}[c] for c in r) for r in rows]
    got = values(spark, rows, "a string, b string, c string, d string", buckets.light_condition([F.col(c) for c in "abcd"]))
    assert got == list(buckets.LIGHT)


CONTEXTS = [
    ("Right lane blocked, road closed", False, False, False, "road_closure"),
    ("Right lane blocked", False, False, False, "lane_closure"),
    ("RIGHT SHOULDER", False, False, False, "shoulder_blocked"),
    ("Overturned truck", False, False, False, "vehicle_type"),
    ("5-vehicle crash", False, False, False, "multi_vehicle"),
    ("Accident on I-75 at Exit 21", True, True, True, "location_highway_exit"),
    ("Exited", True, False, True, "location_junction"),
    ("Accident on I-75 at Exit 21", False, True, True, "location_crossing"),
    ("Accident", False, False, True, "location_signalized_intersection"),
    ("Accident on I-75 at Exit 21", False, False, False, "other"),
    ("Accident", None, None, None, "other"),
    (None, True, False, False, "location_junction"),
]


def test_contexts(spark):
    df = spark.createDataFrame(CONTEXTS, "t string, j boolean, c boolean, s boolean, want string")
    got = text.classify(df, "t", "label", fallback=text.location_fallback("j", "c", "s")).collect()
    assert [(r.t, r.label) for r in got] == [(r.t, r.want) for r in got]


def test_compound_flags(spark):
    rows = [(True, True), (True, False), (False, True), (False, False), (None, True)]
    got = values(spark, rows, "a boolean, b boolean", buckets.compound_flags(F.col("a"), F.col("b"), "junction", "signal"))
    assert got == ["junction + signal", "junction only", "signal only", "neither", "neither"]


def test_keys(spark):
    df = spark.createDataFrame([("a", None, True), (None, "b", None)], "x string, y string, f boolean")
    row = df.select(
        keys.text_key(["x", "y"]).alias("k"), F.md5(F.lit("a|null")).alias("want"), keys.text_key(["x", "f"], null_as=None).alias("strict")
    ).collect()
    assert row[0].k == row[0].want and row[0].strict is not None
    assert row[1].strict is None


@pytest.mark.parametrize(
    "minutes,kept", [((0, 1440), [-5, 0, 60, 2000]), ((0, 60), [0, 60]), (None, [-5, 0, 60, 2000])]
)
def test_duration_filter(spark, minutes, kept):
    df = spark.createDataFrame([(v,) for v in (-5, 0, 60, 2000)], "duration_mins int")
    assert [r[0] for r in df.filter(build_predicate({"duration_range": minutes})).collect()] == kept


def test_unknown_filter_is_refused():
    with pytest.raises(ValueError, match="unknown"):
        build_predicate({"state": ["CA"]})


def test_year_filter_is_inclusive(spark):
    days = [datetime(2015, 12, 31, 23, 59, 59), datetime(2016, 1, 1), datetime(2017, 12, 31, 23, 59, 59), datetime(2018, 1, 1)]
    got = values(spark, days, "start_time timestamp_ntz", build_predicate({"year_range": (2016, 2017)}))
    assert got == [False, True, True, False]


def test_ratio_rounds_exactly(spark):
    rows = [(201, 20000), (-201, 20000), (1, 3), (1, 0), (None, 4)]
    got = values(spark, rows, "n bigint, d bigint", percent(F.col("n"), F.col("d")))
    assert got == [Decimal("1.01"), Decimal("-1.01"), Decimal("33.33"), None, None]
    assert values(spark, [(5, 2)], "n bigint, d bigint", ratio(F.col("n"), F.col("d"), 0)) == [Decimal(3)]


def test_mean_over_trusted_rows_only(spark):
    df = spark.createDataFrame([(Decimal(v),) for v in (-5, 0, 10, 1440, 2000)], "duration_mins decimal(10,2)")
    from roadlens.operators.aggregate import avg_duration, incidents

    assert df.agg(avg_duration(), incidents()).collect()[0][:] == (Decimal("10.00"), 5)
    assert df.agg(mean(F.col("duration_mins"), 2, scale=2)).collect()[0][0] == Decimal("689.00")


def test_hexagons_contain_their_points(spark):
    points = [(30.0 + i * 0.037, -120.0 + i * 0.053) for i in range(200)]
    df = spark.createDataFrame(points, "lat double, lng double")
    q, r = geo.hex_cell(F.col("lat"), F.col("lng"), 8000.0)
    cells = df.select("lat", "lng", q.alias("q"), r.alias("r"))
    clat, clng = geo.hex_centre(F.col("q"), F.col("r"), 8000.0)
    east, north = geo.metres_per_degree()
    for row in cells.select("lat", "lng", clat.alias("clat"), clng.alias("clng")).collect():
        distance = (((row.lat - row.clat) * north) ** 2 + ((row.lng - row.clng) * east) ** 2) ** 0.5
        assert distance <= 8000.0 + 1e-6


def test_colours(spark):
    got = values(spark, [1, 4, 9], "v int", geo.severity_colour(F.col("v")))
    assert got == [[0, 200, 100, 180], [220, 30, 30, 220], [150, 150, 150, 180]]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-100, 200, allow_nan=False), min_size=1, max_size=30))
def test_every_number_falls_between_its_edges(spark, numbers):
    edges, labels = buckets.TEMPERATURE
    got = values(spark, numbers, "v double", buckets.temperature_bucket(F.col("v")))
    bounds = [float("-inf"), *edges, float("inf")]
    for number, label in zip(numbers, got, strict=True):
        i = labels.index(label)
        assert bounds[i] < number <= bounds[i + 1]
