"""Second-stage operators on published counts: the derived figures must come out the same."""

from __future__ import annotations

from datetime import date
from decimal import Decimal as D

from pyspark.sql import functions as F

from roadlens.functions.numbers import percent
from roadlens.operators import aggregate as agg
from roadlens.operators import windows as win


def test_month_over_month_and_running_total(spark):
    rows = [(date(2016, 1, 1), 7), (date(2016, 2, 1), 903), (date(2016, 3, 1), 5298), (date(2016, 4, 1), 14904)]
    w = win.order_window("m")
    got = spark.createDataFrame(rows, "m date, n bigint").select(
        "n", win.previous("n", w).alias("prev"), win.percent_change("n", w).alias("pct"), win.running_total("n", w).alias("run")
    ).collect()
    assert [tuple(r) for r in got] == [
        (7, None, None, 7), (903, 7, D("12800.00"), 910), (5298, 903, D("486.71"), 6208), (14904, 5298, D("181.31"), 21112)]


def test_year_over_year(spark):
    rows = [(2016, 328560), (2017, 576416), (2018, 716816)]
    w = win.order_window("y")
    got = spark.createDataFrame(rows, "y int, n bigint").select(win.percent_change("n", w)).collect()
    assert [r[0] for r in got] == [None, D("75.44"), D("24.36")]


def test_rank_leaves_a_gap_after_a_tie(spark):
    rows = [("a", 2.216), ("b", 2.211), ("c", 2.208), ("d", 2.211)]
    df = spark.createDataFrame(rows, "h string, v double")
    got = {r.h: (r.r, r.dr) for r in df.select("h", win.rank("v").alias("r"), win.rank("v", "dense_rank").alias("dr")).collect()}
    assert got == {"a": (1, 1), "b": (2, 2), "d": (2, 2), "c": (4, 3)}


FUNNEL = [
    ("Full_Night", 1188379, 1183852, 195084, 48121, "99.62", "16.42", "4.05", 1),
    ("Dawn_Dusk_Transition", 945168, 937864, 179748, 23012, "99.23", "19.02", "2.43", 2),
    ("Full_Day", 4918009, 4864789, 940171, 107405, "98.92", "19.12", "2.18", 3),
]


def test_funnel_rates_and_rank(spark):
    df = spark.createDataFrame([r[:5] for r in FUNNEL], "light string, total bigint, sev_2_plus bigint, sev_3_plus bigint, critical bigint")
    got = agg.with_funnel_rates(df).withColumn("place", win.rank("critical_rate_pct")).collect()
    assert {tuple(r) for r in got} == {(*r[:5], *map(D, r[5:8]), r[8]) for r in FUNNEL}


def test_cohort_sees_the_next_rate(spark):
    rows = [("2016-01", 7, 7), ("2016-02", 123, 903), ("2016-03", 287, 5298)]
    df = spark.createDataFrame(rows, "m string, c bigint, n bigint").withColumn("rate", percent(F.col("c"), F.col("n")))
    got = df.withColumn("next", win.following("rate", win.order_window("m"))).select("rate", "next").collect()
    assert [tuple(r) for r in got] == [(D("100.00"), D("13.62")), (D("13.62"), D("5.42")), (D("5.42"), None)]


def test_shares(spark):
    rows = [("Dawn_Dusk_Transition", 945168), ("Full_Day", 4918009), ("Full_Night", 1188379)]
    got = spark.createDataFrame(rows, "k string, accident_count bigint").select("k", agg.share_of_total().alias("p")).collect()
    assert {r.k: r.p for r in got} == {"Dawn_Dusk_Transition": D("13.40"), "Full_Day": D("69.74"), "Full_Night": D("16.85")}


def test_divergence(spark):
    df = spark.createDataFrame([("CA", 1, 36), ("FL", 2, 38), ("TX", 3, 29)], "s string, v bigint, r bigint")
    assert [r[0] for r in df.select(win.divergence("v", "r")).collect()] == [35, 36, 26]
