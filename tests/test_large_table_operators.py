"""Operators that avoid one task for everything, against plain ways on small skewed data."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from roadlens.operators import joins, maps, profile
from roadlens.operators.ordering import number_by_key, number_rows
from roadlens.operators.windows import ranks_by_value, top_ranked
from roadlens.session import discard, settle, shared_folder


def skewed(n=3000, seed=1):
    """A third of the rows share one key; some keys are NULL."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.34 else None if rng.random() < 0.05 else f"k{rng.randrange(200)}"
        rows.append((i, key, rng.choice(["A", "B", None]), rng.randrange(12), rng.random() * 100))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return settle(spark.createDataFrame(skewed(), "id bigint, k string, g string, n int, x double"))


def test_settled_tables_lie_in_the_shared_folder(spark, table):
    folder = shared_folder(spark)
    assert table.inputFiles() and all(folder in f for f in table.inputFiles())


@pytest.mark.parametrize("kind", ["rank", "dense_rank"])
@pytest.mark.parametrize("within", [(), ("g",)])
def test_ranks_by_value_equal_the_window(table, kind, within):
    got = ranks_by_value(table.select("id", "g", "n"), {"r": ("n", kind, within)})
    w = Window.partitionBy(*within).orderBy(F.desc_nulls_first("n"))
    want = table.select("id", "g", "n", {"rank": F.rank, "dense_rank": F.dense_rank}[kind]().over(w).cast("bigint").alias("r"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_top_ranked_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 4), (4, 4), (5, 1)], "id int, n int")
    assert {r.id for r in top_ranked(df, "n", 3, "r").collect()} == {1, 2, 3, 4}


@pytest.mark.parametrize("ranges", [1, 7])
def test_numbers_are_contiguous_and_in_order(table, ranges):
    got = sorted((r.no, r.k or "") for r in number_rows(table, [F.col("k").asc_nulls_first()], "no", ranges).collect())
    assert [no for no, _ in got] == list(range(1, table.count() + 1))
    assert [k for _, k in got] == sorted(k for _, k in got)


def test_quantiles_equal_numpy(table):
    columns = ["x", "n"]
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(r.column_name, r.p): r.value for r in profile.exact_quantiles(table, columns, probabilities).collect()}
    rows = table.collect()
    for c in columns:
        data = np.array([getattr(r, c) for r in rows], dtype=float)
        for p in probabilities:
            assert got[(c, p)] == pytest.approx(np.percentile(data, p * 100), abs=1e-9)


def test_numeric_summary_of_hand_rows(spark):
    df = spark.createDataFrame([(1,), (2,), (4,), (9,), (None,)], "v int")
    row = profile.numeric_summary(df, ["v"]).collect()[0]
    assert (row["count"], row.min, row.max, row["mean"], row.median, row.std, row.q1_25pct, row.q3_75pct) == (
        4, 1, 9, 4, 3, 3.082, 1.75, 5.25)
    near = profile.numeric_summary(df, ["v"], exact=False).collect()[0]
    assert near["count"] == 4 and near.q1_25pct in (1, 2)


def test_summary_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "v int")
    row = profile.numeric_summary(df, ["v"]).collect()[0]
    assert row["count"] == 0 and row.median is None


def test_star_join_keeps_fact_rows_without_a_match(spark, table):
    dim = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(20)], "k string, attribute int")
    joined = joins.star_join(table, {"k": dim})
    known = dict(dim.collect())
    assert sorted((r.id, r.attribute or 0) for r in joined.collect()) == sorted(
        (r.id, known.get(r.k) or 0) for r in table.collect())
    assert joins.unmatched(joined, {"k": "attribute"}).collect()[0].k == sum(r.k not in known for r in table.collect())


def test_positions_by_key(spark):
    for keys in (range(500, 2500), [*range(1000), *[5000] * 700, 10**9], [7] * 300, [-5, None, 3, None]):
        rows = settle(spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(5))
        got = number_by_key(rows, "k", "no", 4).collect()
        assert sorted(r.no for r in got) == list(range(1, len(got) + 1))
        ordered = [r.k for r in sorted(got, key=lambda r: r.no)]
        assert ordered == sorted(keys, key=lambda k: (k is not None, k or 0))
        discard(rows)


@pytest.mark.parametrize("n", [1, 50, 3000, 5000])
def test_sample_has_the_smallest_hashes(table, n):
    got = [r.id for r in maps.sample_rows(table.select("id"), n, seed=3).collect()]
    ids = sorted(range(3000), key=lambda i: hashlib.md5(f"3|{i}".encode()).hexdigest())
    assert sorted(got) == sorted(ids[:n])


def test_samples_differ_by_seed(table):
    first, second = ({r.id for r in maps.sample_rows(table, 100, seed=s).collect()} for s in (1, 2))
    assert first != second


def test_frequencies_fold_the_tail(spark):
    rows = [(f"v{i:02d}", "w" + str(i % 20)) for i in range(21) for _ in range(30 - i)]
    got = profile.value_frequencies(spark.createDataFrame(rows, "a string, b string"), ["a", "b"]).collect()
    a = sorted((r for r in got if r.column_name == "a"), key=lambda r: r.place)
    b = [r for r in got if r.column_name == "b"]
    assert len(a) == 16 and a[-1].value == profile.OTHER and a[0].value == "v00" and a[0].truncated_to_top_n
    assert sum(r["count"] for r in a) == len(rows) and a[-1]["count"] == sum(30 - i for i in range(15, 21))
    assert len(b) == 20 and not b[0].truncated_to_top_n


def test_classification_at_the_limit(spark):
    df = spark.range(1000).select(
        (F.col("id") % 25).alias("few"), (F.col("id") % 26).alias("many"), F.col("id").cast("string").alias("label"),
        (F.col("id") % 2 == 0).alias("flag"),
    )
    assert profile.classify_columns(df, skip=()) == {"few": "categorical", "many": "numeric", "label": "categorical", "flag": "categorical"}


def test_lookup_pieces_follow_the_input(spark):
    from workload.registry import lookup_spread

    rows = spark.range(0, 4000, 1, 24)
    spread = lookup_spread(rows)
    assert spread.rdd.getNumPartitions() >= 24
    assert sorted(r.id for r in spread.collect()) == list(range(4000))
