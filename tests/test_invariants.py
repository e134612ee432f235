"""Relations that hold on any data."""

from __future__ import annotations

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from roadlens.operators import aggregate as agg
from roadlens.plans import star
from roadlens.sources.tables import stage

ROWS = st.lists(st.tuples(st.sampled_from("abc"), st.integers(1, 4)), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None)
@given(ROWS)
def test_funnel_narrows(spark, rows):
    for r in agg.funnel(spark.createDataFrame(rows, "g string, severity int"), ["g"]).collect():
        assert r.total >= r.sev_2_plus >= r.sev_3_plus >= r.critical >= 0
        assert r.pct_sev_2_plus >= r.pct_sev_3_plus >= r.critical_rate_pct


@settings(max_examples=8, deadline=None)
@given(ROWS)
def test_shares_add_up(spark, rows):
    got = agg.distribution(spark.createDataFrame(rows, "g string, severity int"), "g").collect()
    assert abs(sum(r.pct_of_total for r in got) - 100) <= Decimal("0.01") * len(got)
    assert sum(r.accident_count for r in got) == len(rows)


def test_dimension_keys_are_unique_and_cover_the_fact(incidents):
    staged = stage(incidents)
    fact = star.fact(staged)
    for key, make in star.DIMENSIONS.items():
        dim = make(staged)
        assert dim.count() == dim.select(key).distinct().count()
        assert fact.join(dim, key, "left_anti").isEmpty()
