"""Star joins on bucketed tables: a bucket follows the table's size, and the join is the plain one."""

from __future__ import annotations

import re

from roadlens.plans import star
from roadlens.sources import tables
from workload.registry import BY_LOCATION, star_by


def test_buckets_follow_the_partitions_read(spark, incidents):
    s = tables.stage(incidents).repartition(16)
    got = star_by("location_id", BY_LOCATION)(s)
    plan = got._jdf.queryExecution().executedPlan().toString()
    saved = set(re.findall(r"(?:fact|dim)_[0-9a-f]{32}", plan))
    assert len(saved) == 2
    for name in saved:
        about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        assert about["Num Buckets"] == "16"
    fact, dim = star.fact(s), star.dim_location(s)
    plain = fact.join(dim.select("location_id", *[c for c in BY_LOCATION if c not in fact.columns]), "location_id")
    assert sorted(got.collect()) == sorted(plain.select(*BY_LOCATION).collect())
