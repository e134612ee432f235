"""Connected components of a table of links, without collecting any."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.session import settle


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (u, v): root is the least node it is connected to.

    Large-star and small-star rounds in turn: a round hangs the larger neighbours
    of each node, then the smaller ones, on its least neighbour, until nothing
    changes; the number of rounds grows with the logarithm of the longest path.
    Links with a null end are left out; a link to itself makes a node of its own.
    """
    known = links.filter("u IS NOT NULL AND v IS NOT NULL")
    stars = settle(_down(known))
    was = _figures(stars)
    while was[0]:
        both = stars.select("u", "v").unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that the join deals out both sides itself and can cut a hot node's links over tasks
        least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settle(large)
        lower = settle(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(lower, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = settle(_down(small.unionByName(lower.select("u", F.col("m").alias("v")))))
        now = _figures(stars)
        if now == was:
            break
        was = now
    roots = stars.select(F.col("v").alias("node")).unionByName(known.filter("u = v").select(F.col("u").alias("node")))
    roots = roots.distinct().join(stars.select(F.col("u").alias("node")), "node", "left_anti")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def _down(links: DataFrame) -> DataFrame:
    """Each link once, from the larger node to the smaller."""
    return links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _figures(stars: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(stars.agg(F.count("*"), digest).collect()[0])
