"""Marts kept up to date while incidents arrive.

Every mart is made of additive cells, so a batch only has to be aggregated to
its own cells and added to those kept. Cells and the number of the last batch
are committed together: a batch that is run again after a failure finds its
number there and is left out, and readers see whole batches only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadlens.operators import aggregate as agg
from roadlens.plans import models
from roadlens.session import discard, settle
from roadlens.sources.versions import committed, publish_together, read_together

BATCHES = "batches"


@dataclass(frozen=True)
class Kept:
    """How a mart is made: cells of rows, and the mart of cells, which may come in several rows each."""

    cells: Callable[[DataFrame], DataFrame]
    mart: Callable[[DataFrame, int], DataFrame]


MARTS = {
    "mart_temporal": Kept(models.temporal_cells, lambda c, year: models.mart_temporal(models.temporal_model(c, year))),
    "mart_geo": Kept(models.city_sums, lambda c, _: models.mart_geo(models.int_geo_hotspots(c))),
    "mart_weather_poi": Kept(models.weather_poi_cells, lambda c, _: models.mart_weather_poi(models.weather_poi_model(c))),
    "mart_funnel": Kept(models.funnel_cells, lambda c, year: models.mart_funnel(models.funnel_model(c, year))),
}
MEASURES = {*agg.ADDITIVE, *models.STEPS}


def add_batch(
    rows: DataFrame, batch: int, path: str, source: str = "arrivals", marts: Sequence[str] = tuple(MARTS)
) -> bool:
    """Adds the typed incident rows of one batch to the cells under ``path``; False if that batch is in them already.

    Batches of a ``source`` have ascending numbers. Work and space follow the
    batch and the number of cells, not the rows of earlier batches. Two updates
    at a time cannot both be committed; the later raises Conflict.
    """
    spark = rows.sparkSession
    number, old = committed(spark, path), read_together(spark, path)
    known = old.pop(BATCHES, None)
    if known is not None and not known.filter((F.col("source") == source) & (F.col("last") >= batch)).isEmpty():
        return False
    written = settle(rows)  # read once for each mart
    new = {}
    for name in marts:
        cells = MARTS[name].cells(written)
        new[name] = add_cells(old[name], cells) if name in old else cells
    last = spark.createDataFrame([(source, batch)], "source string, last long")
    if known is not None:
        last = known.filter(F.col("source") != source).unionByName(last)
    publish_together({**{n: df for n, df in old.items() if n not in new}, **new, BATCHES: last}, path, after=number)
    discard(written)
    return True


def add_cells(old: DataFrame, more: DataFrame) -> DataFrame:
    """Cells with the measures of both, in the types of ``old``."""
    keys = [c for c in old.columns if c not in MEASURES]
    sums = old.unionByName(more).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in old.columns if c in MEASURES])
    return sums.select(*[F.col(f.name).cast(f.dataType) for f in old.schema])


def read_mart(spark: SparkSession, path: str, name: str, partial_year: int = models.PARTIAL_YEAR) -> DataFrame:
    """A mart over all batches committed so far."""
    return MARTS[name].mart(read_together(spark, path)[name], partial_year)


def keep_marts(
    arrivals: DataFrame, path: str, checkpoint: str, source: str = "arrivals", marts: Sequence[str] = tuple(MARTS)
) -> StreamingQuery:
    """Adds a stream of typed incident rows to the cells under ``path``, batch by batch, and stops when all are in."""
    return (
        arrivals.writeStream.foreachBatch(lambda rows, batch: add_batch(rows, batch, path, source, marts) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
