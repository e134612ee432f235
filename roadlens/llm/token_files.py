"""Token-id files: a corpus' ids in order of doc_id, in segments of independently coded blocks."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlens.llm import range_coder
from roadlens.llm.base import pieces, rows_out, schema_of
from roadlens.llm.tokens import encoder

#: Ids of whole documents that a segment holds, if no document is longer.
SEGMENT = range_coder.LANES * range_coder.BLOCK
END = 0

#: A file's row: the range of doc_ids it is of, its place there, its documents with their sizes, their coded ids.
STORED = pa.schema([
    ("part", pa.int32()), ("segment", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("sizes", pa.list_(pa.int64())), ("blocks", pa.binary()),
])
READ = pa.schema([
    ("doc_id", pa.int64()), ("part", pa.int32()), ("segment", pa.int64()), ("first", pa.int64()),
    ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary()),
])


def _store(path: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def store(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, end = TaskContext.get().partitionId(), 0, END.to_bytes(2, "little")
        doc_ids, sizes, held, size = [], [], [], 0

        def row() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u2")
            values = (part, segment, len(ids), doc_ids, sizes, range_coder.encode(ids))
            return rows_out(STORED, {name: [value] for name, value in zip(STORED.names, values, strict=True)})

        for piece in pieces(batches):
            for doc_id, ids in zip(piece["doc_id"], encoder(path, True).encode(piece["text"]), strict=True):
                doc_ids.append(doc_id)
                sizes.append(len(ids) // 2 + 1)
                held += [ids, end]
                size += sizes[-1]
                if size >= SEGMENT:
                    yield row()
                    segment += 1
                    doc_ids, sizes, held, size = [], [], [], 0
        if doc_ids:
            yield row()

    return store


def write_ids(docs: DataFrame, path: str, out: str) -> None:
    """Writes the ids of ``docs`` (doc_id, text) to the folder ``out``, each text with the end id after it.

    Rows are dealt to ranges of doc_id, as many as the input has partitions, and
    sorted; null ids come first, rows of one id are ordered by text. Null text
    counts as empty. An empty table gives an empty folder.
    """
    ranges = max(1, docs.rdd.getNumPartitions())
    ordered = docs.select("doc_id", "text").repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_store(path), schema_of(STORED)).write.parquet(out)


def _load(with_ids: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def load(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                ids = range_coder.decode(r["blocks"])
                ends = np.cumsum([0, *r["sizes"]])
                if ends[-1] != len(ids):
                    raise ValueError("a segment's sizes do not match its blocks")
                out: dict[str, list] = {name: [] for name in READ.names}
                for doc_id, a, b in zip(r["doc_ids"], ends.tolist(), ends[1:].tolist(), strict=False):
                    own = ids[a:b]
                    raw = own.astype("<u2").tobytes() if with_ids else None
                    values = (doc_id, r["part"], r["segment"], a, b - a, zlib.crc32(own.astype("<u4").tobytes()), raw)
                    for name, value in zip(READ.names, values, strict=True):
                        out[name].append(value)
                yield rows_out(READ, out)

    return load


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of a folder that ``write_ids`` wrote.

    Columns: doc_id, start (ids of all documents before it), n_tokens, ids_crc32
    (of the ids as little-endian unsigned 32-bit integers) and, if wanted, ids
    (unsigned 16-bit). A damaged block stops the job.
    """
    stored = spark.read.schema(schema_of(STORED)).parquet(path)
    parts = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    to_here = Window.unboundedPreceding, -1
    before = parts.select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*to_here)), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(*to_here)
    starts = stored.select("part", "segment", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("here"))
    starts = starts.join(before, "part").select("part", "segment", (F.col("before") + F.col("here")).alias("at"))
    found = stored.mapInArrow(_load(with_ids), schema_of(READ)).join(starts, ["part", "segment"])
    columns = ["doc_id", (F.col("at") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"]
    return found.select(*columns, *(["ids"] if with_ids else []))
