"""What the operators share: whole texts in bounded pieces, rows out of tasks, hash remainders."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

#: Characters of text that a task turns into arrays at once; a longer text is a piece of its own.
PIECE = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(batches: Iterable[pa.RecordBatch], limit: int = PIECE) -> Iterator[dict[str, list]]:
    """The rows of ``batches`` as lists per column, cut so that ``text`` (null: '') stays near ``limit`` characters."""
    for batch in batches:
        names = batch.schema.names
        where, at, size = names.index("text"), 0, 0
        texts = ["" if t is None else t for t in batch.column(where).to_pylist()]
        for i, text in enumerate(texts):
            size += len(text)
            if size >= limit or i + 1 == len(texts):
                rows = batch.slice(at, i + 1 - at)
                yield {n: texts[at : i + 1] if n == "text" else rows.column(k).to_pylist() for k, n in enumerate(names)}
                at, size = i + 1, 0


def rows_out(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def schema_of(schema: pa.Schema) -> StructType:
    return from_arrow_schema(schema)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def text_key() -> Column:
    """Tells rows of one doc_id apart by their texts; equal rows share it, a null text counts as empty."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def spare(columns: Iterable[str], *names: str) -> list[str]:
    """``names`` as they are or with underscores before them, so that none is in ``columns``, whatever the case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out
