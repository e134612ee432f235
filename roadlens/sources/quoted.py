"""Quoted delimited text read in many pieces, also where a quoted field holds line breaks.

A line starts a record if an even number of quotes stands before it in its file.
One pass over the lines counts, for each piece of a file that one task reads,
the lines with an odd number of quotes; sums of these in the order of the pieces
tell how each piece starts. A second pass puts the lines of each piece together
to records. A record that crosses pieces is joined from their ends. Lines move
to Python and back as Arrow arrays, never one by one, and are not shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from roadlens.session import settle

# tasks get the functions themselves, so that reading a file needs no package on the workers
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pieces of files whose starts are broadcast at most, some 200 bytes each; of more, lines are shuffled to their pieces.
MOST_PIECES = 200_000

_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
_LINE = rf'(?:{_FIELD},)*+(?:{_FIELD}|"[^"]*+(?:""[^"]*+)*+)\r?'
#: A line that starts outside quotes, and one that starts inside, as quoting by the book allows them.
OUTSIDE = rf"^{_LINE}$"
INSIDE = rf'^[^"]*+(?:""[^"]*+)*+(?:"(?:\r?$|,{_LINE}$)|$)'

PIECES = pa.schema([
    ("file", pa.string()), ("block", pa.int64()), ("turns", pa.int64()), ("header", pa.string()),
    ("wrong_outside", pa.int64()), ("wrong_inside", pa.int64()),
])
RECORDS = pa.schema([("file", pa.string()), ("block", pa.int64()), ("origin", pa.int64()), ("value", pa.string())])
FIRST = pa.schema([("file", pa.string()), ("header", pa.string())])
SEEN = ("file", "block", "value", "inside", "origin")


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the file and the piece of it they stand in, in order within each piece."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Rows of one piece that follow each other."""
    block, file = np.asarray(batch.column("block")), batch.column("file").dictionary_encode()
    index = np.asarray(file.indices)
    new = np.flatnonzero((block[1:] != block[:-1]) | (index[1:] != index[:-1])) + 1
    edges = [0, *new.tolist(), len(block)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield (file.dictionary[int(index[a])].as_py(), int(block[a])), batch.slice(a, b - a)


def _odd(lines: pa.Array) -> np.ndarray:
    return np.asarray(pc.count_substring(lines, '"')) % 2 == 1


def _filled(values: pa.Array) -> np.ndarray:
    return np.flatnonzero(np.asarray(pc.greater(pc.binary_length(pc.utf8_trim_whitespace(values)), 0)))


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per piece: lines that turn from outside to inside or back, and lines against the book either way."""
    now: dict | None = None
    for batch in batches:
        for (file, block), rows in _stretches(batch):
            if now is None or (file, block) != (now["file"], now["block"]):
                if now:
                    yield pa.RecordBatch.from_pylist([now], schema=PIECES)
                now = {"file": file, "block": block, "turns": 0, "header": None, "wrong_outside": 0, "wrong_inside": 0}
            lines, odd = rows.column("value"), _odd(rows.column("value"))
            turned = (now["turns"] + np.cumsum(odd) - odd) % 2 == 1
            for wrong, starts in (("wrong_outside", turned), ("wrong_inside", ~turned)):
                right = np.where(starts, np.asarray(rows.column("fits_inside")), np.asarray(rows.column("fits_outside")))
                now[wrong] += int((~right).sum())
            if block == 0 and now["header"] is None:
                filled = _filled(lines)
                now["header"] = lines[int(filled[0])].as_py() if len(filled) else None
            now["turns"] += int(odd.sum())
    if now:
        yield pa.RecordBatch.from_pylist([now], schema=PIECES)


def pieces_of(lines: DataFrame) -> DataFrame:
    """The pieces of all files: file, block, whether it starts inside a record (``inside``) and which piece that record
    began in (``origin``), whether a record crosses one of its ends, the file's first line, and whether any line of the
    file breaks the rules of quoting. Written, one row per piece."""
    quoted = F.col("value").contains('"')
    fits = {
        "fits_outside": F.when(quoted, F.col("value").rlike(OUTSIDE)).otherwise(F.lit(True)),
        "fits_inside": F.when(quoted, F.col("value").rlike(INSIDE)).otherwise(F.lit(True)),
    }
    pieces = settle(lines.withColumns(fits).mapInArrow(_measure, from_arrow_schema(PIECES)))
    file = Window.partitionBy("file")
    before = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    turns = F.coalesce(F.sum("turns").over(before), F.lit(0))
    inside = turns % 2 == 1
    next_inside = (turns + F.col("turns")) % 2 == 1
    wrong = F.max(F.when(F.col("inside"), F.col("wrong_inside")).otherwise(F.col("wrong_outside"))).over(file) > 0
    return settle(
        pieces.select(
            "file", "block", "wrong_outside", "wrong_inside", inside.alias("inside"),
            F.max(F.when(F.col("turns") > 0, F.col("block"))).over(before).alias("origin"),
            (inside | next_inside).alias("crosses"), F.max("header").over(file).alias("header"),
        ).withColumn("irregular", wrong).drop("wrong_outside", "wrong_inside")
    )


def _records(crossing: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Whole records of each piece, or with ``crossing`` its ends: text of records that other pieces share.

    The first filled record of a file is its header and left out.
    """

    def out(file: str, block: int, origin: int | None, values: pa.Array) -> pa.RecordBatch:
        n = len(values)
        own = [pa.repeat(pa.scalar(v, t), n) for v, t in ((file, pa.string()), (block, pa.int64()), (origin, pa.int64()))]
        return pa.RecordBatch.from_arrays([*own, values.cast(pa.string())], schema=RECORDS)

    def joined(parts: list[pa.Array]) -> pa.Array:
        lines = pa.concat_arrays(parts)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines), "\n")

    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = inside = skip = origin = None
        held: list[pa.Array] = []  # lines of a record that has begun, or that another piece has begun
        for batch in batches:
            for piece, rows in _stretches(batch):
                lines = rows.column("value")
                if piece != now:
                    if held and crossing:
                        yield out(*now, origin, joined(held))
                    starts_inside = rows.column("inside")[0].as_py()
                    if starts_inside is None:
                        raise RuntimeError(f"{piece[0]} was cut into other pieces than before; read it again")
                    now, inside, skip, held = piece, starts_inside, piece[1] == 0, []
                    origin = rows.column("origin")[0].as_py() if inside else piece[1]
                odd = _odd(lines)
                before = (inside + np.cumsum(odd) - odd) % 2 == 1
                inside = bool((inside + odd.sum()) % 2)
                starts = np.flatnonzero(~before)
                if not len(starts):
                    held.append(lines)
                    continue
                if starts[0] or held:
                    held.append(lines.slice(0, starts[0]))
                    if origin != now[1]:  # the end of another piece's record
                        if crossing:
                            yield out(*now, origin, joined(held))
                    elif not crossing:
                        yield out(*now, None, joined(held))
                origin, held = now[1], []
                ends = np.append(starts[1:], len(lines))
                if inside:
                    held, starts, ends = [lines.slice(int(starts[-1]))], starts[:-1], ends[:-1]
                if crossing or not len(starts):
                    continue
                whole = lines.slice(int(starts[0]), int(ends[-1] - starts[0]))
                if len(whole) > len(starts):
                    bounds = pa.array(np.append(starts, ends[-1]) - starts[0], pa.int32())
                    whole = pc.binary_join(pa.ListArray.from_arrays(bounds, whole), "\n")
                if skip and len(filled := _filled(whole)):
                    whole, skip = whole.slice(int(filled[0]) + 1), False
                yield out(*now, None, whole)
        if held and crossing:
            yield out(*now, origin, joined(held))

    return records


def _first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = None
    for batch in batches:
        for (file, _), rows in _stretches(batch):
            if file != seen and len(filled := _filled(rows.column("value"))):
                seen = file
                header = rows.column("value")[int(filled[0])].as_py()
                yield pa.RecordBatch.from_pylist([{"file": file, "header": header}], schema=FIRST)


def first_lines(spark: SparkSession, path: str) -> DataFrame:
    """The first filled line (``header``) of each ``file`` under ``path``, from a pass over its first piece."""
    return lines_of(spark, path).filter("block = 0").mapInArrow(_first, from_arrow_schema(FIRST))


@dataclass
class Quoted:
    """Records of the files with one header, and the files with that header that quoting rules do not tell apart."""

    header: str
    records: DataFrame
    irregular: list[str]


def read_quoted(spark: SparkSession, path: str, lines: DataFrame | None = None) -> list[Quoted]:
    """Records (``value``, without headers) of the files under ``path``, by header; reads them once to find records.

    ``lines`` are the files' lines as ``lines_of`` gives them, if they are read already (a stream's batch).

    Lines end in \\n or \\r\\n, fields are parted by commas and quoted with ",
    which is doubled inside. A file that holds quotes in other places, which no
    piece could judge by itself, is named in ``irregular`` and to be read in one
    task. A header is one line. Files without a filled line have no records. Record
    text is bounded by a piece, or by the record where that is longer.
    """
    lines = lines_of(spark, path) if lines is None else lines
    pieces = pieces_of(lines)
    headers = sorted(r["header"] for r in pieces.filter("header IS NOT NULL").select("header").distinct().collect())
    count, crossing = pieces.agg(F.count("*"), F.count_if("crosses")).collect()[0]
    found = []
    for header in headers:
        own = pieces.filter(F.col("header") == header)
        irregular = [r["file"] for r in own.filter("irregular AND block = 0").select("file").collect()]
        # a line without its piece goes on to the check in the task
        wanted = (F.col("header") == header) & ~F.col("irregular") | F.col("inside").isNull()
        records = _with_pieces(lines, pieces, count).filter(wanted).select(*SEEN).mapInArrow(_records(False), from_arrow_schema(RECORDS))
        records = records.select("value")
        if crossing:
            parts = _with_pieces(lines, pieces.filter("crosses"), count, "inner").filter(wanted).select(*SEEN)
            parts = parts.mapInArrow(_records(True), from_arrow_schema(RECORDS))
            text = F.array_sort(F.collect_list(F.struct("block", "value")))
            # the pieces of one record, which a task that read the file alone would hold too
            whole = parts.groupBy("file", "origin").agg(F.array_join(F.transform(text, lambda p: p["value"]), "\n").alias("value"))
            records = records.unionByName(whole.select("value"))
        value = F.regexp_replace("value", "\r$", "")
        if header.endswith("\r"):  # where lines end so, breaks inside quotes are read as \n too
            value = F.replace(value, F.lit("\r\n"), F.lit("\n"))
        records = records.select(value.alias("value")).filter("value <> ''")
        found.append(Quoted(header, records, irregular))
    return found


def _with_pieces(lines: DataFrame, pieces: DataFrame, count: int, how: str = "left") -> DataFrame:
    if count <= MOST_PIECES:
        return lines.join(F.broadcast(pieces), ["file", "block"], how)
    line = F.monotonically_increasing_id()
    joined = lines.withColumn("line", line).join(pieces, ["file", "block"], how)
    return joined.repartition("file", "block").sortWithinPartitions("file", "block", "line").drop("line")
