"""Best-fit packing: sequences are planned on the histogram of lengths, documents then take the planned slots."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.base import pieces, rows_out, schema_of
from roadlens.llm.tokens import encoder
from roadlens.session import settle

WINDOW = 2048
END = 0

#: A row of ``docs`` after tokenising: the length of its first piece and its rank among those of that length in the
#: part, the part's full pieces before it, and the crc of each piece.
TOKENS = pa.schema([
    ("part", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("length", pa.int64()), ("nth", pa.int64()),
    ("full", pa.int64()), ("crcs", pa.list_(pa.int64())), ("ids", pa.binary()),
])
SLOTS = "of long, first long, last long, each long, sequence long, at long"


def cuts(n: int, window: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; all but the first fill the window."""
    head = (n - 1) % window + 1
    return [(0, head), *((at, window) for at in range(head, n, window))]


def _tokenise(
    path: str, leading_space: bool, end: int, window: int, with_ids: bool
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def tokenise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, full = TaskContext.get().partitionId(), 0, 0
        seen = np.zeros(window + 1, np.int64)
        last = np.array([end], "<u2").tobytes()
        for piece in pieces(batches):
            out: dict[str, list] = {name: [] for name in TOKENS.names}
            for doc_id, ids in zip(piece["doc_id"], encoder(path, leading_space).encode(piece["text"]), strict=True):
                ids += last
                wide = np.frombuffer(ids, "<u2").astype("<u4")
                spans = cuts(len(wide), window)
                crcs = [zlib.crc32(wide[a : a + length]) for a, length in spans]
                length = spans[0][1]
                values = (part, row, doc_id, length, int(seen[length]), full, crcs, ids if with_ids else None)
                for name, value in zip(TOKENS.names, values, strict=True):
                    out[name].append(value)
                seen[length] += 1
                full += len(spans) - 1
                row += 1
            yield rows_out(TOKENS, out)

    return tokenise


class Plan:
    """Best fit, the longest first, on how often each length occurs; sequences of the same filling are one entry.

    ``slots`` holds (length, first, last, each, sequence, at): pieces of that
    length ranked from ``first`` to before ``last`` lie in sequences from
    ``sequence`` on, ``each`` in one, from offset ``at``. There are as many
    entries as distinct fillings, which the window bounds, not the documents.
    """

    def __init__(self, histogram: np.ndarray) -> None:
        self.window = len(histogram) - 1
        self.sequences = 0
        self.slots: list[tuple[int, int, int, int, int, int]] = []
        #: Sequences with so many free tokens: the first one and how many.
        self.room: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for length in range(self.window, 0, -1):
            self._place(length, int(histogram[length]))

    def _place(self, length: int, count: int) -> None:
        """Puts ``count`` pieces where they fit tightest.

        A piece leaves its sequence tighter than before, so the same sequence
        takes pieces of one length until no more fit.
        """
        rank = 0
        fitting = sorted((free for free, known in self.room.items() if free >= length and known), reverse=True)
        while rank < count:
            if fitting:
                free = fitting[-1]
                sequence, many = self.room[free].pop()
                if not self.room[free]:
                    fitting.pop()
            else:
                free, sequence = self.window, self.sequences
                many = -(-(count - rank) // (self.window // length))
                self.sequences += many
            each = free // length
            full = min(many, (count - rank) // each)
            takes = [(full, each)] if full else []
            if full < many and count - rank > full * each:
                takes.append((1, count - rank - full * each))
            for sequences, held in takes:
                self.slots.append((length, rank, rank + sequences * held, held, sequence, self.window - free))
                if left := free - held * length:
                    self.room[left].append((sequence, sequences))
                rank, sequence, many = rank + sequences * held, sequence + sequences, many - sequences
            if many:
                self.room[free].append((sequence, many))


def best_fit(
    docs: DataFrame, path: str, leading_space: bool = True, end: int = END, window: int = WINDOW, with_ids: bool = True
) -> DataFrame:
    """Pieces of documents (doc_id, text) in sequences of at most ``window`` tokens, as few as best fit needs.

    Columns: doc_id, piece (from 0), start, length, ids_crc32, sequence_id,
    offset, ids (little-endian unsigned 16-bit, null without ``with_ids``), and
    part and row, which name the row of ``docs``. ``path`` is a tokenizer file
    and ``leading_space`` says that its words hold the space before them. Each
    text's ids and the id ``end`` form a document. One that is longer than a
    window is cut into windows, of which the first may be shorter; a full one is
    a sequence by itself. The others are planned on their histogram of lengths
    by best fit, the longest first, and each takes the slot of its rank within
    its length.

    Null text counts as empty, so each row has at least its end id. Repeated
    rows are documents of their own; ties in length are ranked as rows come. An
    empty table gives no rows; other columns are ignored. The driver gets ``window`` counts. The
    plan's slots, a table that the window bounds, are broadcast. Tokens are
    written once; afterwards only lengths and places move, never ids.
    """
    spark = docs.sparkSession
    tokenise = _tokenise(path, leading_space, end, window, with_ids)
    tokens = settle(docs.select("doc_id", "text").mapInArrow(tokenise, schema_of(TOKENS)))
    counts = settle(tokens.groupBy("part", "length").agg(F.count("*").alias("docs")))
    histogram = np.zeros(window + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("docs").alias("docs")).collect():
        histogram[r["length"]] = r["docs"]
    plan = Plan(histogram)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("part", "length", F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("earlier"))
    slots = spark.createDataFrame(plan.slots, SLOTS)
    rank = F.col("earlier") + F.col("nth")
    taken = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    # as many rows as parts have lengths, which grows with the table: not for a broadcast
    heads = tokens.join(earlier.hint("merge"), ["part", "length"]).withColumn("rank", rank)
    placed = heads.join(F.broadcast(slots), (F.col("length") == F.col("of")) & taken)
    head = F.col("piece") == 0
    spans = placed.select("*", F.posexplode("crcs").alias("piece", "ids_crc32")).select(
        "doc_id", "piece",
        F.when(head, 0).otherwise(F.expr(f"length + (piece - 1) * {window}")).cast("long").alias("start"),
        F.when(head, F.col("length")).otherwise(window).cast("long").alias("length"),
        "ids_crc32",
        # pieces behind the first fill sequences of their own, numbered below 0
        F.when(head, F.expr("sequence + (rank - first) div each"))
        .otherwise(F.expr(f"-(part * {1 << 40} + full + piece)")).alias("sequence_id"),
        F.when(head, F.expr("at + (rank - first) % each * length")).otherwise(0).cast("long").alias("offset"),
        "ids", "part", "row",
    )
    return spans.withColumn("ids", F.expr("substring(ids, int(2 * start + 1), int(2 * length))"))
