"""Packing: documents' token ids into windows, by length combinations that non-negative least squares chooses."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.base import pieces, rows_out, schema_of
from roadlens.llm.tokens import encoder
from roadlens.session import settle

WINDOW = 2048
#: Lengths are counted in bins of so many tokens; a combination of bins fills a window.
BIN = 8
END = 1
#: Most steps of the active set.
STEPS = 3000
#: A combination has so many parts at most.
PARTS = 8

TOKENS = pa.schema([
    ("doc_id", pa.int64()), ("part", pa.int32()), ("row", pa.int64()), ("n", pa.int64()),
    ("bin", pa.int32()), ("nth", pa.int64()), ("full_before", pa.int64()), ("crcs", pa.list_(pa.int64())),
    ("ids", pa.binary()),
])
PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ("part", pa.int32()), ("row", pa.int64()), ("ids", pa.binary()),
])
ASSIGNED = pa.schema([
    ("doc_id", pa.int64()), ("part", pa.int32()), ("row", pa.int64()), ("n", pa.int64()), ("crcs", pa.list_(pa.int64())),
    ("full", pa.int64()), ("sequence", pa.int64()), ("place", pa.int64()),
])


def crc(ids: bytes) -> int:
    """Of unsigned 16-bit ids, as 32-bit ones."""
    return zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4"))


def _tokenise(path: str, window: int, width: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def tokenise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, full = TaskContext.get().partitionId(), 0, 0
        seen = np.zeros(window // width + 1, np.int64)
        end = np.array([END], "<u2").tobytes()
        for piece in pieces(batches):
            out: dict[str, list] = {name: [] for name in TOKENS.names}
            for doc_id, ids in zip(piece["doc_id"], encoder(path, False).encode(piece["text"]), strict=True):
                ids += end
                n = len(ids) // 2
                rest = -(-(n % window) // width)
                # of each full window, then of the rest
                crcs = [crc(ids[at : at + 2 * window]) for at in range(0, len(ids), 2 * window)]
                values = (doc_id, part, row, n, rest, int(seen[rest]), full, crcs, ids)
                for name, value in zip(TOKENS.names, values, strict=True):
                    out[name].append(value)
                seen[rest] += 1
                full += n // window
                row += 1
            yield rows_out(TOKENS, out)

    return tokenise


class Combinations:
    """Ways to fill ``bins`` exactly with 1 to ``parts`` parts; the one with the greatest sum of worths is found
    part by part, so that all are weighed without being listed."""

    def __init__(self, bins: int, parts: int) -> None:
        self.bins, self.parts = bins, parts

    def best(self, worth: np.ndarray) -> tuple[float, list[int]]:
        """The greatest sum of ``worth`` (index: length, -inf: none left) and its parts, ascending; none if nothing fills."""
        size = np.flatnonzero(worth > -np.inf)
        size = size[size > 0]
        most = np.full((self.parts + 1, self.bins + 1), -np.inf)
        most[0, 0] = 0
        last = np.zeros((self.parts + 1, self.bins + 1), np.int64)
        if not len(size):
            return -np.inf, []
        room = np.arange(self.bins + 1)[None, :] - size[:, None]
        for k in range(1, self.parts + 1):
            sums = np.where(room >= 0, most[k - 1][np.maximum(room, 0)], -np.inf) + worth[size][:, None]
            pick = sums.argmax(axis=0)
            most[k], last[k] = sums[pick, np.arange(self.bins + 1)], size[pick]
        k, left, chosen = int(most[:, self.bins].argmax()), self.bins, []
        if most[k, left] == -np.inf:
            return -np.inf, []
        value = float(most[k, left])
        while left:
            chosen.append(int(last[k, left]))
            left -= chosen[-1]
            k -= 1
        return value, sorted(chosen)


def nonnegative_least_squares(
    b: np.ndarray, best: Callable[[np.ndarray], tuple[float, list[int]]], steps: int = STEPS
) -> tuple[list[list[int]], np.ndarray]:
    """Patterns and repeats x >= 0 with the least ||A x - b||; a column of A counts a pattern's parts by length.

    ``best`` gives the pattern with the greatest slope, the sum of what its
    parts still lack. The active set holds at most as many patterns as ``b`` has
    entries. Entries of ``b`` that are 0 are lengths that no pattern may hold.
    """
    patterns: list[list[int]] = []
    a, x = np.zeros((len(b), 0)), np.zeros(0)
    least = 1e-9 * max(1.0, float(b.max(initial=0))) * PARTS
    for _ in range(steps):
        value, parts = best(np.where(b > 0, b - a @ x, -np.inf))
        if value <= least or len(patterns) >= len(b) or parts in patterns:
            break
        patterns.append(parts)
        a = np.column_stack([a, np.bincount(parts, minlength=len(b))])
        x = np.append(x, 0.0)
        while len(patterns):
            s = np.linalg.solve(a.T @ a + 1e-9 * np.eye(a.shape[1]), a.T @ b)
            if s.min() > 0:
                x = s
                break
            low = s <= 0
            step = float(np.min(x[low] / (x[low] - s[low] + 1e-300)))
            x = x + step * (s - x)
            stays = ~(low & (x <= 1e-9 * max(1.0, float(x.max()))))
            if stays.all():
                stays[int(np.argmin(np.where(low, x, np.inf)))] = False
            a, x = a[:, stays], x[stays]
            patterns = [p for p, stay in zip(patterns, stays, strict=True) if stay]
    return patterns, x


class Plan:
    """Which combinations are repeated how often, for a histogram of binned lengths (index: bin, 0 unused)."""

    def __init__(self, histogram: np.ndarray, parts: int = PARTS) -> None:
        bins = len(histogram) - 1
        ways = Combinations(bins, parts)
        held = histogram.astype(float)
        held[0] = 0
        patterns, solved = nonnegative_least_squares(held, ways.best)
        self.left = histogram.astype(np.int64)
        self.first: list[list[int]] = [[0] for _ in range(bins + 1)]  # per bin: ranks at which each slot begins
        self.slots: list[list[tuple[int, int]]] = [[] for _ in range(bins + 1)]  # its first sequence, place in it
        self.sequences = 0
        for p in np.argsort(-solved, kind="stable").tolist():
            self._repeat(patterns[p], int(round(solved[p])))
        # what rounding left: the longest first, in whatever combination fills the window with it
        tried = self.left > 0
        tried[0] = False
        while tried.any():
            longest = int(np.flatnonzero(tried)[-1])
            worth = np.where(self.left > 0, np.arange(bins + 1) ** 2 / bins**2, -np.inf)
            worth[longest + 1 :] = -np.inf
            worth[0], worth[longest] = -np.inf, parts  # the longest has to be in it
            _, found = ways.best(worth)
            if longest not in found or not self._repeat(found, int(self.left[longest])):
                tried[longest] = False
            tried &= self.left > 0

    def _repeat(self, parts: list[int], times: int) -> int:
        """Plans ``times`` sequences of ``parts``, as far as documents are left; says how many."""
        times = min([times, *(int(self.left[v]) // parts.count(v) for v in set(parts))])
        if times > 0:
            for place, v in enumerate(parts):
                self.slots[v].append((self.sequences, place))
                self.first[v].append(self.first[v][-1] + times)
                self.left[v] -= times
            self.sequences += times
        return max(0, times)


def _assign(plan: Plan) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds each rest's sequence and place by the plan; null for rests beyond the repeats."""
    first = [np.array(f) for f in plan.first]

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, ranks = (np.asarray(batch.column(c)) for c in ("bin", "rank"))
            sequence, place = np.full(len(bins), -1), np.zeros(len(bins), np.int64)
            for b in np.unique(bins).tolist():
                if plan.slots[b]:
                    rows = np.flatnonzero((bins == b) & (ranks < first[b][-1]))
                    slot = np.searchsorted(first[b], ranks[rows], "right") - 1
                    base, nth = np.array(plan.slots[b]).T
                    sequence[rows], place[rows] = base[slot] + ranks[rows] - first[b][slot], nth[slot]
            own = {"sequence": pa.array(sequence, mask=sequence < 0), "place": pa.array(place)}
            yield rows_out(ASSIGNED, {n: own[n] if n in own else batch.column(n) for n in ASSIGNED.names})

    return assign


def packed(docs: DataFrame, path: str, window: int = WINDOW, width: int = BIN, with_ids: bool = True) -> DataFrame:
    """Pieces of documents (doc_id, text) in sequences of at most ``window`` tokens; one row per piece.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    ids (little-endian unsigned 16-bit, null without ``with_ids``), and part and
    row, which name the row of ``docs``. Each text's ids and the end id form a
    document. Windows that one document fills by itself are cut off first. The
    rests are counted per bin of ``width`` tokens; combinations of up to PARTS
    bins that fill a window are repeated as non-negative least squares on that
    histogram says, rounded, and what rounding leaves is combined greedily. Rests
    that no combination takes are laid one after the other and cut where a window
    is full; the last, part-filled window is cut into powers of two, which need
    no padding either.

    Null text counts as empty, so each row has at least its end id. Repeated rows
    are documents of their own; ties in length are ranked as rows come. An empty
    table gives no rows. What reaches the driver is a histogram of window / width
    counts and two sums. Places are found on a few numbers per row; ids are
    shuffled only for documents that are cut, or where they are asked for.
    """
    tokens = settle(docs.select("doc_id", "text").mapInArrow(_tokenise(path, window, width), schema_of(TOKENS)))
    counts = settle(tokens.groupBy("part", "bin").agg(F.count("*").alias("docs"), F.sum(F.expr(f"n div {window}")).alias("full")))
    total = np.zeros(window // width + 1, np.int64)
    for r in counts.groupBy("bin").agg(F.sum("docs").alias("docs")).collect():
        total[r["bin"]] = r["docs"]
    total[0] = 0
    plan = Plan(total)

    def before(column: str, order: str, *keys: str) -> Column:
        over = Window.partitionBy(*keys).orderBy(order) if keys else Window.orderBy(order)
        return F.coalesce(F.sum(column).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    docs_before = counts.select("part", "bin", before("docs", "part", "bin").alias("docs_before"))
    full_before = counts.groupBy("part").agg(F.sum("full").alias("full"))
    full_before = full_before.select("part", before("full", "part").alias("part_full"))
    ranked = tokens.join(docs_before, ["part", "bin"]).join(full_before, "part").select(
        "doc_id", "part", "row", "n", "bin", "crcs",
        (F.col("docs_before") + F.col("nth")).alias("rank"), (F.col("part_full") + F.col("full_before")).alias("full"),
    )
    assigned = settle(ranked.mapInArrow(_assign(plan), schema_of(ASSIGNED)))
    rest = F.expr(f"n % {window}")
    chosen = assigned.filter("sequence IS NOT NULL").withColumn("rest", rest)
    chosen = chosen.withColumn("offset", before("rest", "place", "sequence"))
    left = assigned.filter("sequence IS NULL").withColumn("rest", rest)
    sums = settle(left.groupBy("part").agg(F.sum("rest").alias("rests")))
    rests = sums.agg(F.sum("rests")).collect()[0][0] or 0
    at = F.col("part_at") + before("rest", "row", "part")
    greedy = left.join(sums.select("part", before("rests", "part").alias("part_at")), "part").withColumn("at", at)
    ids = tokens.select("part", "row", "ids")

    # windows that a document fills by itself follow all others
    after = plan.sequences + int(rests) // window + len(last_windows(int(rests) % window))
    start = F.expr(f"k * {window}L")
    head = F.col("k") < F.expr(f"n div {window}")
    whole = chosen.select("*", F.posexplode("crcs").alias("k", "ids_crc32")).select(
        "doc_id", start.alias("start"), F.when(head, window).otherwise(F.col("rest")).cast("long").alias("length"),
        "ids_crc32", F.col("n").alias("doc_tokens"),
        F.when(head, F.lit(after) + F.col("full") + F.col("k")).otherwise(F.col("sequence")).alias("sequence_id"),
        F.when(head, 0).otherwise(F.col("offset")).cast("long").alias("offset"), "part", "row",
    )
    if with_ids:
        whole = whole.join(ids, ["part", "row"])
        whole = whole.withColumn("ids", F.expr("substring(ids, int(2 * start + 1), int(2 * length))"))
    else:
        whole = whole.withColumn("ids", F.lit(None).cast("binary"))
    # written, so that a join that can do without shuffling the ids of all documents does
    cut = settle(greedy.select("doc_id", "part", "row", "n", "full", "at")).join(ids, ["part", "row"])
    cut = cut.mapInArrow(_cut(plan.sequences, int(rests), window, with_ids), schema_of(PIECES))
    return whole.select(*PIECES.names).unionByName(cut)


def last_windows(rest: int) -> list[int]:
    """``rest`` as powers of two, the largest first."""
    return [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _cut(
    first: int, rests: int, window: int, with_ids: bool
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pieces of documents whose rests are laid end to end from sequence ``first`` on; full windows follow these."""
    whole, tail = divmod(rests, window)
    ends = np.cumsum([window * whole, *last_windows(tail)]).tolist()
    after = first + whole + len(ends) - 1

    def spots_of(at: int, n: int) -> Iterator[tuple[int, int, int]]:
        """(sequence, offset, length) of the pieces of a rest of ``n`` ids at ``at`` among all rests."""
        while n:
            sequence, offset = divmod(at, window)
            room = window - offset
            if sequence >= whole:
                k = bisect_right(ends, at)
                sequence, offset, room = whole + k - 1, at - ends[k - 1], ends[k] - at
            take = min(n, room)
            yield first + sequence, offset, take
            at, n = at + take, n - take

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in PIECES.names}
            for r in batch.to_pylist():
                n, start = r["n"], 0
                spots = [(after + r["full"] + k, 0, window) for k in range(n // window)]
                spots += spots_of(r["at"], n % window)
                for sequence, offset, length in spots:
                    ids = r["ids"][2 * start : 2 * (start + length)]
                    own = ids if with_ids else None
                    values = (r["doc_id"], start, length, crc(ids), n, sequence, offset, r["part"], r["row"], own)
                    for name, value in zip(PIECES.names, values, strict=True):
                        out[name].append(value)
                    start += length
            yield rows_out(PIECES, out)

    return cut
