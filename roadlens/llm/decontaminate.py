"""Benchmark decontamination: word windows of test items, found and verified in training texts."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.base import pieces, rows_out, schema_of, spare, text_key
from roadlens.session import settle

WINDOW = 10
#: Windows that one broadcast holds at most (about 100 MB of Python objects); more are scanned in several passes.
BLOCK_WINDOWS = 200_000
# Fixed value: what a word is, over UTF-8 bytes; bytes from 0x80 up are parts of words.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
FACTOR = np.uint64(0x9E3779B97F4A7C15)

OUT = pa.schema([
    ("doc_id", pa.int64()), ("row", pa.int64()), ("n_words", pa.int64()),
    ("spans", pa.list_(pa.list_(pa.int32()))), ("items", pa.list_(pa.string())),
])


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "replace").translate(UPPER))


class Windows:
    """A hash set of windows: word tuples, by length, with the items that hold them."""

    def __init__(self, items: list[tuple[str, list[bytes]]], n: int = WINDOW) -> None:
        self.ids: dict[bytes, int] = {}
        self.items: dict[int, dict[tuple, list[str]]] = defaultdict(dict)
        for item, words in items:
            size = min(n, len(words))
            numbers = [self.ids.setdefault(w, len(self.ids) + 1) for w in words]
            for i in range(len(words) - size + 1 if size else 0):
                held = self.items[size].setdefault(tuple(numbers[i : i + size]), [])
                if item not in held:
                    held.append(item)
        self.bits = {size: self._bits(list(found)) for size, found in self.items.items()}

    def _bits(self, windows: list[tuple]) -> np.ndarray:
        bits = np.zeros(1 << max(16, (16 * len(windows)).bit_length()), bool)
        keys = np.array(windows, np.uint64)
        bits[window_hashes(keys.ravel(), keys.shape[1])[:: keys.shape[1]] & np.uint64(len(bits) - 1)] = True
        return bits

    def scan(self, numbers: np.ndarray) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, number of words, items) of each window found; words outside the items are 0."""
        for size, found in self.items.items():
            if len(numbers) >= size:
                bits = self.bits[size]
                hit = bits[window_hashes(numbers, size) & np.uint64(len(bits) - 1)]
                for i in np.flatnonzero(hit).tolist():
                    if items := found.get(tuple(numbers[i : i + size].tolist())):
                        yield i, size, items


def window_hashes(numbers: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` numbers."""
    n = len(numbers) - size + 1
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * FACTOR + numbers[k : k + n]
    total ^= total >> np.uint64(29)
    total *= FACTOR
    return total >> np.uint64(20)


def _scanner(shared) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: Windows = shared.value
        for piece in pieces(batches):
            words = [words_of(t) for t in piece["text"]]
            get = windows.ids.get
            flat = np.fromiter((get(w, 0) for ws in words for w in ws), np.uint64, sum(map(len, words)))
            out: dict[str, list] = {name: [] for name in OUT.names}
            at = 0
            for k, ws in enumerate(words):
                spans, items = [], set()
                for start, size, found in sorted(windows.scan(flat[at : at + len(ws)]), key=lambda hit: hit[0]):
                    items.update(found)
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], start + size)
                    else:
                        spans.append([start, start + size])
                at += len(ws)
                for name, value in zip(
                    OUT.names, (piece["doc_id"][k], piece["row"][k], len(ws), spans, sorted(items)), strict=True
                ):
                    out[name].append(value)
            yield rows_out(OUT, out)

    return scan


def _blocks(rows: Iterable, n: int, bound: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in blocks of about ``bound`` windows; a longer item is cut into parts that overlap by n - 1 words."""
    block, size = [], 0
    for item, text in rows:
        words = words_of(text)
        for at in range(0, max(1, len(words) - n + 1), bound):
            part = words[at : at + bound + n - 1]
            block.append((item, part))
            size += len(part)
            if size >= bound:
                yield block
                block, size = [], 0
    if block:
        yield block


def find_contamination(docs: DataFrame, items: DataFrame, n: int = WINDOW, bound: int = BLOCK_WINDOWS) -> DataFrame:
    """Where texts of ``docs`` (doc_id, text) hold windows of ``items`` (item_id, text): one row per row of ``docs``.

    Columns: doc_id, row (key of the text), n_words, spans (word
    ranges, merged, in order), items (ids with occurring windows, as strings,
    sorted). A window is ``n`` consecutive words of an item, or all words of a
    shorter one; items without words have none. Hash hits are verified word by
    word. Windows are broadcast in blocks of at most about ``bound``, one pass
    over ``docs`` each. Where there are several, a pass is written when this is
    called and its block taken back before the next is made, so that neither the
    driver nor an executor holds more than two, however many items there are. Null
    and empty texts have no words; empty tables give no rows or no hits; repeated
    rows of ``docs`` give repeated results, of ``items`` count once.
    """
    context = docs.sparkSession.sparkContext
    texts = docs.select("doc_id", text_key().alias("row"), "text")
    listed = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text").toLocalIterator()
    blocks = _blocks(listed, n, bound)
    block, following = next(blocks, []), next(blocks, None)
    if following is None:
        return texts.mapInArrow(_scanner(context.broadcast(Windows(block, n))), schema_of(OUT))
    found = []
    while block is not None:
        shared = context.broadcast(Windows(block, n))
        one = texts.mapInArrow(_scanner(shared), schema_of(OUT))
        # the first pass counts the words of all rows
        found.append(settle(one if not found else one.filter(F.size("spans") > 0)))
        shared.destroy()
        block, following = following, next(blocks, None)
    merged = found[0].withColumn("pass", F.lit(0))
    for one in found[1:]:
        merged = merged.unionByName(one.withColumn("pass", F.lit(1)))
    together = merged.groupBy("doc_id", "row").agg(
        F.max("n_words").alias("n_words"), F.count_if(F.col("pass") == 0).alias("copies"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return together.select("doc_id", "row", "n_words", _merged("spans").alias("spans"), "items", "copies").selectExpr(
        "doc_id", "row", "n_words", "spans", "items", "explode(sequence(1L, copies)) AS copy"
    ).drop("copy")


def _merged(spans: str) -> Column:
    """Sorted ranges with those that touch made one."""
    return F.expr(f"""aggregate({spans}, CAST(array() AS array<array<int>>), (out, s) ->
        CASE WHEN size(out) > 0 AND s[0] <= out[size(out) - 1][1]
        THEN concat(slice(out, 1, size(out) - 1), array(array(out[size(out) - 1][0], greatest(out[size(out) - 1][1], s[1]))))
        ELSE concat(out, array(s)) END)""")


def remove_spans(text: str | None, spans: list[list[int]]) -> str | None:
    """``text`` without the given ranges of words, and without what stands between the words of a range."""
    if text is None or not spans:
        return text
    raw = text.encode("utf-8", "replace")
    at = [m.span() for m in WORD.finditer(raw.translate(UPPER))]
    out, end = [], 0
    for first, last in spans:
        out.append(raw[end : at[first][0]])
        end = at[last - 1][1]
    return b"".join([*out, raw[end:]]).decode("utf-8")


def _without_spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column has the spans to cut from ``text``; it goes too."""
    for batch in batches:
        names, columns = batch.schema.names[:-1], batch.columns
        at = names.index("text")
        pairs = zip(columns[at].to_pylist(), columns[-1].to_pylist(), strict=True)
        columns[at] = pa.array([remove_spans(t, s) for t, s in pairs], pa.string())
        yield pa.RecordBatch.from_arrays(columns[:-1], names)


def clean_texts(docs: DataFrame, items: DataFrame, most: float, n: int = WINDOW) -> DataFrame:
    """``docs`` with benchmark spans cut out of ``text``; rows with more than a share ``most`` of hit words go.

    Rows keep their columns; n_chars, if there is one, follows the text where it changed.
    """
    names = docs.columns
    doc_id, row, spans, words = spare(names, "hit_id", "hit_row", "hit_spans", "hit_words")
    found = find_contamination(docs, items, n).filter(F.size("spans") > 0)
    found = settle(
        found.select(
            F.col("doc_id").alias(doc_id), F.col("row").alias(row), F.col("n_words").alias(words),
            F.col("spans").alias(spans),
        ).distinct()
    )
    mine = F.col("doc_id").eqNullSafe(F.col(doc_id)) & (text_key() == F.col(row))
    clean = docs.join(found, mine, "left_anti")
    few = found.filter(F.expr(f"aggregate({spans}, 0L, (a, s) -> a + s[1] - s[0]) <= {most} * {words}"))
    cut = docs.join(few, mine).select(*names, spans).mapInArrow(_without_spans, docs.schema)
    if "n_chars" in names:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*names)
    return clean.unionByName(cut)


def contamination_digest(found: DataFrame) -> DataFrame:
    """The figures of ``find_contamination``: n_hit words, n_items, sha256 of the item ids."""
    return found.select(
        "doc_id", "n_words",
        F.expr("aggregate(spans, 0L, (a, s) -> a + s[1] - s[0])").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
