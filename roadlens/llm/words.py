"""Words of many texts at once, as Arrow arrays; no Python object per word."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text whose words a task holds at once; a longer text is a piece of its own.
SLICE = 1 << 23
WORD, BLANK, BREAK = 0, 1, 2


def byte_classes(blank: bytes, breaks: bytes = b"") -> np.ndarray:
    """Class of each byte: of words, between words, or between pieces of words."""
    classes = np.full(256, WORD, np.uint8)
    classes[list(blank)] = BLANK
    classes[list(breaks)] = BREAK
    return classes


def slices(batches: Iterable[pa.RecordBatch], limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` cut so that ``text`` stays within ``limit`` bytes, if no single text is longer."""
    for batch in batches:
        at = 0
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64))
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


@dataclass
class Words:
    """Words of several texts: their bytes, the first one of each text (and the number of all), the piece of each."""

    values: pa.Array
    first: np.ndarray
    piece: np.ndarray


def words_of(texts: pa.Array, classes: np.ndarray, lower: bool = False) -> Words:
    """Words are runs of bytes of class WORD; a text of BREAK bytes is cut into pieces there. Null has no words.

    With ``lower``, A-Z become a-z.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    at, end = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, np.uint8)[at:end] if end > at else np.zeros(0, np.uint8)
    begins = offsets - at
    kind = classes[raw]
    inside = kind == WORD
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = begins[:-1][begins[:-1] < begins[1:]]
    starts[edges] = inside[edges]
    first_byte = np.flatnonzero(starts)
    first = np.searchsorted(first_byte, begins)
    # a word ends before a byte outside, or where the next text begins
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    stops[edges[1:] - 1] = inside[edges[1:] - 1]
    bounds = np.append(0, np.cumsum(np.flatnonzero(stops) + 1 - first_byte))
    own = raw[inside]
    if lower:
        own = np.where((own >= 65) & (own <= 90), own | np.uint8(32), own)
    values = pa.Array.from_buffers(pa.large_binary(), len(first_byte), [None, pa.py_buffer(bounds), pa.py_buffer(own)])
    piece = np.searchsorted(np.flatnonzero(kind == BREAK), first_byte) + np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(values, first, piece)


def joined(values: pa.Array, first: np.ndarray) -> pa.Array:
    """The words from ``first[i]`` up to ``first[i + 1]``, joined by one space, as texts."""
    lists = pa.LargeListArray.from_arrays(pa.array(first, pa.int64()), values)
    return pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).cast(pa.binary()).view(pa.string())
