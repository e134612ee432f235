"""Periodic runs: stretches of words that repeat with a period, found after splitting texts at rare words."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadlens.llm.base import schema_of
from roadlens.llm.words import byte_classes, joined, slices, words_of

#: A run repeats its period so many times at least, and has so many words.
REPEATS = 4
LEAST = 6
# White space between words.
SPACE = byte_classes(b"\x20\x09\x0a\x0b\x0c\x0d")
#: Lags up to which all segments are compared with themselves as one array.
SHORT = 16
#: Pairs of lag and place that are looked at at once.
PAIRS = 1 << 20

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("text", pa.string())])


def split_by_frequency(code: np.ndarray, text: np.ndarray, repeats: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of words that may lie in runs, ascending, and the segment of each.

    A word of a run occurs in it ``repeats`` times at least. So a word that is
    rarer in its segment splits it; segments of fewer than ``least`` words go.
    What is left of a split segment is looked at again, until nothing changes.
    """
    place, segment = np.arange(len(code)), text.astype(np.int64)
    width = int(code.max(initial=0)) + 1
    stable: list[np.ndarray] = []
    while len(place):
        _, group, counts = np.unique(segment * width + code[place], return_inverse=True, return_counts=True)
        often = counts[group] >= repeats
        split = np.bincount(segment, ~often) > 0
        again = split[segment]
        stable.append(place[~again])
        place, segment = place[again & often], segment[again & often]
        if len(place):
            segment = _segments(place, segment)
            long = np.bincount(segment) >= least
            place, segment = place[long[segment]], segment[long[segment]]
    place = np.sort(np.concatenate(stable)) if stable else np.zeros(0, np.int64)
    segment = _segments(place, text[place])
    long = np.bincount(segment, minlength=1) >= least
    return place[long[segment]], segment[long[segment]]


def _segments(place: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Numbers stretches of neighbouring places with the same ``of``."""
    new = np.ones(len(place), bool)
    new[1:] = (np.diff(place) != 1) | (of[1:] != of[:-1])
    return np.cumsum(new) - 1


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and behind last place of stretches of at least ``least`` true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


class LagScan:
    """Runs of an array of words cut into segments: (start, end, period), each with its smallest period.

    ``reach`` holds for each place the furthest end of a run found so far over
    it. Lags ascend, so a stretch inside a known run has that run's smaller
    period and is no run of its own.
    """

    def __init__(self, word: np.ndarray, segment: np.ndarray, repeats: int, least: int) -> None:
        self.word, self.segment, self.repeats, self.least = word, segment, repeats, least
        self.reach = np.zeros(len(word), np.int64)
        self.runs: list[tuple[int, int, int]] = []
        if len(word):
            sizes = np.bincount(segment)
            self._short(sizes)
            begins = np.cumsum(sizes) - sizes
            for s in np.flatnonzero(sizes >= repeats * (SHORT + 1)).tolist():
                self._long(int(begins[s]), int(sizes[s]))

    def _keep(self, start: int, end: int, period: int) -> None:
        if self.reach[start] < end:
            self.runs.append((start, end, period))
            own = self.reach[start:end]
            np.maximum(own, end, out=own)

    def _short(self, sizes: np.ndarray) -> None:
        word, segment, place = self.word, self.segment, np.arange(len(self.word))
        for lag in range(1, SHORT + 1):
            need = max(self.least, self.repeats * lag)
            fits = (sizes >= need)[segment]
            if not fits.all():
                word, segment, place = word[fits], segment[fits], place[fits]
            if len(word) <= lag:
                return
            same = (word[lag:] == word[:-lag]) & (segment[lag:] == segment[:-lag])
            for a, b in zip(*(x.tolist() for x in _stretches(same, need - lag)), strict=True):
                self._keep(int(place[a]), int(place[b - 1]) + lag + 1, lag)

    def _long(self, begin: int, size: int) -> None:
        """Lags above SHORT in one segment.

        A run of period q holds a multiple of q within its first q words, and
        the word there stands ``repeats`` times, q apart. Only such places are
        looked at, size / q for each lag, and extended both ways.
        """
        word, reach = self.word[begin : begin + size], self.reach[begin : begin + size]
        last, lag = size // self.repeats, SHORT + 1
        while lag <= last:
            lags = np.arange(lag, min(last + 1, lag + max(1, PAIRS * lag // size)))
            counts = (size - 1) // lags - (self.repeats - 2)
            q = np.repeat(lags, counts)
            at = (np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts)) * q
            hit = np.ones(len(q), bool)
            for k in range(1, self.repeats):
                hit &= word[at] == word[at + k * q]
                at, q, hit = at[hit], q[hit], hit[hit]
            # with three repeats or more these are all inside the run, as the lag is above SHORT
            for ahead in (1, 2, 3, 5, 8, 13) if self.repeats > 2 else ():
                hit = word[at + ahead] == word[at + ahead + q]
                at, q = at[hit], q[hit]
            for a, p in zip(at.tolist(), q.tolist(), strict=True):
                if reach[a] > begin + a + (self.repeats - 1) * p:
                    continue
                right = p + self._same(word, a, p, 1)
                left = self._same(word, a - 1, p, -1)
                if left + right >= max(self.least, self.repeats * p):
                    self._keep(begin + a - left, begin + a + right, p)
            lag = int(lags[-1]) + 1

    @staticmethod
    def _same(word: np.ndarray, at: int, lag: int, way: int) -> int:
        """How many words from ``at`` on equal those ``lag`` further, going ``way``."""
        here, there = (word[at:-lag], word[at + lag :]) if way > 0 else (word[: at + 1][::-1], word[lag : lag + at + 1][::-1])
        done, step = 0, 64
        n = min(len(here), len(there)) if at >= 0 else 0
        while done < n:
            differ = np.flatnonzero(here[done : min(n, done + step)] != there[done : min(n, done + step)])
            if len(differ):
                return done + int(differ[0])
            done, step = done + step, 2 * step
        return n


def runs_of(code: np.ndarray, text: np.ndarray, repeats: int = REPEATS, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Runs (start, end, period) in the words ``code`` of the texts ``text``, by start, then period."""
    place, segment = split_by_frequency(code, text, repeats, least)
    found = LagScan(code[place], segment, repeats, least).runs
    return sorted((int(place[a]), int(place[b - 1]) + 1, q) for a, b, q in found)


def _finder(repeats: int, least: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            words = words_of(rows.column("text"), SPACE)
            code = np.asarray(words.values.dictionary_encode().indices)
            n = np.diff(words.first)
            runs = np.array(runs_of(code, words.piece, repeats, least), np.int64).reshape(-1, 3)
            kept = np.ones(len(code), bool)
            for a, b, q in runs.tolist():
                kept[a + q : b] = False
            ends = np.append(0, np.cumsum(kept))[words.first]
            left = words.values if kept.all() else words.values.filter(pa.array(kept))
            of_run = np.searchsorted(words.first, runs[:, 0], "right") - 1
            found = pa.StructArray.from_arrays(
                [pa.array(runs[:, 0] - words.first[of_run]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])],
                fields=list(RUN),
            )
            per_text = np.searchsorted(of_run, np.arange(len(n) + 1)).astype(np.int32)
            text = joined(left, ends)
            null = np.asarray(rows.column("text").is_null())
            if null.any():
                text = pa.array([None if m else t for m, t in zip(null.tolist(), text.to_pylist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").cast(pa.int64()), pa.array(n), pa.ListArray.from_arrays(pa.array(per_text), found), text],
                schema=RUNS,
            )

    return find


def periodic_runs(docs: DataFrame, repeats: int = REPEATS, least: int = LEAST) -> DataFrame:
    """Runs of repeating words per row of ``docs`` (doc_id, text), and the text without their repeats.

    Columns: doc_id, n_words, runs (start, length and period in words, by start,
    then period), text (words joined by one space; of each run only the first
    period stays). A run is a stretch of words with smallest period q, at least
    ``repeats`` times q and ``least`` words long, that cannot be extended.

    Each text is split at words that occur too rarely to lie in a run, again
    and again until nothing changes; only what survives is compared with itself
    lag by lag. Rows stay where they are; nothing is shuffled or broadcast. Memory
    is bounded by SLICE bytes of text or the longest text. A null text has no
    words and stays null; an empty one gives an empty text. Repeated rows each
    have their row; an empty table gives none; other columns are ignored.
    """
    if repeats < 2:
        raise ValueError("a run repeats its period twice at least")
    return docs.select("doc_id", "text").mapInArrow(_finder(repeats, least), schema_of(RUNS))
