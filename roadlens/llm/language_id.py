"""Language identification: a bit-sliced Bloom filter of character n-grams, one bit per language."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.base import pieces, rows_out, schema_of

SIZES = (3, 4)
#: Documents a language is learned from at most, about.
SAMPLE = 4000
#: Slots of the filter for each n-gram of the language that has most, and at least; each is a mask of languages. Each
#: n-gram sets two.
SLOTS_PER_GRAM = 16
LEAST_SLOTS = 1 << 16
UNKNOWN = "und"
FACTOR = np.uint64(0x9E3779B97F4A7C15)

GRAMS = pa.schema([("lang", pa.string()), ("gram", pa.int64())])
SCORED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower case if it is a letter, else a space."""
    table = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            table[i] = ord(c.lower()[0])
    return table


def _codes(texts: list[str], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Letters and spaces of all texts in one array, each text after ``pad`` spaces; where each text starts."""
    gap = " " * pad
    joined = "".join([gap + t for t in texts]) + gap
    starts = np.cumsum([0, *[len(t) + pad for t in texts[:-1]]])
    return _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")], starts


def _grams(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash for the n-gram that starts at each position, and which of them hold a letter and start no run of spaces."""
    n = len(codes) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total *= FACTOR
        total += codes[k : k + n]
        total ^= total >> np.uint64(31)
    total *= FACTOR
    total ^= total >> np.uint64(29)
    space = codes == 32
    return total, ~(space[:n] & space[1 : n + 1])


def _count(sizes: tuple[int, ...]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            langs = np.array(piece["lang"], object)
            for lang in sorted(set(piece["lang"])):
                codes, _ = _codes([piece["text"][i] for i in np.flatnonzero(langs == lang)], max(sizes))
                for size in sizes:
                    grams, real = _grams(codes, size)
                    found = np.unique(grams[real])
                    yield rows_out(GRAMS, {"lang": [lang] * len(found), "gram": found.view(np.int64)})

    return count


def slots_for(grams: int) -> int:
    """A power of two."""
    return max(LEAST_SLOTS, 1 << (SLOTS_PER_GRAM * grams - 1).bit_length()) if grams else LEAST_SLOTS


class Filter:
    """Slots of language masks (64 languages a word), the languages, and each one's rate of false positives.

    ``grams`` are hashes of n-grams, ``where`` the number of the language that
    each is found in; ``usual`` is the number of the language that most texts have.
    """

    def __init__(self, grams: np.ndarray, where: np.ndarray, languages: list[str], slots: int, usual: int = 0) -> None:
        self.languages, self.usual = languages, usual
        self.masks = np.zeros((max(1, -(-len(languages) // 64)), slots), np.uint64)
        for p in self._slots(grams.view(np.uint64)):
            np.bitwise_or.at(self.masks, (where // 64, p), np.uint64(1) << (where % 64).astype(np.uint64))
        full = [self._bit(self.masks[i // 64], i).mean() for i in range(len(languages))]
        self.false = np.array(full) ** 2

    def _slots(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        last = np.uint64(self.masks.shape[1] - 1)
        return grams & last, (grams >> np.uint64(32)) & last

    @staticmethod
    def _bit(masks: np.ndarray, i: int) -> np.ndarray:
        return (masks >> np.uint64(i % 64) & np.uint64(1)).astype(np.int64)

    def counts(self, codes: np.ndarray, starts: np.ndarray, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Per language and text how many n-grams the filter holds, corrected for false positives; n-grams per text."""
        hits, total = np.zeros((len(self.languages), len(starts))), np.zeros(len(starts))
        for size in sizes:
            grams, real = _grams(codes, size)
            total += np.add.reduceat(real.astype(np.int64), starts)
            first, second = self._slots(grams)
            for word, masks in enumerate(self.masks):
                both = masks[first] & masks[second]
                both[~real] = 0
                for i in range(64 * word, min(64 * word + 64, len(self.languages))):
                    hits[i] += np.add.reduceat(self._bit(both, i), starts)
        false = self.false[:, None]
        return np.maximum(0, (hits - false * total) / np.maximum(1 - false, 1e-9)), total


def _predict(shared, sizes: tuple[int, ...]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Filter = shared.value
        for piece in pieces(batches):
            codes, starts = _codes(piece["text"], max(sizes))
            letters = np.add.reduceat((codes != 32).astype(np.int64), starts)
            if model.languages:
                held, _ = model.counts(codes, starts, sizes)
                best = np.argmax(held, axis=0)
                top = held[best, np.arange(len(best))]
                best[top == 0] = model.usual
                rest = np.sort(held, axis=0)[-2] if len(held) > 1 else np.zeros(len(best))
                score = np.where(top > 0, top / np.maximum(top + rest, 1e-12), 1 / len(held))
                langs = [model.languages[b] if n else UNKNOWN for b, n in zip(best, letters, strict=True)]
            else:
                score, langs = np.zeros(len(letters)), [UNKNOWN] * len(letters)
            yield rows_out(SCORED, {
                "doc_id": piece["doc_id"], "lang_pred": langs, "score": np.where(letters > 0, score, 0.0),
            })

    return predict


def learn_languages(labelled: DataFrame, sizes: tuple[int, ...] = SIZES, sample: int = SAMPLE) -> Filter:
    """The filter of the languages of ``labelled`` (doc_id, text, lang).

    Learned from about ``sample`` documents per language at most, chosen by a
    hash of the id; all their n-grams go into the filter, whose slots follow the
    number of them. Rows without a lang are left out; a language of one document
    is learned too, one without letters has no n-grams. What comes to the driver
    is the sample's distinct n-grams, 8 bytes each.
    """
    known = labelled.filter("lang IS NOT NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    sizes_of = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(sizes_of)
    draw = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1_000_000))
    chosen = F.lit(False)
    for lang in languages:
        share = min(1_000_000, math.ceil(1e6 * sample / sizes_of[lang]))
        chosen = chosen | ((F.col("lang") == lang) & (draw < share))
    found = known.filter(chosen).mapInArrow(_count(sizes), schema_of(GRAMS)).distinct()
    number = F.array_position(F.array(*[F.lit(lang) for lang in languages]), F.col("lang")) - 1
    rows = found.select(number.cast("int").alias("where"), "gram").toArrow() if languages else None
    where = np.asarray(rows.column("where"), np.int64) if languages else np.zeros(0, np.int64)
    grams = np.asarray(rows.column("gram"), np.int64) if languages else np.zeros(0, np.int64)
    usual = max(range(len(languages)), key=lambda i: sizes_of[languages[i]], default=0)
    return Filter(grams, where, languages, slots_for(int(np.bincount(where, minlength=1).max())), usual)


def identify(docs: DataFrame, model: Filter, sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """doc_id, lang_pred and score for each row of ``docs`` (doc_id, text).

    Each n-gram is looked up once for all languages; counts per language are
    corrected for its false positives. The language with the most n-grams is
    predicted (ties: the first by name; no n-gram known: the language of most
    texts); score is its share of the best two counts. Null texts and texts without letters are ``und`` with score 0, as is
    all if no language was learned. Repeated rows each get their row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(_predict(shared, sizes), schema_of(SCORED))
