"""Quality classifier: Bradley-Terry scores of documents, learned from preference pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.base import pieces, rows_out, schema_of

#: Labelled documents the scores are learned from at most, and preference pairs drawn from them.
SAMPLE = 12_000
PAIRS = 60_000
ROUNDS = 25
RIDGE = 1e-3
#: The score at which a document is predicted to be good.
CUT = 0.3

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = bytes(range(48, 58))
SYMBOLS = b"#*$%&|<>{}[]\\^~=_@/+"
STOPS = b".,;:?'\"()-"
FEATURES = (
    "log_words", "word_length", "long_words", "upper", "lower", "digits", "symbols", "stops", "bangs", "bars",
    "not_ascii", "distinct_words", "distinct_windows", "adjacent", "log_line", "distinct_lines", "ending", "capital",
    "top_word",
)

MEASURED = pa.schema([("doc_id", pa.int64()), ("features", pa.list_(pa.float64()))])
SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def features(text: str) -> list[float]:
    """Figures of a whole text, in the order of FEATURES; shares of nothing are 0."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n, size = max(1, len(words)), max(1, len(raw))

    def share(chars: bytes) -> float:
        return (len(raw) - len(raw.translate(None, chars))) / size

    lines = [line for line in raw.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    distinct = set(words)
    ascii_size = len(raw.translate(None, bytes(range(128, 256))))
    lengths = sum(map(len, words))
    return [
        float(np.log1p(len(words))), lengths / n, sum(len(w) > 12 for w in words) / n,
        share(UPPER), share(LOWER), share(DIGITS), share(SYMBOLS), share(STOPS), raw.count(b"!") / size,
        raw.count(b"|") / size, 1 - ascii_size / size if raw else 0.0, len(distinct) / n,
        len(set(windows)) / max(1, len(windows)), sum(map(bytes.__eq__, words, words[1:])) / n,
        float(np.log1p(len(words) / max(1, len(lines)))), len(set(lines)) / max(1, len(lines)),
        sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines) / max(1, len(lines)),
        sum(w[:1].isupper() for w in words) / n, sum(len(w) <= 3 for w in words) / n,
    ]


@dataclass
class Ranking:
    """Weights on widened, standardised features; ``cut`` is the score quantile that parts good from bad."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float = 0.0
    scale: float = 1.0

    def widened(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.concatenate([z, z * z], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.widened(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; CUT where the ranking is at ``cut``."""
        return 1 / (1 + np.exp(-np.clip(self.scale * (self.raw(x) - self.cut) + np.log(CUT / (1 - CUT)), -50, 50)))


def fit(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = 7) -> Ranking:
    """Bradley-Terry weights: a good document beats a bad one with the logistic chance of their score difference."""
    model = Ranking(x.mean(axis=0) if len(x) else np.zeros(len(FEATURES)), np.ones(1), np.zeros(2 * len(FEATURES)))
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(better) or not len(worse):
        return model
    model.spread = np.maximum(x.std(axis=0), 1e-9)
    wide = model.widened(x)
    draw = np.random.default_rng(seed)
    d = wide[draw.choice(better, pairs)] - wide[draw.choice(worse, pairs)]
    for _ in range(ROUNDS):  # Newton steps on the mean logistic loss of the differences
        p = 1 / (1 + np.exp(np.clip(d @ model.weights, -50, 50)))
        slope = -(d * p[:, None]).mean(axis=0) + RIDGE * model.weights
        curve = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(d.shape[1])
        step = np.linalg.solve(curve, slope)
        model.weights = model.weights - step
        if np.abs(step).max() < 1e-6:
            break
    raw = model.raw(x)
    model.cut = float(np.quantile(raw, (~good).mean()))
    model.scale = 4 / max(1e-9, float(np.median(raw[better]) - np.median(raw[worse])))
    return model


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        yield rows_out(MEASURED, {"doc_id": piece["doc_id"], "features": [features(t) for t in piece["text"]]})


def _scorer(shared) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            x = np.array([features(t) for t in piece["text"]])
            yield rows_out(SCORED, {"doc_id": piece["doc_id"], "score": shared.value.score(x)})

    return score


def learn_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ranking:
    """A ranking from ``labels`` (doc_id, quality) on texts of ``docs`` (doc_id, text).

    About ``sample`` labelled documents at most, chosen by a hash of the id, are
    measured and brought to the driver. Null labels are left out; of several
    labels of a document the least counts, and of several texts of an id the one
    with the least features. Without both kinds all score alike.
    """
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = known.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < min(1_000_000, round(1e6 * sample / max(1, n)))
    chosen = known.filter(draw)
    texts = docs.select("doc_id", "text").filter(draw).join(chosen.select("doc_id"), "doc_id", "left_semi")
    measured = texts.mapInArrow(_measure, schema_of(MEASURED)).groupBy("doc_id").agg(F.min("features").alias("features"))
    rows = measured.join(chosen, "doc_id").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["features"]))
    x = np.array([r["features"] for r in rows]).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r["quality"] == 1 for r in rows], bool))


def score_quality(docs: DataFrame, model: Ranking) -> DataFrame:
    """doc_id and score (0 to 1) of each row of ``docs`` (doc_id, text); null and empty texts are scored too."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(_scorer(shared), schema_of(SCORED))
