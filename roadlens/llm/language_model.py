"""Language-model scores: smoothed word counts, and a context tree over bytes, both gathered from the corpus.

All words and all grams of bytes count, at every size of the corpus. Frequent ones are broadcast and scored in place,
the others are joined; that share decides where a chance is looked up, never what it is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.base import pieces, rows_out, schema_of
from roadlens.llm.context_tree import CUT, Table, Top, log_chances_below, partial_weights, text_bytes
from roadlens.llm.decontaminate import UPPER
from roadlens.session import settle

#: Chances of grams from this share of the training bytes on, at most 1 / FREQUENT_GRAMS, are broadcast; others are joined.
FREQUENT_GRAMS = 1e-7
#: Words from this share of the training tokens on, at most 1 / FREQUENT, are broadcast; other words are joined.
FREQUENT = 2e-6
#: Distinct words or grams that a task counts before it hands its counts on.
HELD = 400_000
#: The token after the last word of a text; no word is empty.
END = b""

WORDS = pa.schema([("word", pa.binary()), ("n", pa.int64())])
GRAMS = pa.schema([("gram", pa.int64()), ("n", pa.int64())])
SUMS = pa.schema([("node", pa.int64()), ("below", pa.float64())])
CHANCES = pa.schema([("gram", pa.int64()), ("n", pa.int64()), ("chance", pa.float64())])
PARTIAL = pa.schema([
    ("doc_id", pa.int64()), ("part", pa.int32()), ("row", pa.int64()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
    ("rare", pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
    ("rare_grams", pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int64())]))),
])


def normal(text: str) -> bytes:
    return text.encode("utf-8", "replace").translate(UPPER)


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()
    for piece in pieces(batches):
        for text in piece["text"]:
            held.update(normal(text).split())
        held[END] += len(piece["text"])
        if len(held) > HELD:
            yield rows_out(WORDS, {"word": list(held), "n": list(held.values())})
            held.clear()
    yield rows_out(WORDS, {"word": list(held), "n": list(held.values())})


def _count_grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        grams, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return grams, np.bincount(back, np.concatenate([n for _, n in parts])).astype(np.int64)

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for piece in pieces(batches):
        held.append(np.unique(text_bytes([normal(t) for t in piece["text"]])[0], return_counts=True))
        if sum(len(g) for g, _ in held) > 4 * HELD:
            held = [merged(held)]
            if len(held[0][0]) > 2 * HELD:
                yield rows_out(GRAMS, {"gram": held[0][0].view(np.int64), "n": held[0][1]})
                held = []
    if held:
        grams, n = merged(held)
        yield rows_out(GRAMS, {"gram": grams.view(np.int64), "n": n})


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams and counts, in pieces that hold all that follow their last CUT context bytes; rows come ordered by those."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size, limit = 0, HELD
    for batch in batches:
        held.append((batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size >= limit:
            grams, n = (np.concatenate(x) for x in zip(*held, strict=True))
            last = grams >> np.uint64(8) & np.uint64((1 << 8 * CUT) - 1)
            end = int(np.searchsorted(last, last[-1]))
            if end:
                yield grams[:end], n[:end]
            held, size = [(grams[end:], n[end:])], size - end
            limit = max(HELD, 2 * size)
    if size:
        grams, n = (np.concatenate(x) for x in zip(*held, strict=True))
        yield grams, n


def _sum_below(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for grams, n in _parts(batches):
        node, below = partial_weights(grams, n)
        yield rows_out(SUMS, {"node": node.view(np.int64), "below": below})


def _dealt(grams: DataFrame) -> DataFrame:
    """(gram, n) with all of one last CUT context bytes in one task, in their order."""
    last = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * CUT) - 1)).alias("last")
    return grams.select("gram", "n", last).repartition("last").sortWithinPartitions("last").select("gram", "n")


def _chances(grams: DataFrame, top: Top) -> DataFrame:
    """``grams`` (gram, n; all of the corpus, and with n = 0 others) with the log10 of the chance of the last byte."""
    shared = grams.sparkSession.sparkContext.broadcast(top)

    def chances(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, n in _parts(batches):
            chance = log_chances_below(found, n, shared.value) / np.log(10)
            yield rows_out(CHANCES, {"gram": found.view(np.int64), "n": n, "chance": chance})

    return _dealt(grams).mapInArrow(chances, schema_of(CHANCES))


@dataclass
class Model:
    """Counts and chances of frequent words and grams, totals, and the tree's top; the others' stay in tables."""

    frequent: dict[bytes, int]
    tokens: int
    distinct: int
    grams: Table
    top: Top


def learn(docs: DataFrame) -> tuple[Model, DataFrame, DataFrame]:
    """The model of the texts of ``docs`` (text), the words too rare to broadcast (word, c), all grams (gram, n, chance).

    All words and all 6-grams of bytes are counted, in tasks and then by shuffle. The tree of all grams is weighed in
    tasks that each hold the contexts of some last CUT bytes, then the shorter contexts from their summed weights.
    What comes to the driver is bounded by FREQUENT, by FREQUENT_GRAMS and by the number of possible 3-grams.
    """
    texts = docs.select("text")
    words = texts.mapInArrow(_count_words, schema_of(WORDS)).groupBy("word").agg(F.sum("n").alias("c"))
    words = settle(words.filter("c > 0"))
    total = words.agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()[0]
    tokens, distinct = total["n"] or 0, total["v"]
    often = words.filter(F.col("c") >= max(1.0, FREQUENT * tokens)).collect()
    frequent = {bytes(r["word"]): r["c"] for r in often}

    grams = texts.mapInArrow(_count_grams, schema_of(GRAMS)).groupBy("gram").agg(F.sum("n").alias("n"))
    grams = settle(grams)
    size = grams.agg(F.sum("n")).collect()[0][0] or 0
    below = _dealt(grams).mapInArrow(_sum_below, schema_of(SUMS)).groupBy("node").agg(F.sum("below").alias("below"))
    below = below.toArrow()
    short = grams.groupBy(F.col("gram").bitwiseAND(F.lit((1 << 8 * CUT) - 1)).alias("gram"))
    short = short.agg(F.sum("n").alias("n")).toArrow()
    top = Top(
        short["gram"].to_numpy().astype(np.uint64), short["n"].to_numpy(),
        below["node"].to_numpy().astype(np.uint64), below["below"].to_numpy(),
    )
    chances = settle(_chances(grams, top))
    held = chances.filter(F.col("n") >= max(1.0, FREQUENT_GRAMS * size)).select("gram", "chance").toArrow()
    table = Table(held["gram"].to_numpy().astype(np.uint64) + np.uint64(1), held["chance"].to_numpy())
    model = Model(frequent, tokens, distinct, table, top)
    return model, words.filter(F.col("c") < max(1.0, FREQUENT * tokens)), chances


def _rare_grams(grams: np.ndarray, starts: np.ndarray, at: np.ndarray) -> list[list[dict]]:
    """Per text, those of its ``grams`` at ``at``, each with its count."""
    text = np.searchsorted(starts, at, "right") - 1
    order = np.lexsort((grams[at], text))
    text, found = text[order], grams[at][order]
    first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (found[1:] != found[:-1])])[: len(at)])
    n = np.diff(np.append(first, len(at)))
    out: list[list[dict]] = [[] for _ in range(len(starts))]
    for t, gram, count in zip(text[first].tolist(), found[first].tolist(), n.tolist(), strict=True):
        out[t].append({"gram": gram, "n": count})
    return out


def _scorer(shared) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        part, row = TaskContext.get().partitionId(), 0
        scale = np.log10(model.tokens + 0.5 * (model.distinct + 1))
        logs = {w: (np.log10(c + 0.5) - scale).item() for w, c in model.frequent.items()}
        for piece in pieces(batches):
            texts = [normal(t) for t in piece["text"]]
            grams, starts, _ = text_bytes(texts)
            chances = model.grams.get(grams + np.uint64(1)).astype(float)
            unheld = np.isnan(chances)
            tree = np.add.reduceat(np.where(unheld, 0.0, chances), starts)
            others = _rare_grams(grams, starts, np.flatnonzero(unheld))
            out: dict[str, list] = {name: [] for name in PARTIAL.names}
            for doc_id, text, from_tree, unlike in zip(piece["doc_id"], texts, tree.tolist(), others, strict=True):
                tokens = [*text.split(), END]
                found = [logs.get(w) for w in tokens]
                rare = Counter([w for w, x in zip(tokens, found, strict=True) if x is None])
                known = [x for x in found if x is not None]
                listed = [{"word": w, "n": n} for w, n in rare.items()]
                values = (doc_id, part, row, len(tokens), len(known), sum(known), from_tree, listed, unlike)
                for name, value in zip(PARTIAL.names, values, strict=True):
                    out[name].append(value)
                row += 1
            yield rows_out(PARTIAL, out)

    return score


def score_texts(docs: DataFrame, model: Model, rare: DataFrame, grams: DataFrame) -> DataFrame:
    """Scores of each row of ``docs`` (doc_id, text); null text counts as empty.

    Columns: doc_id, n_tokens, n_known, train_tokens, base_score (log10 of the
    smoothed word chances) and score (log10 of the tree's chance of the text's
    bytes, A-Z in lower case, and its end).
    Frequent words and grams are scored in place; the others, of which no single
    one is frequent in training, are joined with their counts or chances; grams
    that training never saw get theirs from the tree first. Repeated rows each
    get their row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    partial = settle(docs.select("doc_id", "text").mapInArrow(_scorer(shared), schema_of(PARTIAL)))
    scale = float(np.log10(model.tokens + 0.5 * (model.distinct + 1)))
    term = F.col("n") * (F.log10(F.coalesce("c", F.lit(0)) + 0.5) - scale)
    words = partial.select("part", "row", F.inline("rare")).join(rare, "word", "left")
    sums = words.groupBy("part", "row").agg(
        F.sum(term).alias("rare_score"), F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("rare_known")
    )
    listed = partial.select("part", "row", F.inline("rare_grams")).withColumnRenamed("n", "times")
    new = listed.select("gram").distinct().join(grams, "gram", "left_anti").withColumn("n", F.lit(0).cast("long"))
    unseen = settle(_chances(grams.select("gram", "n").unionByName(new), model.top).filter("n = 0"))
    found = listed.join(grams.unionByName(unseen).select("gram", "chance"), "gram")
    others = found.groupBy("part", "row").agg(F.sum(F.col("times") * F.col("chance")).alias("rare_chances"))
    joined = partial.drop("rare", "rare_grams").join(sums, ["part", "row"], "left").join(others, ["part", "row"], "left")
    return joined.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rare_chances", F.lit(0.0))).alias("score"),
    )
