"""Phrase collocations by set-oriented mining: occurrence relations are joined with themselves, counted and thinned.

A relation R(k) holds the phrases of k words at each place of the corpus, in
order of piece and place. It is kept in chunks of whole texts, so places that
are next to each other lie in one chunk, and the merge join of R(k) with itself
on neighbouring places moves no row. Only the groups, the distinct phrases of
each chunk with their counts, are shuffled: to be added up, and back to their
chunks, where the semi join thins the relation to frequent phrases before the
next length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.base import schema_of
from roadlens.llm.words import byte_classes, slices, words_of
from roadlens.session import discard, settle

LEAST = 100
LONGEST = 5
TOP = 2000
#: A phrase goes if a longer one around it has so many percent of its occurrences.
COVERED = 100
#: Candidates of a language that one task ranks at a time, about.
RANKED = 50_000
#: Frequent phrases of a length that are broadcast to thin a relation, some 50 bytes each; of more, groups are shuffled.
MOST_FREQUENT = 500_000
CHUNK = 1 << 23
ROWS = 100_000
# What separates pieces, and words in them.
MARKS = byte_classes(b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d")
NO_LANGUAGE = "und"

#: A relation: a row per phrase of a chunk (its code there and its count), and one with the codes at all places.
WORDS = pa.schema([
    ("chunk", pa.int64()), ("code", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()),
    ("places", pa.binary()),
])
PAIRS = pa.schema([
    ("chunk", pa.int64()), ("code", pa.int64()), ("first", pa.int64()), ("second", pa.int64()), ("n", pa.int64()),
    ("places", pa.binary()),
])


def _relation(schema: pa.Schema, chunk: int, groups: dict[str, pa.Array], places: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """The rows of one chunk; ``places`` holds a code or -1 per place, and is left out with the last length."""
    n = len(groups["n"])
    own = {"chunk": pa.array(np.full(n, chunk)), "code": pa.array(np.arange(n)), "places": pa.nulls(n, pa.binary()), **groups}
    rows = pa.RecordBatch.from_arrays([own[f.name].cast(f.type) for f in schema], schema=schema)
    for at in range(0, n, ROWS):
        yield rows.slice(at, ROWS)
    if places is not None:
        kept = places >= 0
        kept[1:] |= places[:-1] >= 0  # of neighbouring places without a phrase one says enough
        one = {"chunk": chunk, "places": places[kept].astype("<i4").tobytes()}
        yield pa.RecordBatch.from_pylist([one], schema=schema)


def _occurrences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """R(1): the words of each chunk of texts by language, and where they stand; pieces are parted by a -1."""
    chunk = TaskContext.get().partitionId() << 32
    for rows in slices(batches, CHUNK):
        words = words_of(rows.column("text"), MARKS, lower=True)
        known = words.values.dictionary_encode()
        languages = pc.fill_null(rows.column("lang"), NO_LANGUAGE).dictionary_encode()
        width = len(known.dictionary)
        key = np.repeat(np.asarray(languages.indices, np.int64), np.diff(words.first)) * width + np.asarray(known.indices)
        groups, code, n = np.unique(key, return_inverse=True, return_counts=True)
        new = np.flatnonzero(np.diff(words.piece)) + 1
        word = known.dictionary.take(pa.array(groups % max(1, width))).cast(pa.binary()).view(pa.string())
        lang = languages.dictionary.take(pa.array(groups // max(1, width)))
        yield from _relation(WORDS, chunk, {"lang": lang, "word": word, "n": pa.array(n)}, np.insert(code, new, -1))
        chunk += 1


def _extend(keep: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """R(k + 1) from R(k): per chunk the frequent phrases (code, id), then the places, which come last."""

    def chunk_of(chunk: int, code: np.ndarray, ids: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
        number = np.full(max(places.max(initial=0), code.max(initial=0)) + 2, -1)  # the last one is that of -1
        number[code] = np.arange(len(code))
        now = number[places]  # semi join
        both = (now[:-1] >= 0) & (now[1:] >= 0)  # merge join on neighbouring places
        key = now[:-1][both] * len(code) + now[1:][both]
        groups, new, n = np.unique(key, return_inverse=True, return_counts=True)
        if len(groups):
            there = np.full(len(both), -1)
            there[both] = new
            pairs = {"first": ids[groups // len(code)], "second": ids[groups % len(code)], "n": n}
            yield from _relation(PAIRS, chunk, {k: pa.array(v) for k, v in pairs.items()}, there if keep else None)

    def extend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            places = batch.column("places")
            code, ids = (np.asarray(pc.fill_null(batch.column(c), -1)) for c in ("code", "id"))
            at = 0
            for end in np.flatnonzero(np.asarray(places.is_valid())).tolist():
                held.append((code[at:end], ids[at:end]))
                own = [np.concatenate(x) for x in zip(*held, strict=True)]
                yield from chunk_of(batch.column("chunk")[end].as_py(), *own, np.frombuffer(places[end].as_buffer(), "<i4"))
                held, at = [], end + 1
            held.append((code[at:].copy(), ids[at:].copy()))

    return extend


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, covered: int = COVERED, top: int = TOP
) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words per language of ``docs`` (lang, text), by the worst of their cuts.

    Columns: lang, rank (from 1), phrase, a, l, r, n, score. a, l and r count
    the phrase, its first part and the rest, n all words of the language; the
    score is floor(1000 a n / (l r)), exactly, of the lowest-scoring cut (ties:
    the smallest first part). Phrases found fewer than ``least`` times are no
    candidates; those inside a longer candidate with ``covered`` percent of their
    count are left out. Ties rank by a, descending, then phrase.

    Words are in lower case (A-Z), runs without space or tab in the pieces between
    stops and line ends. A null text counts as empty, a null language as 'und';
    repeated rows count each; an empty table gives no rows; other columns are
    ignored. A chunk holds up to CHUNK bytes of whole texts, or one longer text,
    which bounds a task. Nothing is sent to the driver; frequent phrases are
    broadcast up to MOST_FREQUENT and joined by a shuffle beyond. Relations are
    written to the shared folder, and deleted when the next length is there.
    """
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    relation = settle(docs.select("lang", "text").mapInArrow(_occurrences, schema_of(WORDS)))
    words = settle(relation.groupBy("lang").agg(F.sum("n").cast("decimal(16,0)").alias("words")))
    keys, levels = ["lang", "word"], []
    for k in range(1, longest + 1):
        groups = relation.filter("code IS NOT NULL").select("chunk", "code", *keys, "n")
        frequent = groups.groupBy(*keys).agg(F.sum("n").alias("a")).filter(F.col("a") >= least)
        # 8 times a row number and the length: one number for each phrase of any length
        frequent = settle(frequent.withColumn("id", F.monotonically_increasing_id() * 8 + k))
        levels.append(frequent)
        if k < longest:
            thin = F.broadcast(frequent) if frequent.count() <= MOST_FREQUENT else frequent
            known = groups.join(thin, keys).select("chunk", "code", "id", F.lit(None).cast("binary").alias("places"))
            none = F.lit(None).cast("long")
            places = relation.filter("places IS NOT NULL").select("chunk", none.alias("code"), none.alias("id"), "places")
            dealt = known.unionByName(places).repartition("chunk").sortWithinPartitions("chunk", F.col("code").asc_nulls_last())
            longer = settle(dealt.mapInArrow(_extend(k + 1 < longest), schema_of(PAIRS)))
            keys = ["first", "second"]
            discard(relation)
            relation = longer
    discard(relation)
    phrases = _phrases(levels)
    scored = settle(_scored(reduce(DataFrame.unionByName, phrases), words, covered))
    found = settle(_ranked(scored, top))
    for df in (*levels, *phrases, words, scored):
        discard(df)
    return found


def _phrases(levels: list[DataFrame]) -> list[DataFrame]:
    """Phrases of two and more words by length: lang, words, a, id, counts of their first and last 1, 2, ... words, phrases
    inside. Each length is written, as the next one reads it twice."""
    known = levels[0].select(
        "id", "lang", F.array("word").alias("words"), F.array("a").alias("head"), F.array("a").alias("tail"),
        F.expr("CAST(array() AS array<bigint>)").alias("inside"),
    )
    out = []
    for k, level in enumerate(levels[1:], 1):
        left = known.select(F.col("id").alias("first"), "lang", "words", "head", F.col("inside").alias("left_inside"))
        right = known.select(
            F.col("id").alias("second"), F.element_at("words", -1).alias("word"), "tail", F.col("inside").alias("right_inside")
        )
        inside = F.array_union("left_inside", "right_inside")
        joined = level.join(left, "first").join(right, "second").select(
            "id", "a", "lang", F.concat("words", F.array("word")).alias("words"), F.concat("head", F.array("a")).alias("head"),
            F.concat("tail", F.array("a")).alias("tail"),
            (F.array_union(inside, F.array("first", "second")) if k > 1 else inside).alias("inside"),
        )
        known = settle(joined)
        out.append(known)
    return out


def _scored(phrases: DataFrame, words: DataFrame, covered: int) -> DataFrame:
    """Phrases that no longer one covers, with their lowest-scoring cut."""
    around = phrases.select(F.explode("inside").alias("id"), F.col("a").alias("longer"))
    around = around.groupBy("id").agg(F.max("longer").alias("longer"))
    free = phrases.join(around, "id", "left").filter(f"longer IS NULL OR 100 * longer < {covered} * a")
    # 1000 a n stays exact up to 10^16 words
    cuts = """array_min(transform(sequence(1, size(words) - 1), k -> struct(
        CAST(1000 AS decimal(4,0)) * CAST(a AS decimal(16,0)) * n
            div (CAST(head[k - 1] AS decimal(18,0)) * CAST(tail[size(words) - k - 1] AS decimal(18,0))) AS score,
        k AS k, head[k - 1] AS l, tail[size(words) - k - 1] AS r)))"""
    return free.join(words.withColumnRenamed("words", "n"), "lang").withColumn("cut", F.expr(cuts)).select(
        "lang", F.concat_ws(" ", "words").alias("phrase"), "a", "cut.l", "cut.r", F.col("n").cast("long").alias("n"), "cut.score"
    )


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each language; the best of each part of a language go on, so no task ranks a whole one."""
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = max(1, scored.count() // RANKED)
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    nth = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))
    first = scored.withColumn("part", part).withColumn("nth", nth).filter(F.col("nth") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best))
    return first.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def collocations_sql(least: int = LEAST, longest: int = LONGEST, covered: int = COVERED, top: int = TOP) -> str:
    """What ``collocations`` returns for ``documents``, plainly: all phrases written out and counted."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
    WITH pieces AS (
        SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang,
            unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), lists AS (
        SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
    ), places AS (
        SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM lists
    ), grams AS (
        SELECT lang, words[i : i + k - 1] AS words, count(*) AS a
        FROM places, range(1, {longest + 1}) AS sizes(k)
        WHERE i + k - 1 <= len(words)
        GROUP BY ALL HAVING count(*) >= {least}
    ), totals AS (
        SELECT lang, sum(len(words)) AS n FROM lists GROUP BY lang
    ), cuts AS (
        SELECT c.lang, c.words, c.a, k, l.a AS l, r.a AS r, t.n,
            (1000::HUGEINT * c.a * t.n) // (l.a::HUGEINT * r.a) AS score
        FROM grams c, range(1, {longest}) AS sizes(k), grams l, grams r, totals t
        WHERE k < len(c.words) AND l.lang = c.lang AND r.lang = c.lang AND t.lang = c.lang
            AND l.words = c.words[1:k] AND r.words = c.words[k + 1 : len(c.words)]
    ), scored AS (
        SELECT lang, words, a, l, r, n, score FROM cuts
        QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
    ), inside AS (
        SELECT lang, words[i : i + k - 1] AS words, max(a) AS longer
        FROM grams, range(2, {longest}) AS sizes(k), range(1, {longest}) AS starts(i)
        WHERE k < len(words) AND i + k - 1 <= len(words)
        GROUP BY ALL
    ), free AS (
        SELECT s.lang, array_to_string(s.words, ' ') AS phrase, s.a, s.l, s.r, s.n, s.score
        FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.words = s.words
        WHERE i.longer IS NULL OR 100 * i.longer < {covered} * s.a
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
        a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
    FROM free QUALIFY rank <= {top}
    """
