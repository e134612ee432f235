"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets decide."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.base import pieces, rows_out, schema_of, text_key
from roadlens.llm.components import components
from roadlens.llm.decontaminate import UPPER
from roadlens.session import settle

WORDS = 5
SIMILARITY = 0.8
#: At most this share of pairs at exactly SIMILARITY may share no band.
MISSED = 1e-4
ROWS = 6
#: N-grams of the sets that one task compares with each other at a time (8 bytes each), if no single set is larger.
BLOCK_GRAMS = 500_000
#: What a set counts besides its n-grams, so that a block of short ones stays small too.
SET_GRAMS = 200
REMEMBERED = 500_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)

SIGNED = pa.schema([
    ("doc_id", pa.int64()), ("row", pa.int64()), ("key", pa.binary()), ("grams", pa.int64()),
    ("bands", pa.list_(pa.int64())),
])
SETS = pa.schema([
    ("node", pa.binary()), ("part", pa.binary()), ("block", pa.int32()), ("blocks", pa.int32()), ("set", pa.binary()),
])
FOUND = pa.schema([("node", pa.binary()), ("other", pa.binary()), ("links", pa.int64())])


def bands_for(similarity: float, rows: int = ROWS, missed: float = MISSED) -> int:
    """Bands of ``rows`` minhashes each, so that a pair at ``similarity`` shares one with chance 1 - ``missed``."""
    return int(np.ceil(np.log(missed) / np.log1p(-(similarity**rows))))


class _Hashes(dict):
    """Word hashes, each worked out once."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_sets(texts: list[str], n: int, known: dict) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct n-grams; a text of fewer words has one gram, an empty one none.

    Words are runs without ASCII white space, with A-Z in lower case.
    """
    out = []
    for text in texts:
        words = text.encode("utf-8", "replace").translate(UPPER).split()
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(n, len(words))
        total = np.zeros(len(words) - size + 1 if size else 0, np.uint64)
        for k in range(size):
            total = _mix(total * FACTOR + hashes[k : k + len(total)])
        out.append(np.unique(total + np.uint64(size)))
    if len(known) > REMEMBERED:
        known.clear()
    return out


def _signer(n: int, bands: int, rows: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = np.random.default_rng(7)
        odd = seeds.integers(1, 1 << 32, bands * rows, np.uint32) | np.uint32(1)
        add = seeds.integers(0, 1 << 32, bands * rows, np.uint32)
        known = _Hashes()
        for piece in pieces(batches):
            sets = gram_sets(piece["text"], n, known)
            sizes = np.array([len(s) for s in sets])
            held = np.flatnonzero(sizes)
            low = (np.concatenate([sets[i] for i in held]) >> np.uint64(32)).astype(np.uint32) if len(held) else None
            starts = np.cumsum(sizes[held]) - sizes[held]
            banded = np.zeros((len(held), bands), np.uint64)
            for k in range(bands * rows if len(held) else 0):
                least = np.minimum.reduceat((low ^ add[k]) * odd[k], starts).astype(np.uint64)
                banded[:, k // rows] = _mix(banded[:, k // rows] * FACTOR + least + np.uint64(k // rows + 1))
            lists: list = [None] * len(sets)
            for i, b in zip(held.tolist(), banded.view(np.int64).tolist(), strict=True):
                lists[i] = b
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield rows_out(
                SIGNED,
                {"doc_id": piece["doc_id"], "row": piece["row"], "key": keys, "grams": sizes.tolist(), "bands": lists},
            )

    return sign


def _with_sets(n: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def with_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for piece in pieces(batches):
            piece["set"] = [s.tobytes() for s in gram_sets(piece["text"], n, known)]
            yield rows_out(SETS, piece)

    return with_sets


def _verifier(similarity: float) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per run of rows of one (part, pair): links between the sets of its one or two blocks.

    Gives, per set with links, how many it has here and the least set it is
    connected to here; never the pairs themselves.
    """

    def links(rows: list[dict]) -> dict[str, list]:
        rows = sorted({r["node"]: r for r in rows}.values(), key=lambda r: (len(r["set"]), r["node"]))
        sets = [np.frombuffer(r["set"], np.uint64) for r in rows]
        sizes = np.array([len(s) for s in sets])
        grams, flat = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(sizes)
        crossing = len(set(rows[0]["pair"].split())) > 1  # a block may have no rows here
        block = np.array([r["block"] for r in rows])
        count, root = np.zeros(len(rows), np.int64), list(range(len(rows)))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        mark = np.zeros(len(grams), bool)
        for x in range(len(rows)):
            # longer sets that are short enough to be similar, of the other block if there are two
            last = int(np.searchsorted(sizes, sizes[x] / similarity + 1e-9, "right"))
            if last <= x + 1:
                continue
            at = int(ends[x])
            own = flat[at - sizes[x] : at]
            mark[own] = True
            shared = np.add.reduceat(mark[flat[at : int(ends[last - 1])]], ends[x : last - 1] - at)
            mark[own] = False
            union = sizes[x] + sizes[x + 1 : last] - shared
            near = shared >= similarity * union - 1e-9
            if crossing:
                near &= block[x + 1 : last] != block[x]
            for y in (np.flatnonzero(near) + x + 1).tolist():
                count[x] += 1
                count[y] += 1
                a, b = top(x), top(y)
                root[max(a, b)] = min(a, b)
        least: dict[int, bytes] = {}
        for i, r in enumerate(rows):
            least[top(i)] = min(least.get(top(i), r["node"]), r["node"])
        linked = np.flatnonzero(count).tolist()
        return {
            "node": [rows[i]["node"] for i in linked], "other": [least[top(i)] for i in linked],
            "links": count[linked].tolist(),
        }

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if (key := (r["part"], r["pair"])) != now:
                    if len(rows) > 1:
                        yield rows_out(FOUND, links(rows))
                    now, rows = key, []
                rows.append(r)
        if len(rows) > 1:
            yield rows_out(FOUND, links(rows))

    return verify


def ngram_join(docs: DataFrame, n: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Near duplicates among ``docs`` (doc_id, text): one row per row.

    Columns: doc_id, row (hash of the text), copy_id, class_id, n_links, grams, first.
    Texts with the same set of word n-grams are copies; copy_id is the least
    doc_id among them. Two sets are linked if their Jaccard similarity is at
    least ``similarity``; n_links counts the other sets that a text's set is
    linked to; class_id is the least doc_id of all that links connect. first marks the row of each class with
    the least doc_id and then row, nulls last, and its equals.

    MinHash bands shuffle one short row per set and band; equal band hashes hang
    sets on the least one of their bucket, which gives groups of candidates, not
    pairs. Within a group, full sets are compared in blocks of bounded size, each
    pair of blocks in one task, and counted where they are compared. So the
    recall of the bands is a lower bound: sets that share no band are compared
    too, if others join them.

    Null and empty texts have no n-grams, are nobody's copy and have no links.
    Equal rows are copies. Null doc_ids are allowed; a class without any other
    id has a null class_id. Other columns are not read.
    """
    bands = bands_for(similarity)
    texts = docs.select("doc_id", text_key().alias("row"), "text")
    signed = settle(texts.mapInArrow(_signer(n, bands, ROWS), schema_of(SIGNED)))
    nodes = settle(
        signed.filter("key IS NOT NULL").groupBy(F.col("key").alias("node")).agg(
            F.min("doc_id").alias("copy_id"),
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row", "grams", "bands")).alias("one"),
        ).select("node", "copy_id", "one.doc_id", "one.row", "one.grams", "one.bands")
    )
    banded = nodes.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least != most")
    hung = banded.join(shared.select("band", "least"), "band").select(F.col("node").alias("u"), F.col("least").alias("v"))
    grouped = settle(components(settle(hung.filter("u != v").distinct())))
    members = grouped.select("node", F.col("root").alias("part")).join(nodes.drop("bands", "copy_id"), "node")
    members = settle(members)
    weight = F.col("grams") + SET_GRAMS
    sizes = members.groupBy("part").agg(F.sum(weight).alias("total"), F.max(weight).alias("largest"))
    blocks = F.ceil(F.col("total") / F.greatest(F.lit(BLOCK_GRAMS), F.col("largest"))).cast("int")
    placed = members.join(sizes.select("part", blocks.alias("blocks")), "part").select(
        "node", "part", "doc_id", "row", "blocks",
        F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int").alias("block"),
    )
    found = texts.alias("t").join(
        placed.alias("p"), F.col("t.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("t.row") == F.col("p.row"))
    ).select("p.node", "p.part", "p.block", "p.blocks", "t.text")
    sets = found.mapInArrow(_with_sets(n), schema_of(SETS))
    pairs = sets.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "part", "block", "set",
        F.concat_ws(" ", F.least("block", "with").cast("string"), F.greatest("block", "with").cast("string")).alias("pair"),
    )
    compared = pairs.repartition("part", "pair").sortWithinPartitions("part", "pair")
    links = settle(compared.mapInArrow(_verifier(similarity), schema_of(FOUND)))
    counts = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    joined = components(links.select(F.col("node").alias("u"), F.col("other").alias("v")))
    classes = nodes.select("node", "copy_id", "doc_id", "row").join(joined, "node", "left").join(counts, "node", "left")
    classes = settle(classes.withColumn("root", F.coalesce("root", "node")))
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("least")
    ids = classes.groupBy("root").agg(F.min("copy_id").alias("class_id"), least)
    classes = classes.join(ids, "root").select(
        "node", "copy_id", "class_id", "n_links", F.col("least.doc_id").alias("least_id"), F.col("least.row").alias("least_row")
    )
    first = F.col("key").isNull() | F.col("doc_id").eqNullSafe(F.col("least_id")) & (F.col("row") == F.col("least_row"))
    return signed.join(classes, signed.key == classes.node, "left").select(
        "doc_id", "row", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), "grams", first.alias("first"),
    )


def ngram_join_sql(documents: str = "documents", n: int = WORDS, similarity: float = SIMILARITY) -> str:
    """DuckDB SQL of ``ngram_join`` (without row and first): all pairs that share an n-gram, no bands."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(string_split_regex({lower}, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM {documents}),
g AS (
  SELECT r, doc_id, list_sort(list_distinct(list_transform(
      range(1, len(words) - least({n}, len(words)) + 2),
      lambda i: array_to_string(words[i:i + least({n}, len(words)) - 1], ' ')))) AS grams
  FROM w WHERE len(words) > 0),
c AS (
  SELECT md5(array_to_string(grams, chr(10))) AS k, any_value(grams) AS grams, min(doc_id) AS copy_id FROM g GROUP BY k),
f AS (SELECT k, len(grams) AS size, unnest(grams) AS gram FROM c),
pairs AS (
  SELECT a.k AS x, b.k AS y FROM f a JOIN f b ON a.gram = b.gram AND a.k <> b.k
  GROUP BY a.k, b.k, a.size, b.size HAVING count(*) >= {similarity} * (a.size + b.size - count(*)) - 1e-9),
reach(x, y) AS (SELECT k, k FROM c UNION SELECT reach.x, pairs.y FROM reach JOIN pairs ON reach.y = pairs.x),
root AS (SELECT x AS k, min(copy_id) AS class_id FROM reach JOIN c ON reach.y = c.k GROUP BY x),
links AS (SELECT x AS k, count(*) AS n FROM pairs GROUP BY x),
own AS (SELECT r, md5(array_to_string(grams, chr(10))) AS k, len(grams) AS n FROM g)
SELECT w.doc_id, coalesce(c.copy_id, w.doc_id) AS copy_id, coalesce(root.class_id, w.doc_id) AS class_id,
  coalesce(links.n, 0)::BIGINT AS n_links, coalesce(own.n, 0)::BIGINT AS grams
FROM w LEFT JOIN own USING (r) LEFT JOIN c USING (k) LEFT JOIN root USING (k) LEFT JOIN links USING (k)"""
