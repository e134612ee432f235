"""Periodic runs, phrase collocations and best-fit packing against plain Python, and on unusual rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from compare import connect, differences
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadlens.llm import best_fit, collocations, period_runs
from roadlens.llm.queries import QUERIES
from roadlens.llm.words import byte_classes, joined, slices, words_of

SCHEMA = "doc_id long, text string, lang string, row string, n string, code string, a string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty texts, a text of several MB, repeated rows, columns that bear names used inside."""
    return made(spark, [
        (1, None, "en"), (2, "", None), (3, "a b " * 40, "en"), (3, "a b " * 40, "en"), (None, "c d e", "en"), (4, " \t\n ", "de"),
        (5, "é " * 3000 + "x y z. " * 500_000, None), (6, "\x00 \x1c\x85 a", "en"),
    ])


def documents() -> dict[int, str]:
    rows = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def plain_runs(words: list, repeats: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    found = []
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            s, e = i, j + q
            if j > i and e - s >= max(least, repeats * q) and not any(a <= s and e <= b for a, b, _ in found):
                found.append((s, e, q))
            i = j + 1
    return sorted(found)


def test_words_of_slices():
    texts = pa.array(["a  b", None, "", " C,d.\ne", "ünü x", "x" * 50, "."])
    batch = pa.RecordBatch.from_arrays([texts], names=["text"]).slice(0, 7)
    found = words_of(batch.slice(2).column("text"), byte_classes(b" ", b".,\n"), lower=True)
    assert [v.decode() for v in found.values.to_pylist()] == ["c", "d", "e", "ünü", "x", "x" * 50]
    assert found.first.tolist() == [0, 0, 3, 5, 6, 6]
    assert len(set(found.piece.tolist())) == 5 and found.piece[3] == found.piece[4]
    assert joined(found.values, found.first).to_pylist() == ["", "c d e", "ünü x", "x" * 50, ""]
    cut = list(slices([batch], 8))
    assert [r for b in cut for r in b.column("text").to_pylist()] == texts.to_pylist() and len(cut) > 3


@pytest.mark.parametrize("repeats,least", [(4, 6), (2, 2), (3, 10)])
def test_runs_of_made_words_equal_plain_search(repeats, least):
    draw = random.Random(repeats)
    for _ in range(150):
        texts = []
        for _ in range(draw.randint(1, 4)):
            words = []
            while len(words) < draw.randint(1, 350):
                if draw.random() < 0.5:
                    words += [draw.randint(0, 30) for _ in range(draw.randint(1, 40))]
                else:
                    p = draw.choice([1, 1, 2, 3, 5, 17, 18, 20, 25, 40])
                    block = [draw.randint(0, draw.choice([1, 2, 10])) for _ in range(p)]
                    words += (block * 10)[: int(p * draw.uniform(1, 9)) + 1]
            texts.append(words)
        first = np.cumsum([0, *map(len, texts)])
        expected = [(a + f, b + f, q) for w, f in zip(texts, first.tolist(), strict=False) for a, b, q in plain_runs(w, repeats, least)]
        code = np.array([w for t in texts for w in t], np.int32)
        text = np.repeat(np.arange(len(texts)), np.diff(first))
        assert period_runs.runs_of(code, text, repeats, least) == expected


def test_long_periods_and_one_word(spark):
    block = [f"w{i}" for i in range(5000)]
    rows = spark.createDataFrame([(1, " ".join(block * 5 + ["end"])), (2, "a " * 300_000), (3, "a b " * 3)], "doc_id int, text string")
    found = {r["doc_id"]: r for r in period_runs.periodic_runs(rows).collect()}
    assert [tuple(r) for r in found[1]["runs"]] == [(0, 25_000, 5000)] and found[1]["text"] == " ".join([*block, "end"])
    assert [tuple(r) for r in found[2]["runs"]] == [(0, 300_000, 1)] and found[2]["text"] == "a"
    assert found[3]["runs"] == [] and found[3]["text"] == "a b a b a b"


def test_periodic_runs_query_equals_plain_search(spark):
    docs, rows = documents(), QUERIES["op11_periodic_runs"](spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    with_runs = 0
    for r in rows:
        words = WORD.findall(docs[r["doc_id"]])
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            a, g = h // 10 % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words)
        gone = {i for a, b, q in runs for i in range(a + q, b)}
        collapsed = " ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs)
        best = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
        a, b, q = best or (None, None, None)
        one = (a, b - a, q, 1000 * (b - a) // q) if best else (None,) * 4
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(runs), *one)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed.encode()).hexdigest()
        with_runs += bool(runs)
    assert with_runs >= 5


def plain_phrases(rows: list[tuple], least: int, longest: int, covered: int, top: int) -> list[tuple]:
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i : i + k]))
                    counts[key] = counts.get(key, 0) + 1
    out = []
    for lang in totals:
        own = {w: c for (x, w), c in counts.items() if x == lang and c >= least}
        longer = {}
        for w, c in own.items():
            for k in range(2, len(w)):
                for i in range(len(w) - k + 1):
                    longer[w[i : i + k]] = max(longer.get(w[i : i + k], 0), c)
        found = []
        for w, a in own.items():
            if len(w) > 1 and 100 * longer.get(w, 0) < covered * a:
                score, k = min((1000 * a * totals[lang] // (own[w[:k]] * own[w[k:]]), k) for k in range(1, len(w)))
                found.append((-score, -a, " ".join(w).encode(), own[w[:k]], own[w[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("least,longest,covered,top", [(3, 5, 100, 2000), (2, 3, 60, 7), (5, 2, 100, 50), (2, 7, 90, 2000)])
def test_collocations_equal_plain_counts(spark, monkeypatch, least, longest, covered, top):
    monkeypatch.setattr(collocations, "RANKED", 10)  # several parts of a language
    draw = random.Random(least)
    stops = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "!?", "\x85"]
    rows = []
    for i in range(120):
        words = [draw.choice(("the", "The", "of", "é", "Ét", "a", "b", "c", "new york city", "x\x00y")) for _ in range(draw.randint(0, 60))]
        rows.append((i, "".join(w + draw.choice(stops) for w in words), draw.choice(("en", "de", None))))
    rows += [(1, None, "en"), (None, "of the of the of", "fr"), rows[0]]
    found = collocations.collocations(made(spark, rows).repartition(5), least, longest, covered, top)
    assert sorted(tuple(r) for r in found.collect()) == plain_phrases(rows, least, longest, covered, top)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 10**15
    levels = spark.createDataFrame([("en", ["a", "b"], 3 * big, [7 * big, 3 * big], [5 * big, 3 * big], 1)], "lang string, words array<string>, a long, head array<long>, tail array<long>, id long")
    words = spark.createDataFrame([("en", 9 * big + 1)], "lang string, n long").select("lang", F.col("n").cast("decimal(16,0)").alias("words"))
    row = collocations._scored(levels.withColumn("inside", F.expr("CAST(array() AS array<bigint>)")), words, 100).collect()[0]
    assert row["score"] == 1000 * 3 * big * (9 * big + 1) // (7 * big * 5 * big)


def test_collocations_query_equals_sql(spark):
    found = differences(QUERIES["op12_collocations"](spark, SMALL), connect(SMALL), collocations.collocations_sql())
    assert found == []


def slots_are_whole(plan: best_fit.Plan, histogram: np.ndarray) -> None:
    filled = {}
    for length in range(1, len(histogram)):
        at = 0
        for _, first, last, each, sequence, offset in sorted(s for s in plan.slots if s[0] == length):
            assert first == at
            at = last
            for rank in range(first, last):
                spot = (offset + (rank - first) % each * length, length)
                filled.setdefault(sequence + (rank - first) // each, []).append(spot)
        assert at == histogram[length]
    for spots in filled.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at < len(histogram)
    assert sorted(filled) == list(range(plan.sequences))


def plain_best_fit(lengths: list[int], window: int) -> int:
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= length]
        if fits:
            room[min(fits)[1]] -= length
        else:
            room.append(window - length)
    return len(room)


@pytest.mark.parametrize("seed", range(12))
def test_plans_are_whole_and_as_tight_as_best_fit(seed):
    draw = np.random.default_rng(seed)
    window = int(draw.choice([16, 64, 300]))
    lengths = np.minimum(window, draw.exponential(window / draw.integers(1, 9), int(draw.integers(1, 1200))).astype(int) + 1)
    histogram = np.bincount(lengths, minlength=window + 1)
    plan = best_fit.Plan(histogram)
    slots_are_whole(plan, histogram)
    assert plan.sequences == plain_best_fit(lengths.tolist(), window)


def test_entries_of_a_plan_do_not_grow_with_documents():
    histogram = np.bincount(np.random.default_rng(1).integers(1, 257, 4000), minlength=257)
    small, large = best_fit.Plan(histogram), best_fit.Plan(histogram * 1_000_000)
    assert len(large.slots) <= 3 * len(small.slots)
    assert best_fit.Plan(np.zeros(9, int)).slots == []


def test_best_fit_query_places_every_id_once(spark):
    docs, rows = documents(), QUERIES["op13_best_fit"](spark, SMALL).collect()
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    of_doc, of_sequence, tokens = {}, {}, 0
    for r in rows:
        of_doc.setdefault(r["doc_id"], []).append(r)
        of_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(of_doc) == sorted(docs)
    for doc_id, text in docs.items():
        ids, at = np.array([*plain.encode(text, add_special_tokens=False).ids, 0], "<u4"), 0
        tokens += len(ids)
        for k, r in enumerate(sorted(of_doc[doc_id], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at) and (k == 0 or r["length"] == 2048)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and len(of_doc[doc_id]) == -(-len(ids) // 2048)
    for spots in of_sequence.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(of_sequence) <= 1.01 * tokens / 2048 + 1


def test_ids_of_pieces(spark, odd):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = best_fit.best_fit(odd.filter("doc_id <> 5"), path, window=16).collect()
    assert all(zlib.crc32(np.frombuffer(r["ids"], "<u2").astype("<u4").tobytes()) == r["ids_crc32"] for r in rows)
    assert all(len(r["ids"]) == 2 * r["length"] for r in rows)


def test_unusual_rows_and_empty_tables(spark, odd):
    runs = period_runs.periodic_runs(odd).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in runs) == [(False, i) for i in (1, 2, 3, 3, 4, 5, 6)] + [(True, 0)]
    by_id = {r["doc_id"]: r for r in runs}
    assert (by_id[1]["text"], by_id[1]["n_words"], by_id[2]["text"], by_id[4]["text"]) == (None, 0, "", "")
    assert [tuple(x) for x in by_id[5]["runs"]] == [(0, 3000, 1), (3000, 1_500_000, 3)] and by_id[5]["text"] == "é x y z."
    assert [tuple(x) for x in by_id[3]["runs"]] == [(0, 80, 2)] and by_id[3]["text"] == "a b"
    phrases = {(r["lang"], r["phrase"]): r["a"] for r in collocations.collocations(odd, least=40).collect()}
    assert phrases == {
        ("en", "a b"): 80, ("en", "a b a b"): 78, ("en", "a b a b a"): 76, ("en", "b a b a b"): 76, ("und", "x y z"): 500_000,
        **{("und", " ".join("é" * k)): 3001 - k for k in range(2, 6)},
    }
    slots = best_fit.best_fit(odd, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False).collect()
    assert sorted({(r["part"], r["row"]) for r in slots}).__len__() == 8
    none = odd.limit(0)
    assert period_runs.periodic_runs(none).count() == collocations.collocations(none).count() == 0
    assert best_fit.best_fit(none, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert odd.count() == 8
