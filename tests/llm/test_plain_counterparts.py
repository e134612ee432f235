"""Learned operators against plain versions of themselves, and lines against plain counts."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SMALL

from roadlens.llm import decontaminate, language_id, line_dedup, quality_classifier
from roadlens.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def rows_of(table: str, sf_dir: str = MEDIUM) -> list[dict]:
    return pq.read_table(f"{sf_dir}/{table}.parquet").to_pylist()


def remainder(doc_id: int, by: int) -> int:
    import zlib

    return zlib.crc32(str(doc_id).encode()) % by


def grams(text: str) -> Counter:
    """Character 3- and 4-grams, letters in lower case, all else a space, none that begins with two spaces."""
    plain = "    " + "".join(c.lower()[0] if c.isalpha() else " " for c in text) + "    "
    out = Counter()
    for size in (3, 4):
        out.update(plain[i : i + size] for i in range(len(plain) - size + 1) if plain[i : i + 2] != "  ")
    return out


def test_languages_equal_those_by_plain_sets(spark):
    docs = rows_of("documents", SMALL)
    known = defaultdict(set)
    for d in docs:
        if d["lang"] is not None and remainder(d["doc_id"], 4) != 2:
            known[d["lang"]] |= set(grams(d["text"] or ""))
    found = {r["doc_id"]: r for r in QUERIES["op6_language_id"](spark, SMALL).collect()}
    same = 0
    for d in docs:
        counts = grams(d["text"] or "")
        held = {lang: sum(n for g, n in counts.items() if g in own) for lang, own in known.items()}
        if not any(c.isalpha() for c in d["text"] or ""):
            assert found[d["doc_id"]]["lang_pred"] == "und"
        best = max(sorted(held), key=held.get)
        second = sorted(held.values())[-2]
        same += found[d["doc_id"]]["lang_pred"] == best
        if held[best]:
            assert found[d["doc_id"]]["score"] == pytest.approx(held[best] / (held[best] + second), abs=0.02)
    assert same >= 0.99 * len(docs)


def test_languages_of_one_document_and_of_no_known_letters(spark):
    rows = [(i, "the cat sat on the mat and the dog too", "en") for i in range(5)] + [(9, "zażółć gęślą jaźń", "pl")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn_languages(docs)
    asked = spark.createDataFrame([(1, "gęślą jaźń"), (2, "the dog"), (3, "жжж"), (4, "12")], "doc_id long, text string")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(asked, model).collect()}
    assert found[1][0] == "pl" and found[2][0] == "en" and found[3] == ("en", 0.5) and found[4] == ("und", 0.0)


def plain_ranking(x: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Weights by gradient steps on every pair of a good and a bad document."""
    d = (x[good][:, None, :] - x[~good][None, :, :]).reshape(-1, x.shape[1])
    w = np.zeros(x.shape[1])
    for _ in range(4000):
        p = 1 / (1 + np.exp(np.clip(d @ w, -50, 50)))
        w += 0.05 * ((d * p[:, None]).mean(axis=0) - quality_classifier.RIDGE * w)
    return w


def ranks(x: np.ndarray) -> np.ndarray:
    return np.argsort(np.argsort(x))


def test_quality_equals_a_plain_fit_on_all_pairs(spark):
    label = {r["doc_id"]: r["quality"] for r in rows_of("labels") if r["quality"] is not None}
    text = {r["doc_id"]: r["text"] or "" for r in rows_of("documents")}
    ids = sorted(i for i in label if i in text and remainder(i, 5))
    x = np.array([quality_classifier.features(text[i]) for i in ids])
    good = np.array([label[i] == 1 for i in ids])
    model = quality_classifier.Ranking(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9), np.zeros(1))
    weights = plain_ranking(model.widened(x), good)
    every = sorted(text)
    plain = model.widened(np.array([quality_classifier.features(text[i]) for i in every])) @ weights
    found = {r["doc_id"]: r for r in QUERIES["op8_quality_classifier"](spark, MEDIUM).collect()}
    score = np.array([found[i]["score"] for i in every])
    assert np.corrcoef(ranks(plain), ranks(score))[0, 1] >= 0.95
    cut = np.quantile(plain[[every.index(i) for i in ids]], (~good).mean())
    assert np.mean((plain >= cut) == np.array([found[i]["predicted"] == 1 for i in every])) >= 0.95


def test_quality_of_repeated_ids_is_learned_once(spark):
    docs = spark.createDataFrame([(1, f"text number {i} of many") for i in range(50)] + [(2, "!!! ### 12")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (None, 1)], "doc_id long, quality int")
    model = quality_classifier.learn_quality(docs, labels)
    assert quality_classifier.score_quality(docs, model).count() == 51


def plain_lines(rows, sites, long_sites, long_documents) -> dict:
    """Texts without repeated boilerplate lines, by doc_id."""
    at, where = defaultdict(set), defaultdict(set)
    for i, text, source in rows:
        for line in text.split("\n"):
            if core := line.strip(" \t\r"):
                at[core].add(source or "")
                where[core].add(i)

    def common(core: str) -> bool:
        long = len(core) >= line_dedup.LONG_CHARS or core.count(" ") >= line_dedup.LONG_WORDS - 1
        return len(at[core]) >= sites or (long and (len(at[core]) >= long_sites or len(where[core]) >= long_documents))

    seen, out = set(), {}
    for i, text, _ in sorted(rows):
        kept = []
        for line in text.split("\n"):
            core = line.strip(" \t\r")
            if not core or not common(core) or core not in seen:
                kept.append(line)
            if core:
                seen.add(core)
        out[i] = "\n".join(kept)
    return out


def test_long_lines_on_few_sites_and_in_many_documents_of_one_go(spark):
    draw = random.Random(2)
    passages = [" ".join(f"w{k}x{i}" for i in range(55)) for k in range(12)] + ["x" * 320 + str(k) for k in range(3)]
    rows = []
    for i in range(900):
        lines = [f"own line {i}", draw.choice(("home", "about us", ""))]
        k = i % len(passages)
        if i // len(passages) < 2 + k:  # in 2 to 16 documents
            lines.insert(draw.randint(0, 2), f" {passages[k]}\t")
        rows.append((i, "\n".join(lines), f"s{i % (1 + k % 4)}" if k % 5 else None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    for thresholds in ((10, 3, 10), (2, 2, 4), (30, 4, 15)):
        found = line_dedup.dedup_lines(docs, thresholds[0], long_sites=thresholds[1], long_documents=thresholds[2])
        assert {r["doc_id"]: r["text"] for r in found.collect()} == plain_lines(rows, *thresholds)


def test_blocks_of_windows_are_taken_back(spark, monkeypatch):
    taken = []
    real = type(spark.sparkContext.broadcast(0)).destroy
    monkeypatch.setattr(type(spark.sparkContext.broadcast(0)), "destroy", lambda self, blocking=False: (taken.append(1), real(self, blocking)))
    items = spark.createDataFrame([(i, " ".join(f"i{i}w{k}" for k in range(30))) for i in range(8)], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(f"i{i}w{k}" for k in range(5, 20))) for i in range(8)] + [(9, None)], "doc_id long, text string")
    found = {r["doc_id"]: (r["spans"], r["items"]) for r in decontaminate.find_contamination(docs, items, bound=40).collect()}
    assert found == {**{i: ([[0, 15]], [str(i)]) for i in range(8)}, 9: ([], [])} and len(taken) >= 3
