"""The corpus queries over a whole small table: against their SQL, plain Python, or held-out labels."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from compare import connect, differences
from conftest import SMALL
from tokenizers import Tokenizer

from roadlens.llm.queries import ORACLES, QUERIES

MEDIUM = "/root/testdata/sf0.01"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(sf_dir: str = SMALL) -> dict[int, str]:
    rows = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def tokenizer(name: str) -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path(name))


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) == []


def test_token_files_hold_the_tokenizers_ids(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op2_token_files"](spark, SMALL).collect()}
    docs, plain, at = documents(), tokenizer("byte_bpe_50k.json"), 0
    assert sorted(rows) == sorted(docs)
    for doc_id in sorted(docs):
        ids = np.array([*plain.encode(docs[doc_id], add_special_tokens=False).ids, 0])
        r = rows[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)


def test_packing_places_every_id_once_with_little_padding(spark):
    rows, docs, plain = QUERIES["op4_packing"](spark, SMALL).collect(), documents(), tokenizer("word_bpe_49k.json")
    of_doc, of_sequence = {}, {}
    for r in rows:
        of_doc.setdefault(r["doc_id"], []).append(r)
        of_sequence.setdefault(r["sequence_id"], []).append(r)
    assert sorted(of_doc) == sorted(docs)
    for doc_id, text in docs.items():
        ids, at = np.array([*plain.encode(text, add_special_tokens=False).ids, 1]), 0
        for r in sorted(of_doc[doc_id], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == crc(ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(ids)
    padding = 0
    for pieces in of_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 0.01 * 2048 * len(of_sequence)


def test_language_of_held_out_documents(spark):
    lang = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{MEDIUM}/documents.parquet", columns=["doc_id", "lang"]).to_pylist()}
    rows = QUERIES["op6_language_id"](spark, MEDIUM).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)


PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            right = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda d=digits, x=doubled: 16 <= len(d) <= 19 and sum(v // 10 + v % 10 for v in x) % 10 == 0,
                "phone": lambda d=digits: 8 <= len(d) <= 15,
            }[kind]
            if right():
                out.append((kind, *m.span()))
    return out


def test_personal_data_equals_plain_search(spark):
    docs = documents(MEDIUM)
    rows = QUERIES["op7_personal_data"](spark, MEDIUM).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    planted = found = 0
    for r in rows:
        base = plain_spans(docs[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [
            sum(k == kind for k, _, _ in base) for kind, _ in PATTERNS
        ]
        assert r["spans"].startswith(joined)
        spans = {s for s in r["spans"].split(",") if s.startswith("secret")}
        for m in re.finditer(r"AKIA[0-9A-Z]{16}|(?<=password=)[0-9a-f]+|(?<=token = \")[0-9a-f]+", docs[r["doc_id"]]):
            planted += 1
            found += f"secret:{m.start()}:{m.end()}" in spans or any(
                int(s.split(":")[1]) <= m.start() and m.end() <= int(s.split(":")[2]) for s in spans
            )
    assert found >= 0.9 * planted


def test_quality_of_held_out_documents(spark):
    label = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{MEDIUM}/labels.parquet").to_pylist()}
    rows = QUERIES["op8_quality_classifier"](spark, MEDIUM).collect()
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in label]
    assert sum(r["predicted"] == label[r["doc_id"]] for r in held) >= 0.9 * len(held)


def test_language_model_counts_and_gain(spark):
    docs = documents(MEDIUM)
    rows = {r["doc_id"]: r for r in QUERIES["op9_language_model"](spark, MEDIUM).collect()}
    held_out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs}
    tokens = {i: [*re.findall("[^\x20\x09-\x0d]+", t.translate(UPPER)), ""] for i, t in docs.items()}
    counts = Counter(w for i, ws in tokens.items() if not held_out[i] for w in ws)
    total, size = sum(counts.values()), len(counts)
    assert sorted(rows) == sorted(docs)
    for i, ws in tokens.items():
        r = rows[i]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (size + 1))) for w in ws)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert (r["n_tokens"], r["n_known"]) == (len(ws), sum(counts[w] > 0 for w in ws))
        assert (r["held_out"], r["train_tokens"]) == (held_out[i], total)
    bits = sum(-rows[i]["score"] for i in docs if held_out[i]) / math.log10(2)
    size = sum(len(docs[i].encode()) + 1 for i in docs if held_out[i])
    assert bits / size < 3  # eight bits a byte without a model
