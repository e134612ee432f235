"""Each stage of the pipeline on what its predecessor kept, against SQL or plain Python."""

from __future__ import annotations

import re

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from conftest import SMALL
from tokenizers import Tokenizer

import corpus_pipeline
from roadlens.llm.line_dedup import dedup_lines_sql
from roadlens.llm.ngram_join import ngram_join_sql
from roadlens.llm.oracle_quality import quality_sql

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Folders of ``documents`` and of what each stage wrote."""
    folders, docs = [f"{SMALL}/documents.parquet"], spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        folders.append(f"{path}/*.parquet")
    return folders


def rows(path: str, sql: str = "SELECT * FROM docs") -> list[tuple]:
    db = duckdb.connect()
    db.execute(f"CREATE VIEW docs AS SELECT * FROM '{path}'")
    return db.execute(sql).fetchall()


def texts(path: str) -> dict[int, str]:
    return dict(rows(path, "SELECT doc_id, text FROM docs"))


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_join", "decontamination", "packing"]
    for path in stages[:-1]:
        names = [c[0] for c in rows(path, "DESCRIBE docs")]
        assert names == list(corpus_pipeline.COLUMNS)


def test_rules_keep_what_the_sql_keeps(stages):
    kept = rows(stages[0], f"SELECT * FROM docs WHERE doc_id IN (SELECT doc_id FROM ({quality_sql('docs')}) WHERE kept)")
    assert sorted(rows(stages[1])) == sorted(kept) and 0 < len(kept) < len(rows(stages[0]))


def test_lines_equal_the_sql(stages):
    assert texts(stages[2]) == dict(rows(stages[1], f"SELECT doc_id, text FROM ({dedup_lines_sql('docs')})"))
    assert all(n == len(t) for t, n in rows(stages[2], "SELECT text, n_chars FROM docs"))


def test_one_document_of_each_class_stays(stages):
    classes = rows(stages[2], f"SELECT doc_id FROM ({ngram_join_sql('docs')}) WHERE doc_id = class_id")
    assert sorted(texts(stages[3])) == sorted(i for (i,) in classes)
    assert texts(stages[3]).items() <= texts(stages[2]).items()


def test_one_of_each_class_stays_without_or_with_equal_ids(spark):
    words = [f"w{i}" for i in range(100)]
    near = [" ".join([*words[:99], f"end{i}"]) for i in range(6)]
    far = [" ".join(f"{c}{w}" for w in words) for c in "abc"]
    rows = [(None, near[0]), (None, near[1]), (None, near[2]), (None, far[0]), (5, far[1]), (None, ""), (7, "")]
    for ids in (None, 3):  # near copies of null doc_ids only, then of one doc_id too
        made = [*rows, *([(ids, t) for t in near[3:]] if ids else [])]
        docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in made], "doc_id long, text string, lang string, source string, n_chars long")
        kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()]
        left = [k for k in kept if k[1] in near]
        assert len(left) == 1 and left[0][0] == ids
        assert sorted((str(i), t) for i, t in kept if t not in near) == sorted((str(i), t) for i, t in rows if t not in near)


def test_benchmark_windows_are_gone(stages):
    windows = set()
    for item in pq.read_table(f"{SMALL}/benchmark.parquet").column("text").to_pylist():
        words = WORD.findall(item.translate(UPPER))
        size = min(10, len(words))
        windows |= {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} - {()}
    sizes = {len(w) for w in windows}
    expected = {}
    for doc_id, text in texts(stages[3]).items():
        found = [(m.group(), *m.span()) for m in WORD.finditer(text.translate(UPPER))]
        words = [w for w, _, _ in found]
        hit = np.zeros(len(words), bool)
        for n in sizes:
            for i in range(len(words) - n + 1):
                hit[i : i + n] |= tuple(words[i : i + n]) in windows
        if hit.sum() <= corpus_pipeline.MAX_CONTAMINATED * len(words) or not hit.any():
            out, end = [], 0
            edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(int), [0]])))
            for a, b in zip(edges[::2], edges[1::2], strict=True):
                out.append(text[end : found[a][1]])
                end = found[b - 1][2]
            expected[doc_id] = "".join(out) + text[end:]
    assert texts(stages[4]) == expected
    assert expected != texts(stages[3])


def test_packing_holds_every_token(stages):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {i: len(plain.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts(stages[4]).items()}
    packed = dict(rows(stages[5], "SELECT doc_id, sum(length) FROM docs GROUP BY 1"))
    assert {i: int(n) for i, n in packed.items()} == sizes


def test_run_applies_the_stages(spark, stages):
    key = ["doc_id", "start", "length", "ids_crc32"]
    ran = corpus_pipeline.run(spark, SMALL).select(*key).collect()
    assert sorted(map(tuple, ran)) == sorted(rows(stages[5], f"SELECT {', '.join(key)} FROM docs"))


ODD = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows(spark):
    prose = " ".join(f"word{i % 97}x{i % 89}" for i in range(400))
    texts = [None, "", " \n\t ", prose, prose, "\x00 \u00a0", "short", "long " + prose * 40]
    rows = [(i if i % 3 else None, t, "en" if i % 2 else None, None if i % 4 else "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[4]], ODD)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_unusual_rows_and_on_none(spark, name, stage):
    docs = odd_rows(spark)
    rows = stage(spark, docs, SMALL).collect()
    if name == "quality_rules":
        assert {r["text"] for r in rows} <= {r["text"] for r in docs.collect()} and all(r["text"] for r in rows)
    elif name == "line_dedup":
        assert len(rows) == docs.count() and sum(r["text"] is None for r in rows) == 1
    elif name == "ngram_join":
        assert sum(r["text"] is not None and r["text"].startswith("word0") for r in rows) == 1
    elif name == "decontamination":
        assert len(rows) == docs.count()
    else:
        assert sum(r["start"] == 0 for r in rows) == docs.count()
    none = stage(spark, docs.limit(0), SMALL)
    assert none.count() == 0
    if name != corpus_pipeline.STAGES[-1][0]:
        assert none.columns == list(corpus_pipeline.COLUMNS)
