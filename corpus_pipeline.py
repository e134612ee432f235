"""The corpus pipeline: stages applied in order to ``documents``.

Each stage takes what its predecessor kept. All but the last return the columns
of ``documents``; rows with equal doc_id and text count as one document from the
near-duplicate stage on. Null texts have no words, so the first stage drops them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm.base import table, text_key
from roadlens.llm.decontaminate import clean_texts, find_contamination
from roadlens.llm.line_dedup import dedup_lines
from roadlens.llm.ngram_join import ngram_join
from roadlens.llm.packing import packed
from roadlens.llm.quality_rules import quality_rules
from roadlens.session import settle

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document that holds more than this share of its words from benchmarks goes; from others the spans go.
MAX_CONTAMINATED = 0.5


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``kept`` names by doc_id and row, the key of the text."""
    ids = kept.select(F.col("doc_id").alias("kept_id"), F.col("row").alias("kept_row"))
    return docs.select(*COLUMNS).join(ids, _same("doc_id", "kept_id") & (text_key() == F.col("kept_row")), "left_semi")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts go, equal rows share their verdict."""
    return _only(docs, quality_rules(docs).filter("kept"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated boilerplate lines; null texts stay null, a text may become empty."""
    return dedup_lines(docs, extra=("lang", "source", "n_chars")).select(
        "doc_id", "text", "lang", "source",
        F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one document: the least doc_id, nulls last, then the least key of the text."""
    return _only(docs, ngram_join(docs).filter("first")).dropDuplicates(["doc_id", "text"])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark spans; those that are mostly benchmark go, null and empty texts stay."""
    return clean_texts(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"), MAX_CONTAMINATED)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, one row each; an empty text is its end id, a repeated row a document of its own."""
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False).drop("ids", "part", "row")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]
#: Token ids and least squares have no SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn, each reading what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = settle(docs)
    return docs
