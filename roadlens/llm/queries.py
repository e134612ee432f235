"""The registered queries of this subpackage: each operator over its whole table, as its contract returns it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm.base import remainder, table
from roadlens.llm.best_fit import best_fit
from roadlens.llm.collocations import collocations, collocations_sql
from roadlens.llm.decontaminate import contamination_digest, find_contamination
from roadlens.llm.language_id import identify, learn_languages
from roadlens.llm.language_model import learn, score_texts
from roadlens.llm.line_dedup import dedup_lines, dedup_lines_sql
from roadlens.llm.ngram_join import ngram_join, ngram_join_sql
from roadlens.llm.oracle_contamination import contamination_sql
from roadlens.llm.oracle_quality import quality_sql
from roadlens.llm.packing import packed
from roadlens.llm.period_runs import periodic_runs
from roadlens.llm.personal_data import find_personal_data, spans_digest
from roadlens.llm.quality_classifier import CUT, learn_quality, score_quality
from roadlens.llm.quality_rules import quality_rules
from roadlens.llm.token_files import read_ids, write_ids
from roadlens.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance", "row")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{shared_folder(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), out)
    return read_ids(spark, out, with_ids=False)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False).drop("ids")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = learn_languages(docs.filter(~held_out))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans_digest(find_personal_data(table(spark, sf_dir, "documents")))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 5) == 0
    model = learn_quality(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return score_quality(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 5) == 1
    scored = score_texts(docs, *learn(docs.filter(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), *scored.columns[1:])


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents")).drop("row", "first")


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` with periods written into every tenth text, as the contract of the periodic runs says."""
    hashed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n, g = F.size(words), F.floor(hashed / 10)
    a = (g % n).cast("int")
    period = (F.floor((n - a) / (g % 8 + 3)) + 1).cast("int")
    # n - a words of the period's repeats
    repeats = F.flatten(F.array_repeat(F.slice(words, a + 1, period), F.ceil((n - a) / period).cast("int")))
    new = F.concat_ws(" ", F.slice(words, F.lit(1), a), F.slice(repeats, F.lit(1), n - a))
    return docs.select("doc_id", F.when((hashed % 10 == 0) & (n > 0), new).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted(table(spark, sf_dir, "documents")))
    # by length / period, compared exactly; runs are in order of start and period, so the first of equals stays
    best = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))),
        F.try_element_at("runs", F.lit(1)),
        lambda x, y: F.when(y["length"] * x["period"] > x["length"] * y["period"], y).otherwise(x),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("collapsed_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return best_fit(table(spark, sf_dir, "documents"), path, with_ids=False).drop("ids", "part", "row")


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_files": op2_token_files,
    "op3_decontamination": op3_decontamination,
    "op4_packing": op4_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_language_id": op6_language_id,
    "op7_personal_data": op7_personal_data,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_language_model": op9_language_model,
    "op10_ngram_join": op10_ngram_join,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_collocations": op12_collocations,
    "op13_best_fit": op13_best_fit,
}
ORACLES: dict[str, str] = {
    "op10_ngram_join": ngram_join_sql(),
    "op12_collocations": collocations_sql(),
    "op1_line_dedup": dedup_lines_sql(),
    "op3_decontamination": contamination_sql(),
    "op5_quality_rules": quality_sql(),
}
