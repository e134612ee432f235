"""Line dedup: lines that many sites share, by the spread of each line's HyperLogLog sketch."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.base import text_key
from roadlens.session import settle

#: A line on so many distinct sites is boilerplate.
SITES = 10
#: So is a long line, of so many words or characters, on few sites or in many documents of whatever site.
LONG_WORDS, LONG_CHARS = 50, 300
LONG_SITES = 3
LONG_DOCUMENTS = 10
#: log2 of a sketch's registers; small counts are kept as lists, so most sketches are a few bytes.
LOG_REGISTERS = 8
#: Estimates within this share of a threshold are settled by exact counts; three times the error of 2^8 registers.
MARGIN = 0.2


def _lines(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with a text: its key, its site, and its lines' hashes (null: blank line).

    A line is compared without the spaces, tabs and returns around it, by two
    64-bit hashes.
    """
    return docs.filter("text IS NOT NULL").select(
        "doc_id", text_key().alias("text_key"), F.coalesce("source", F.lit("")).alias("site"),
        F.transform(F.split("text", "\n"), _line_key).alias("lines"),
    )


def _line_key(line: Column) -> Column:
    core = F.btrim(line, F.lit(" \t\r"))
    chars = F.length(core)
    long = (chars >= LONG_CHARS) | (chars - F.length(F.replace(core, F.lit(" "))) >= LONG_WORDS - 1)
    key = F.struct(F.xxhash64(core).alias("a"), F.xxhash64(F.lit(1), core).alias("b"), long.alias("long"))
    return F.when(core != "", key)


def boilerplate_lines(
    docs: DataFrame, sites: int = SITES, long_sites: int = LONG_SITES, long_documents: int = LONG_DOCUMENTS
) -> DataFrame:
    """Hashes (a, b) of the lines that are spread widely enough.

    A line is on ``sites`` distinct values of ``source`` (null: a site of its
    own), or it is long and on ``long_sites`` of them or in ``long_documents``
    distinct documents (null: one). Each line's sites, and a long line's
    documents, go into HyperLogLog sketches, merged by aggregation before and
    after the shuffle. Lines with an estimate near its threshold that no other
    decides get exact distinct counts; so does nothing else.
    """
    spread = _lines(docs).select("doc_id", "site", F.explode("lines").alias("line")).filter("line IS NOT NULL")
    spread = spread.select("doc_id", "site", "line.a", "line.b", "line.long")
    document = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    least = min(sites, long_sites, long_documents)
    estimates = (
        spread.groupBy("a", "b", "long")
        .agg(
            F.hll_sketch_agg("site", F.lit(LOG_REGISTERS)).alias("sites"), F.count("*").alias("n"),
            F.hll_sketch_agg(F.when(F.col("long"), document), F.lit(LOG_REGISTERS)).alias("documents"),
        )
        .filter(F.col("n") >= F.when(F.col("long"), least).otherwise(sites))  # fewer rows cannot reach the threshold
        .select("a", "b", "long", *[F.hll_sketch_estimate(c).alias(c) for c in ("sites", "documents")])
    )
    needed = F.when(F.col("long"), min(sites, long_sites)).otherwise(sites)
    figures = ((F.col("sites"), needed, F.lit(True)), (F.col("documents"), F.lit(long_documents), F.col("long")))

    def reaches(share: float, n: tuple = figures) -> Column:
        return reduce(or_, [used & (count >= enough * share) for count, enough, used in n])

    judged = settle(estimates.filter(reaches(1 - MARGIN)).select("a", "b", reaches(1 + MARGIN).alias("sure")))
    near = judged.filter("NOT sure").select("a", "b")
    rows = spread.join(near, ["a", "b"], "left_semi")
    both = F.explode(
        F.array(
            F.struct(F.lit("s").alias("of"), F.col("site").alias("value")),
            F.struct(F.lit("d").alias("of"), document.alias("value")),
        )
    )
    counted = (
        rows.select("a", "b", "long", both.alias("x")).groupBy("a", "b", "long", "x.of", "x.value").agg(F.lit(1).alias("one"))
        .groupBy("a", "b", "long")
        .agg(F.count_if(F.col("of") == "s").alias("sites"), F.count_if(F.col("of") == "d").alias("documents"))
    )
    return judged.filter("sure").select("a", "b").unionByName(counted.filter(reaches(1)).select("a", "b"))


def dedup_lines(
    docs: DataFrame, sites: int = SITES, extra: tuple[str, ...] = (), long_sites: int = LONG_SITES,
    long_documents: int = LONG_DOCUMENTS,
) -> DataFrame:
    """``docs`` (doc_id, text, source) without repeated boilerplate lines.

    Columns: doc_id, n_lines, n_removed, text, and those named in ``extra``. Of each boilerplate line the first
    occurrence (by doc_id, then hash of the text, then line) stays, so nothing is
    lost from the corpus; all others go. Null texts stay null with no lines;
    blank lines are never boilerplate; an empty text is one blank line. Equal
    rows lose the same lines. Other columns are not read.
    """
    common = settle(boilerplate_lines(docs, sites, long_sites, long_documents))
    places = _lines(docs).select("doc_id", "text_key", F.posexplode("lines").alias("pos", "line"))
    places = places.filter("line IS NOT NULL").select("doc_id", "text_key", "pos", "line.a", "line.b")
    hits = settle(places.join(common, ["a", "b"], "left_semi"))
    # written, so that a join that can do without dealing out a frequent line's rows does
    firsts = settle(hits.groupBy("a", "b").agg(F.min(F.struct("doc_id", "text_key", "pos")).alias("first")))
    again = hits.join(firsts, ["a", "b"]).filter(F.struct("doc_id", "text_key", "pos") != F.col("first"))
    removed = again.groupBy(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).agg(
        F.collect_set("pos").alias("gone")
    )
    texts = docs.select("doc_id", "text", *extra, text_key().alias("text_key"))
    joined = texts.join(
        removed, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")), "left"
    ).withColumn("lines", F.split("text", "\n"))
    stay = F.expr("array_except(sequence(0, size(lines) - 1), gone)")
    return joined.select(
        "doc_id", F.coalesce(F.array_size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.array_size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text"))
        .otherwise(F.concat_ws("\n", F.transform(stay, lambda i: F.col("lines")[i]))).alias("text"),
        *extra,
    )


def dedup_lines_sql(
    documents: str = "documents", sites: int = SITES, long_sites: int = LONG_SITES, long_documents: int = LONG_DOCUMENTS
) -> str:
    """DuckDB SQL of ``dedup_lines``; occurrences are ordered by doc_id and line, so doc_id has to be unique."""
    return f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM {documents} WHERE text IS NOT NULL),
c AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS core FROM l),
common AS (
  SELECT core FROM c WHERE core <> '' GROUP BY core HAVING count(DISTINCT coalesce(source, '')) >= {sites}
    OR (length(core) >= {LONG_CHARS} OR length(core) - length(replace(core, ' ', '')) >= {LONG_WORDS - 1})
      AND (count(DISTINCT coalesce(source, '')) >= {long_sites} OR count(DISTINCT coalesce(doc_id::VARCHAR, '')) >= {long_documents})),
r AS (
  SELECT c.*, common.core IS NOT NULL AND row_number() OVER (PARTITION BY c.core ORDER BY doc_id, pos) > 1 AS gone
  FROM c LEFT JOIN common ON c.core = common.core)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines,
  coalesce(x.n, 0)::BIGINT AS n_removed, CASE WHEN d.text IS NOT NULL THEN coalesce(x.text, '') END AS text
FROM {documents} d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS text
  FROM r GROUP BY doc_id) x USING (doc_id)"""
