"""DuckDB SQL of the benchmark decontamination."""

from __future__ import annotations

from roadlens.llm.decontaminate import WINDOW

WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


def contamination_sql(documents: str = "documents", benchmark: str = "benchmark", n: int = WINDOW) -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS words FROM {documents}),
b AS (SELECT item_id::VARCHAR AS item, {WORDS} AS words FROM {benchmark}),
bw AS (
  SELECT DISTINCT item, size, array_to_string(words[i:i + size - 1], ' ') AS w
  FROM (SELECT item, words, least({n}, len(words)) AS size, unnest(range(1, len(words) - least({n}, len(words)) + 2)) AS i
    FROM b WHERE len(words) > 0)),
dw AS (
  SELECT r, size, i, array_to_string(words[i:i + size - 1], ' ') AS w
  FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i
    FROM d, (SELECT DISTINCT size FROM bw) WHERE len(words) >= size)),
hits AS (SELECT r, item, i, size FROM dw JOIN bw USING (size, w)),
n_hit AS (
  SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + size)) AS j FROM hits) GROUP BY r),
n_items AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit.n, 0)::BIGINT AS n_hit,
  coalesce(n_items.n, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit USING (r) LEFT JOIN n_items USING (r)"""
