"""DuckDB SQL of the quality rules."""

from __future__ import annotations

from roadlens.llm import quality_rules as q


def _counts(items: list[str]) -> str:
    return "[" + ", ".join(items) + "]"


def _distance(p: str, q_: str) -> str:
    share = lambda a: f"list_transform({a}, lambda x: x::DOUBLE / list_sum({a}))"
    part = "CASE WHEN t[{0}] > 0 THEN t[{0}] * log2(2 * t[{0}] / (t[1] + t[2])) ELSE 0 END"
    terms = lambda k: f"list_sum(list_transform(list_zip({share(p)}, {share(q_)}), lambda t: {part.format(k)}))"
    return (
        f"CASE WHEN {p} IS NULL OR {q_} IS NULL OR list_sum({p}) = 0 OR list_sum({q_}) = 0 THEN 0 "
        f"ELSE sqrt(greatest(0, 0.5 * {terms(1)} + 0.5 * {terms(2)})) END"
    )


def quality_sql(documents: str = "documents") -> str:
    gone = lambda c: f"length(text) - length(regexp_replace(text, '[{c}]', '', 'g'))"
    classes = [gone("a-z"), gone(q.SPACE), *[gone(c) for c in q.CLASSES]]
    n_classes, top = len(classes) + 1, q.COMMON_WORDS
    sums = lambda name, n: _counts([f"sum({name}[{i}])" for i in range(1, n + 1)])
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[{q.SPACE}]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^{q.SPACE}]')) AS lines
  FROM {documents}),
w AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM d WHERE len(words) >= 3)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM w) WHERE n > 1),
repeated AS (
  SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY r),
m AS (
  SELECT d.r, doc_id, lang, len(words) AS n_words, length(text) AS chars,
    length(text) - ({gone(q.SPACE)}) AS word_chars, {gone("#*$%&|<>")} AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
    {_counts(classes)} AS c
  FROM d LEFT JOIN repeated ON d.r = repeated.r),
e AS (SELECT r, coalesce(lang, '') AS lang, len(words) AS n, unnest(words) AS word FROM d),
ranked AS (
  SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY count(DISTINCT r) DESC, word) AS place
  FROM e WHERE n >= {q.MIN_WORDS} GROUP BY lang, word),
common AS (SELECT * FROM ranked WHERE place <= {top}),
h AS (
  SELECT r, list_transform(range(1, {top + 2}), lambda i: coalesce(element_at(map_from_entries(list((place, n))), i)[1], 0)) AS common
  FROM (SELECT r, coalesce(place, {top + 1})::BIGINT AS place, count(*) AS n
    FROM e LEFT JOIN common USING (lang, word) GROUP BY ALL) GROUP BY r),
b AS (
  SELECT m.*, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed,
    list_append(c, chars - list_sum(c)::BIGINT) AS classes, h.common
  FROM m LEFT JOIN h ON m.r = h.r),
refs AS (
  SELECT coalesce(lang, '') AS ref_lang, sum(n_words) AS ref_words,
    {sums("classes", n_classes)} AS ref_classes, {sums("common", top + 1)} AS ref_common
  FROM b WHERE NOT base_failed GROUP BY 1),
j AS (
  SELECT b.*, NOT base_failed AND n_words >= {q.GUARD_WORDS} AND coalesce(ref_words, 0) >= {q.GUARD_REFERENCE} AS trusted,
    floor({q.STEPS} * ({_distance("classes", "ref_classes")}))::BIGINT AS class,
    floor({q.STEPS} * ({_distance("common", "ref_common")}))::BIGINT AS word,
    length(bin(n_words // {q.GUARD_WORDS})) AS band
  FROM b LEFT JOIN refs ON coalesce(lang, '') = ref_lang),
steps AS (
  UNPIVOT (SELECT coalesce(lang, '') AS lang, band, class, word FROM j WHERE trusted) ON class, word INTO NAME kind VALUE step),
cuts AS (
  SELECT lang, band, kind, q3 + greatest({q.FENCE} * (q3 - q1), {q.LEAST_SPREAD}) AS cut FROM (
    SELECT lang, band, kind, quantile_disc(step, 0.25) AS q1, quantile_disc(step, 0.75) AS q3 FROM steps GROUP BY ALL))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (trusted AND EXISTS (SELECT 1 FROM cuts
    WHERE cuts.lang = coalesce(j.lang, '') AND cuts.band = j.band AND CASE kind WHEN 'class' THEN class ELSE word END > cut)) AS kept
FROM j"""
