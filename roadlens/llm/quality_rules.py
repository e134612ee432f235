"""Quality rules: rule counts, and divergence of a text's histograms from those of its language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.base import text_key
from roadlens.session import settle

#: Words whose counts make a language's word histogram: those found in most of its texts.
COMMON_WORDS = 32
SPACE = r"\x20\x09-\x0D"
#: Character classes beside a-z and SPACE; what is in none of them is the last class.
CLASSES = (r"A-Z", r"0-9", r".,;:?\x27\x22()\x2D", r"#*$%&|<>!=@/\\_+", r"\x80-\x{10FFFF}")

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A histogram of fewer words than this says too little to reject a text.
GUARD_WORDS = 100
#: A language needs this many words in texts that pass the base rules to be a reference.
GUARD_REFERENCE = 2000
#: Distances are counted in steps of 1 / STEPS. A text diverges if its distance lies beyond the upper quartile of its
#: language's texts of like length by FENCE times the quartiles' spread, and by LEAST_SPREAD steps.
STEPS = 1000
FENCE = 2
LEAST_SPREAD = 80


def _without(column: str, chars: str) -> Column:
    return F.regexp_replace(column, f"[{chars}]++", "")


def _fewer(column: str, chars: str) -> Column:
    """Code points of ``column`` in the class ``chars``."""
    return (F.length(column) - F.length(_without(column, chars))).cast("long")


def _repeat_words(windows: str) -> Column:
    """Words in any 3-word window that the text holds twice or more.

    Windows are compared by 64-bit hashes. To sort plain longs, the low bits of
    each hash, as many as the text's length needs, give way to the position;
    neighbours that agree in the high bits are then compared in all 64.
    """
    return F.expr(f"""
        transform(array(-shiftleft(1L, 1 + CAST(log2(size({windows}) + 1) AS INT))), m ->
        transform(array(sort_array(transform({windows}, (h, i) -> (h & m) | i))), s ->
        size(array_distinct(flatten(transform(
            filter(s, (e, k) ->
                (k > 0 AND ((e ^ s[k - 1]) & m) = 0L AND {windows}[INT(e & ~m)] = {windows}[INT(s[k - 1] & ~m)])
                OR (k + 1 < size(s) AND ((e ^ s[k + 1]) & m) = 0L
                    AND {windows}[INT(e & ~m)] = {windows}[INT(s[k + 1] & ~m)])),
            e -> array(e & ~m, (e & ~m) + 1, (e & ~m) + 2)))))
        )[0])[0]""").cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """Counts of each text: base figures and ``classes`` (array of 8).

    Null text counts as the empty text. Rows stay as they are, repeated ones too;
    columns other than doc_id, text and lang are not read.
    """
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang", text_key().alias("row"))
    words = text.select(
        "*",
        F.expr(rf"filter(split(text, '[{SPACE}]++'), w -> w != '')".replace("\\", "\\\\")).alias("words"),
        _without("text", "a-z").alias("not_lower"),
    )
    lists = words.select(
        "*",
        F.expr("""CASE WHEN size(words) >= 3 THEN transform(sequence(1, size(words) - 2),
            i -> xxhash64(words[i - 1], words[i], words[i + 1])) ELSE array() END""").alias("windows"),
        F.expr(rf"filter(split(text, '\n'), l -> l rlike '[^{SPACE}]')".replace("\\", "\\\\")).alias("lines"),
        _without("not_lower", SPACE).alias("others"),
    )
    length = {c: F.length(c).cast("long") for c in ("text", "not_lower", "others")}
    classes = [length["text"] - length["not_lower"], length["not_lower"] - length["others"]]
    measured = lists.select(
        "doc_id", "lang", "row",
        F.size("words").cast("long").alias("n_words"),
        length["text"].alias("chars"),
        (length["text"] - length["not_lower"] + length["others"]).alias("word_chars"),
        _fewer("others", r"#*$%&|<>").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words("windows").alias("n_repeat_words"),
        F.array(*classes, *[_fewer("others", c) for c in CLASSES]).alias("classes"),
    )
    rest = lambda total, parts: F.expr(f"concat({parts}, array({total} - aggregate({parts}, 0L, (a, x) -> a + x)))")
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return measured.select(
        "doc_id", "lang", "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), rest("chars", "classes").alias("classes"),
    )


def _words(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with its words; null is a language too."""
    words = F.expr(rf"filter(split(coalesce(text, ''), '[{SPACE}]++'), w -> w != '')".replace("\\", "\\\\"))
    return docs.select("doc_id", text_key().alias("row"), F.coalesce("lang", F.lit("")).alias("lang"), words.alias("words"))


def common_words(docs: DataFrame, top: int = COMMON_WORDS) -> DataFrame:
    """(lang, place, word): the ``top`` words found in most texts of a language; of equals the lesser word.

    Texts of fewer than MIN_WORDS words do not count. A text counts once for a
    word, so junk that repeats words does not move them.
    """
    texts = _words(docs).filter(F.size("words") >= MIN_WORDS)
    counts = texts.select("lang", F.explode(F.array_distinct("words")).alias("word")).groupBy("lang", "word")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("word")))
    ranked = counts.agg(F.count("*").alias("n")).withColumn("place", place)
    return ranked.filter(F.col("place") <= top).select("lang", "place", "word")


def word_histograms(docs: DataFrame, common: DataFrame, top: int = COMMON_WORDS) -> DataFrame:
    """(doc_id, row, common): how often each common word of its language stands in a text, then all other words.

    Equal rows are counted together, which leaves their shares as they are.
    """
    words = _words(docs).select("doc_id", "row", "lang", F.explode("words").alias("word"))
    counts = words.join(common, ["lang", "word"], "left").groupBy("doc_id", "row", "place").agg(F.count("*").alias("n"))
    places = F.map_from_entries(F.collect_list(F.struct(F.coalesce("place", F.lit(top + 1)).alias("place"), "n")))
    of_place = F.transform(F.sequence(F.lit(1), F.lit(top + 1)), lambda i: F.coalesce(F.try_element_at("places", i), F.lit(0)))
    return counts.groupBy("doc_id", "row").agg(places.alias("places")).select("doc_id", "row", of_place.alias("common"))


def references(measured: DataFrame) -> DataFrame:
    """One row per language: summed histograms of all its texts that pass the base rules; null is a language too."""

    def summed(name: str, n: int) -> Column:
        return F.array(*[F.sum(F.col(name)[i]).cast("double") for i in range(n)]).alias(f"ref_{name}")

    return (
        measured.filter(~F.col("base_failed"))
        .groupBy(F.coalesce("lang", F.lit("")).alias("ref_lang"))
        .agg(F.sum("n_words").alias("ref_words"), summed("classes", len(CLASSES) + 3), summed("common", COMMON_WORDS + 1))
    )


def limits(judged: DataFrame) -> DataFrame:
    """(cut_lang, cut_band, class_limit, word_limit) in steps, from the distances of a language's texts that are trusted.

    A band holds the texts of up to twice the words of its shortest, as short
    texts lie farther from any reference. Quartiles are taken from the counts per
    step, of which there are STEPS at most.
    """
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_step").alias("step")) for k in ("class", "word")])
    steps = judged.filter("trusted").select(
        F.coalesce("lang", F.lit("")).alias("cut_lang"), F.col("band").alias("cut_band"), F.inline(kinds)
    )
    counts = steps.groupBy("cut_lang", "cut_band", "kind", "step").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("cut_lang", "cut_band", "kind")
    so_far = whole.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select("*", F.sum("n").over(so_far).alias("upto"), F.sum("n").over(whole).alias("total"))
    quartile = {q: F.min(F.when(4 * F.col("upto") >= q * F.col("total"), F.col("step"))) for q in (1, 3)}
    spread = F.greatest(FENCE * (quartile[3] - quartile[1]), F.lit(LEAST_SPREAD))
    cuts = ranked.groupBy("cut_lang", "cut_band", "kind").agg((quartile[3] + spread).alias("cut"))
    return cuts.groupBy("cut_lang", "cut_band").agg(
        *[F.max(F.when(F.col("kind") == k, F.col("cut"))).alias(f"{k}_limit") for k in ("class", "word")]
    )


def js_distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of counts; 0 where either holds nothing."""
    part = lambda own, other: f"""aggregate(zip_with({own}, {other}, (x, y) ->
        CASE WHEN x > 0 THEN x * log2(2 * x / (x + y)) ELSE 0D END), 0D, (a, x) -> a + x)"""  # noqa: E731
    share = lambda a: f"""transform(array(aggregate({a}, 0D, (s, x) -> s + x)), t -> transform({a}, x -> x / t))[0]"""
    empty = f"aggregate({p}, 0D, (s, x) -> s + x) = 0 OR aggregate({q}, 0D, (s, x) -> s + x) = 0"
    return F.expr(f"""CASE WHEN {p} IS NULL OR {q} IS NULL OR {empty} THEN 0D ELSE
        transform(array(named_struct('p', {share(p)}, 'q', {share(q)})), d ->
            sqrt(greatest(0D, 0.5D * {part('d.p', 'd.q')} + 0.5D * {part('d.q', 'd.p')})))[0] END""")


def quality_rules(docs: DataFrame) -> DataFrame:
    """Verdict per row of ``docs`` (doc_id, text, lang).

    A text is kept if it passes the base rules and neither its character-class
    nor its common-word histogram lies farther from its language's reference
    than most of the language's texts of like length do. Common words, references and limits
    come from all texts (references from those that pass the base rules); null
    languages form one of their own. Texts under GUARD_WORDS words and languages
    under GUARD_REFERENCE words are not judged by distance. Null and empty texts
    have no words and fail the base rules. Repeated rows each get their row; ties
    among common words go to the lesser word; an empty table gives no rows; other
    columns are ignored. Only counts are shuffled, a few per text; common words
    and references are as many rows as there are languages, times COMMON_WORDS.
    """
    measured = settle(measure(docs))
    common = settle(common_words(docs))
    histograms = word_histograms(docs, common).select(
        F.col("doc_id").alias("of_id"), F.col("row").alias("of_row"), "common"
    )
    own = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("row") == F.col("of_row"))
    counted = settle(measured.join(histograms, own, "left").drop("of_id", "of_row"))
    refs = settle(references(counted))
    step = {k: F.floor(F.col(f"{k}_distance") * STEPS).cast("long").alias(f"{k}_step") for k in ("class", "word")}
    judged = counted.join(refs, F.coalesce(counted.lang, F.lit("")) == refs.ref_lang, "left").select(
        *[c for c in counted.columns if c not in ("classes", "common")],
        js_distance("classes", "ref_classes").alias("class_distance"),
        js_distance("common", "ref_common").alias("word_distance"),
        (
            ~F.col("base_failed") & (F.col("n_words") >= GUARD_WORDS)
            & (F.coalesce("ref_words", F.lit(0)) >= GUARD_REFERENCE)
        ).alias("trusted"),
    )
    band = F.length(F.bin(F.floor(F.col("n_words") / GUARD_WORDS)))
    judged = settle(judged.select("*", *step.values(), band.alias("band")))
    # written, so that the join knows how few they are and deals out no language's rows
    cuts = settle(limits(judged))
    diverges = (F.col("class_step") > F.col("class_limit")) | (F.col("word_step") > F.col("word_limit"))
    kept = ~F.col("base_failed") & ~(F.col("trusted") & F.coalesce(diverges, F.lit(False)))
    own = (F.coalesce(judged.lang, F.lit("")) == cuts.cut_lang) & (judged.band == cuts.cut_band)
    return judged.join(cuts, own, "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"), "class_distance", "word_distance", "row",
    )
