"""Data checks. Every check gives one row: what was checked and how many rows fail.

All row-wise checks of a table are counted in one scan. Keys are counted per
value first, so a value that fills a third of the table is one row afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = ("model", "column_name", "check", "failures")


def _rows(df: DataFrame, model: str, column: str, check: str, failures) -> DataFrame:
    return df.select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit(check).alias("check"),
        failures.cast("bigint").alias("failures"),
    )


def check_rows(
    df: DataFrame,
    model: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[Any]] | None = None,
    max_length: Mapping[str, int] | None = None,
) -> DataFrame:
    """Counts NULLs, values outside a list (NULL is allowed there) and texts that are too long."""
    checks = [(c, "not_null", F.col(f"`{c}`").isNull()) for c in not_null]
    checks += [(c, "accepted_values", ~F.col(c).isin(list(v))) for c, v in (accepted or {}).items()]
    checks += [(c, "max_length", F.length(c) > n) for c, n in (max_length or {}).items()]
    counts = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(checks)])
    rows = [
        F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"), F.lit(check).alias("check"),
                 F.col(f"c{i}").alias("failures"))
        for i, (c, check, _) in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def violating_rows(df: DataFrame, column: str, accepted: Sequence[Any] | None = None) -> DataFrame:
    """The rows themselves that break not-null, or the accepted values where they are given."""
    return df.filter(F.col(column).isNull() if accepted is None else ~F.col(column).isin(list(accepted)))


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count; NULL keys are left out."""
    keyed = reduce(lambda d, c: d.filter(F.col(c).isNotNull()), columns, df)
    return keyed.groupBy(*columns).agg(F.count("*").alias("n_records")).filter("n_records > 1")


def check_unique(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    found = duplicates(df, columns).agg(F.count("*").alias("n"))
    return _rows(found, model, ", ".join(columns), "unique", F.col("n"))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Key values of ``child`` without a row in ``parent``, with their row counts; NULL is no key."""
    used = child.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("n_records"))
    known = parent.select(F.col(parent_key).alias("_key"))
    return used.join(known, "_key", "left_anti").withColumnRenamed("_key", key)


#: Bytes of bitmaps a row may cost; more are not worth it, as keys lie too far apart.
BITMAP_BYTES = 8
_BUCKET = 32768  # keys of one bitmap


def orphans_by_bitmap(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """``orphans`` for whole-number keys that lie close together, without shuffling keys that have a parent.

    Both sides' keys become bitmaps of 32 768 neighbouring numbers, which are
    exact and are all that is shuffled of them. Where both sides' bits are more
    than the parent's, orphans are among the keys: only those rows go on to the
    join. Keys too far apart for bitmaps, or of another type, go there at once.
    The extremes of the keys are read when this is called.
    """
    whole = ("tinyint", "smallint", "int", "bigint")
    if dict(child.dtypes)[key] not in whole or dict(parent.dtypes)[parent_key] not in whole:
        return orphans(child, key, parent, parent_key)
    used, known = child.select(F.col(key).cast("bigint").alias("k")), parent.select(F.col(parent_key).cast("bigint").alias("k"))
    for side in (used, known):
        low, high, rows = side.agg(F.min("k"), F.max("k"), F.count("k")).collect()[0]
        if rows and (high - low) // 8 > BITMAP_BYTES * rows + _BUCKET:
            return orphans(child, key, parent, parent_key)
    bitmaps = _bitmaps(used, False).unionByName(_bitmaps(known, True))
    every, parents = F.bitmap_or_agg("bits"), F.bitmap_or_agg(F.when(F.col("known"), F.col("bits")))
    suspect = (
        bitmaps.groupBy("bucket")
        .agg(F.bitmap_count(every).alias("every"), F.coalesce(F.bitmap_count(parents), F.lit(0)).alias("parents"))
        .filter("every > parents")
        .select(F.col("bucket").alias("_suspect"))
    )

    def in_suspect(df: DataFrame, name: str) -> DataFrame:
        bucket = F.bitmap_bucket_number(F.col(name).cast("bigint"))
        return df.select(name).join(suspect, bucket == F.col("_suspect"), "left_semi")

    return orphans(in_suspect(child, key), key, in_suspect(parent, parent_key), parent_key)


def _bitmaps(keys: DataFrame, known: bool) -> DataFrame:
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("k")).alias("bits")
    grouped = keys.filter("k IS NOT NULL").groupBy(F.bitmap_bucket_number("k").alias("bucket")).agg(bits)
    return grouped.withColumn("known", F.lit(known))


def check_relationship(
    child: DataFrame, model: str, key: str, parent: DataFrame, parent_key: str, find=orphans
) -> DataFrame:
    """Rows of ``child`` whose key has no row in ``parent``; ``find`` is how, ``orphans`` or ``orphans_by_bitmap``."""
    found = find(child, key, parent, parent_key).agg(F.coalesce(F.sum("n_records"), F.lit(0)).alias("n"))
    return _rows(found, model, key, "relationships", F.col("n"))


def check_all(tables: Mapping[str, DataFrame], contract: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """Runs a contract: per model ``not_null``, ``accepted``, ``unique`` and ``relationships``."""
    results = []
    for model, rules in contract.items():
        df = tables[model]
        results.append(check_rows(df, model, rules.get("not_null", ()), rules.get("accepted")))
        results += [check_unique(df, model, [c]) for c in rules.get("unique", ())]
        results += [
            check_relationship(df, model, key, tables[parent], parent_key)
            for key, (parent, parent_key) in rules.get("relationships", {}).items()
        ]
    return reduce(DataFrame.unionByName, results)


def summarise(results: DataFrame) -> DataFrame:
    """Checks run, passed and failed, per kind."""
    return results.groupBy("check").agg(
        F.count("*").alias("checks"),
        F.count_if(F.col("failures") == 0).alias("passed"),
        F.count_if(F.col("failures") > 0).alias("failed"),
    )
