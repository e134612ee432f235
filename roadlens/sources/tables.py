"""The typed incident table: load, number, lay out, verify, stage, materialise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.functions.geo import morton
from roadlens.operators.ordering import number_by_key, number_rows, ranges_of
from roadlens.session import discard, settle
from roadlens.sources.schema import RENAME, REQUIRED, TABLE_COLUMNS, TYPES
from roadlens.sources.versions import is_versioned, publish, read_version


def rename_columns(df: DataFrame, names: Mapping[str, str] = RENAME) -> DataFrame:
    """Only the mapped columns, under their new names, in the order of the mapping."""
    return df.selectExpr(*[f"`{old}` AS `{new}`" for old, new in names.items()])


def typed(df: DataFrame) -> DataFrame:
    """Casts to the table's types; a value that does not fit is an error, not a NULL."""
    return df.selectExpr(*[f"CAST({c} AS {TYPES.get(c, 'string')}) AS {c}" for c in TABLE_COLUMNS])


def require(df: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """Stops the job at the first row with a NULL in a required column."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"NULL in required column {c}"))) for c in columns}
    )


def with_serial_id(
    df: DataFrame, order_by: Sequence[str] = ("source_id",), name: str = "id", ranges: int | None = None
) -> DataFrame:
    """Adds a contiguous id from 1 in key order as the first column."""
    return number_rows(df, [F.col(c).asc_nulls_first() for c in order_by], name, ranges).select(name, *df.columns)


def load_table(
    clean: DataFrame, path: str, order_by: Sequence[str] = ("source_id",), ranges: int | None = None
) -> DataFrame:
    """Replaces the table at ``path`` by the clean rows, renamed, typed and numbered.

    The rows are a new version of the table (``publish``): a load that fails leaves the old one.
    The clean rows are written once before they are put in order, as ordering
    reads its input twice; that copy is deleted afterwards. Without ``order_by``
    they are numbered as they arrive, which needs no shuffle. ``ranges`` is the
    number of pieces to order them in, by default as many as the copy is read in.
    """
    rows = require(typed(rename_columns(clean)))
    if not order_by:
        return publish(with_serial_id(rows, order_by), path)
    copy = settle(rows)
    try:
        return publish(_numbered(copy, order_by, ranges), path)
    finally:
        discard(copy)


def _numbered(copy: DataFrame, order_by: Sequence[str], ranges: int | None) -> DataFrame:
    if len(order_by) == 1 and isinstance(copy.schema[order_by[0]].dataType, T.IntegralType):
        return number_by_key(copy, order_by[0], "id", ranges or ranges_of(copy)).select("id", *copy.columns)
    return with_serial_id(copy, order_by, ranges=ranges)


def write_layout(
    df: DataFrame,
    path: str,
    sort_by: Sequence[str] = ("state", "severity"),
    time: str = "start_time",
    spread_by: str = "id",
    files: int | None = None,
) -> None:
    """The table in folders by year, sorted so that file statistics skip most rows
    for filters on state and severity.

    The rows are range-partitioned on the sort columns and then on a hash, so a
    value that holds a large part of all rows is cut over many tasks.
    """
    salt = F.xxhash64(spread_by)
    keys = [F.col("year"), *[F.col(c) for c in sort_by], salt]
    df = df.withColumn("year", F.year(time))
    df = df.repartitionByRange(files or ranges_of(df), *keys)
    df.sortWithinPartitions("year", *sort_by).write.mode("overwrite").partitionBy("year").parquet(path)


#: Values that a column to cluster on may have, as its ranks are broadcast.
MOST_VALUES = 10_000
#: Ranks of each column go from 0 to 2 to this power.
RANK_BITS = 4
CLUSTERED = ("state", "severity", "incident_context", "hour_of_day")


def write_clustered(
    df: DataFrame, path: str, by: Sequence[str] = CLUSTERED, spread_by: str = "id", files: int | None = None
) -> DataFrame:
    """The table as a new version in which each file holds few values of every column in ``by``.

    Values become ranks by the share of rows before them, and a row's place is
    the Morton code of its ranks: files are ranges of it, so their minima and
    maxima let a filter on any one of the columns, or on several, skip most of
    them. A hash after the code cuts a frequent one over many files. Columns of
    more than MOST_VALUES values stop the job; NULL ranks first.
    """
    spark = df.sparkSession
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in by]
    counts = df.select(F.inline(F.array(*cells))).groupBy("column_name", "value").agg(F.count("*").alias("n"))
    found = counts.limit(len(by) * MOST_VALUES + 1).collect()
    ranked = df
    for i, c in enumerate(by):
        values = [(r["value"], r["n"]) for r in found if r["column_name"] == c]
        if len(values) > MOST_VALUES or len(found) > len(by) * MOST_VALUES:
            raise ValueError(f"{c} has too many values to cluster on")
        text = isinstance(df.schema[c].dataType, T.StringType)
        values.sort(key=lambda v: (v[0] is not None, (v[0] if text else _number(v[0])) if v[0] is not None else 0))
        total, before, ranks = sum(n for _, n in values), 0, []
        for value, n in values:
            ranks.append((value, min((1 << RANK_BITS) - 1, ((2 * before + n) << RANK_BITS) // (2 * total))))
            before += n
        names = spark.createDataFrame(ranks, f"_value{i} string, _rank{i} int")
        ranked = ranked.join(F.broadcast(names), F.col(c).cast("string").eqNullSafe(F.col(f"_value{i}")), "left")
    # the first column decides first
    code = morton([F.coalesce(F.col(f"_rank{i}"), F.lit(0)) for i in reversed(range(len(by)))], RANK_BITS)
    placed = ranked.withColumn("_code", code).repartitionByRange(files or ranges_of(df), "_code", F.xxhash64(spread_by))
    return publish(placed.sortWithinPartitions("_code", *by).select(*df.columns), path)


def _number(text: str) -> float:
    return {"true": 1.0, "false": 0.0}.get(text) if text in ("true", "false") else float(text)


#: Rows of a row group where single rows are looked up.
GROUP_ROWS = 20_000


def write_lookup(
    df: DataFrame, path: str, keys: Sequence[str] = ("id", "city"), rows: int = GROUP_ROWS, distinct: int | None = None
) -> DataFrame:
    """The table as a new version with small row groups and a Bloom filter of each of ``keys`` in them.

    A filter for one value of a key then reads the row groups that hold it, and
    about one in a hundred others, wherever the rows lie. ``distinct`` is how
    many values a row group holds at most, by default its rows.
    """
    options = {"parquet.block.row.count.limit": rows}
    for key in keys:
        options[f"parquet.bloom.filter.enabled#{key}"] = True
        options[f"parquet.bloom.filter.expected.ndv#{key}"] = distinct or rows
    return publish(df, path, options=options)


#: How many times the mean a bucket may hold by one key, before bucketing would leave one task with too much.
HOT_BUCKET = 4


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """``df`` as catalog table ``name`` in ``buckets`` by the hash of ``key``, sorted by it, at ``path``.

    Tables bucketed alike are joined on the key without a shuffle. As Spark
    cannot split a bucket, a key that alone fills one of the table's size
    HOT_BUCKET times over stops the job: such tables are better joined by a
    shuffle, where skew is split.
    """
    spark = df.sparkSession
    most, rows = df.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n"), F.sum("n")).collect()[0]
    if rows and most > HOT_BUCKET * max(1, rows // buckets):
        raise ValueError(f"one value of {key} has {most} of {rows} rows; bucketing would leave them to one task")
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).mode("overwrite").saveAsTable(name)
    return spark.table(name)


def verify_load(df: DataFrame, top: int = 5) -> DataFrame:
    """Row count, rows per severity and the states with most rows, in one table.

    One scan: rows are counted per (state, severity) and the small result is
    added up three ways.
    """
    cells = df.groupBy("state", "severity").agg(F.count("*").alias("n"))
    headings = {"total": F.lit("all"), "severity": F.col("severity").cast("string"), "state": F.col("state")}
    facets = F.array(
        *[F.struct(F.lit(section).alias("section"), value.alias("value")) for section, value in headings.items()]
    )
    sums = (
        cells.select(F.explode(facets).alias("f"), "n")
        .groupBy("f.section", "f.value")
        .agg(F.sum("n").alias("row_count"))
    )
    states = sums.filter("section = 'state'").orderBy(F.desc("row_count"), F.asc("value")).limit(top)
    return sums.filter("section <> 'state'").unionByName(states)


def stage(table: DataFrame) -> DataFrame:
    """Every column by name, with ``id`` as ``accident_id`` and wall-clock times."""
    times = ("start_time", "end_time", "weather_timestamp")
    return table.selectExpr(
        "id AS accident_id", *[f"CAST({c} AS timestamp_ntz) AS {c}" if c in times else c for c in TABLE_COLUMNS]
    )


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Writes a model as a new version of its table and returns it as read from there."""
    return publish(df, path)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The one place that maps a model name to its files: the version committed last, or plain files."""
    path = f"{root.rstrip('/')}/{name}"
    return read_version(spark, path) if is_versioned(spark, path) else spark.read.parquet(path)
