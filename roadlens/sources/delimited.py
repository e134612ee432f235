"""Delimited text in and out."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.sources.quoted import first_lines, read_quoted
from roadlens.sources.schema import NULL_TOKENS, RENAME, TYPES, UNREADABLE, raw_schema, text_schema

QUOTING = {"quote": '"', "escape": '"'}
#: One record, which may hold line breaks as they are.
RECORD = {**QUOTING, "multiLine": "true", "lineSep": "\n"}
#: How times stand in files.
TIMES = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss", "timestampFormat": "yyyy-MM-dd HH:mm:ss"}
_MALFORMED = "_malformed"


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names from the first line of one file."""
    return spark.read.options(header=True, **QUOTING).csv(path).columns


def read_raw(spark: SparkSession, path: str, columns=None, multi_line: bool = True, lines: DataFrame | None = None) -> DataFrame:
    """Raw files with their types, every spelling of "missing" as NULL.

    Columns are found by the names in each file's header, in whatever order;
    with ``columns`` given, a file with another header stops the job. A row with
    a field that cannot be read as its type, or with too few or too many fields,
    is marked in the column UNREADABLE. Line breaks inside quotes are kept, and
    large files are cut over many tasks all the same (``read_quoted``): the lines
    are read once when this is called, and again with the result. Without
    ``multi_line`` a line is a row: only for data known to hold no line break in
    quotes, as the pieces of such a row are marked or dropped. ``lines`` are the
    lines of the files, if a stream has read them (``quoted.lines_of``).
    """
    if multi_line:
        found = [(_columns_of(q.header), q) for q in read_quoted(spark, path, lines)]
    else:
        found = [(_columns_of(h), files) for h, files in headers_of(spark, path).items()]
    if not found:
        raise ValueError(f"no file with a header under {path}")
    if columns and any(names != list(columns) for names, _ in found):
        raise ValueError(f"a header does not conform to the columns given: {path}")
    frames = []
    for names, files in found:
        schema = malformed_schema(names)
        reader = spark.read.options(header=True, multiLine=multi_line, **READING).schema(schema)
        if not multi_line:
            frames.append(reader.csv(files))
            continue
        record = F.from_csv("value", _ddl(schema), {**RECORD, **MALFORMED})
        frames.append(files.records.select(record.alias("record")).select("record.*"))
        if files.irregular:
            frames.append(reader.csv([_path_of(spark, f) for f in files.irregular]))
    return reduce(DataFrame.unionByName, [typed_raw(f) for f in frames])


def headers_of(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files under ``path`` by their first line, which tasks find; the driver opens none."""
    found: dict[str, list[str]] = {}
    for r in first_lines(spark, path).collect():
        found.setdefault(r["header"], []).append(_path_of(spark, r["file"]))
    return found


def _path_of(spark: SparkSession, file: str) -> str:
    """A path as readers take it, from one as rows name it."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)).toString()


def _columns_of(line: str) -> list[str]:
    return next(csv.reader([line.lstrip("\ufeff").rstrip("\r")]))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)


MALFORMED = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _MALFORMED}
READING = {**QUOTING, **MALFORMED, "enforceSchema": False}


def malformed_schema(columns) -> T.StructType:
    """All text, and a place for rows whose fields do not match the header."""
    return text_schema([*columns, _MALFORMED])


def typed_raw(text: DataFrame) -> DataFrame:
    """Rows read with ``malformed_schema``: numbers and flags cast, what could not be read marked."""
    blank = blank_missing(text)
    names = [c for c in text.columns if c != _MALFORMED]
    types = {f.name: f.dataType.simpleString() for f in raw_schema(names).fields}
    checked = {**types, "Weather_Timestamp": "timestamp_ntz"}
    bad = [f"`{c}` IS NOT NULL AND try_cast(`{c}` AS {checked[c]}) IS NULL" for c in names if checked[c] != "string"]
    unreadable = " OR ".join([f"{_MALFORMED} IS NOT NULL", *bad])
    casts = [f"`{c}`" if types[c] == "string" else f"try_cast(`{c}` AS {types[c]}) AS `{c}`" for c in names]
    return blank.selectExpr(*casts, f"({unreadable}) AS {UNREADABLE}")


def blank_missing(df: DataFrame) -> DataFrame:
    """NULL for every text that stands for a missing value."""
    tokens = ", ".join(f"'{t}'" for t in NULL_TOKENS)
    return df.selectExpr(
        *[f"`{c}`" if c == _MALFORMED else f"CASE WHEN `{c}` NOT IN ({tokens}) THEN `{c}` END AS `{c}`" for c in df.columns]
    )


def read_clean(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The clean file with its types; the postal code stays text, empty fields are NULL.

    A field that does not fit its type stops the job.
    """
    reader = spark.read.schema(text_schema(RENAME)).options(
        header=True, multiLine=multi_line, enforceSchema=False, mode="FAILFAST", **QUOTING
    )
    text = blank_missing(reader.csv(path))
    return text.selectExpr(*[f"CAST(`{raw}` AS {TYPES.get(name, 'string')}) AS `{raw}`" for raw, name in RENAME.items()])


def write_clean(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder of part files, each with the header; a failed task leaves no half file behind."""
    df.write.mode(mode).options(header=True, **QUOTING, **TIMES).csv(path)


def export_csv(df: DataFrame, path: str, null_value: str = "", order_by=()) -> None:
    """A mart as one file with a header, in the order given. Marts have at most some hundred rows."""
    one = df.repartition(1)
    if order_by:
        one = one.sortWithinPartitions(*order_by)
    one.write.mode("overwrite").options(header=True, nullValue=null_value, **QUOTING, **TIMES).csv(path)


def head(df: DataFrame, n: int) -> DataFrame:
    """Any first ``n`` rows, for a look at the data."""
    return df.limit(n)
