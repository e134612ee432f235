"""Surrogate keys from natural keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_key(columns: Sequence[str], null_as: str | None = "null") -> Column:
    """MD5 of the columns' text joined by ``|``; a column may be any SQL expression.

    A NULL part is written as ``null_as``; with ``null_as=None`` it makes the
    whole key NULL.
    """
    texts = [f"CAST({c} AS STRING)" for c in columns]
    if null_as is not None:
        texts = [f"coalesce({t}, '{null_as}')" for t in texts]
    return F.expr("md5(concat(" + ", '|', ".join(texts) + "))")
