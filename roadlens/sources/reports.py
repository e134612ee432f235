"""Reports as JSON lines, one object per column or value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report(df: DataFrame, path: str, source: str) -> None:
    """The report rows with the time they were made and what they describe."""
    stamped = df.withColumn("generated_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))
    stamped.withColumn("source_file", F.lit(source)).write.mode("overwrite").json(path)
