"""Raw files cleaned piece by piece and appended.

The steps of cleaning look at one row only, so the batch functions serve a
stream unchanged. The stream reads the files as lines, which Spark cuts into
splits however large a file is; each batch puts its records together as the
batch reader does (``read_raw``). The checkpoint records which files are done:
a restarted run goes on after them, and a batch that is run again replaces
its own folder, so nothing is appended twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadlens.plans.cleaning import clean
from roadlens.sources.delimited import read_raw


def clean_arrivals(
    spark: SparkSession, folder: str, columns: Sequence[str], out: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Cleans the files in ``folder`` that are not done yet, appends to ``out`` and stops.

    A file whose header is not ``columns`` stops the query before anything of its batch is written.
    """
    lines = (
        spark.readStream.options(lineSep="\n", maxFilesPerTrigger=files_per_batch)
        .text(folder)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    )

    def append(batch: DataFrame, batch_id: int) -> None:
        rows = clean(read_raw(batch.sparkSession, folder, list(columns), lines=batch))
        rows.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch_id}")

    return lines.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
