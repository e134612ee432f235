"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# The rows are wide. Code generated for a whole stage of them can be a method of
# more than 8000 bytes, which the JVM never compiles; up to that limit Spark
# generates one method per stage, beyond it one per expression.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
DEFAULTS = {
    **TUNING,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Gives a session that was made elsewhere the settings the plans are written for."""
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "roadlens", **conf: str) -> SparkSession:
    """A session with this library's defaults; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors can reach.

    Where it is unset, a local session gets a folder of its own, which goes when
    Python ends; a cluster has to name one, as its executors share no local disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _own_folder()


@lru_cache(maxsize=1)
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="roadlens-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several branches read one result: the work before it runs once,
    later branches read only their columns, and a lost executor cannot change
    or undo what was written. The shuffle files of the work are deleted as soon
    as it is written; ``discard`` deletes what was written when nothing reads it
    any more.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/roadlens-{uuid.uuid4().hex}"
    with _freeing_shuffles(spark):
        df.write.parquet(path)
    settled = spark.read.schema(df.schema).parquet(path)
    settled.settled_at = path
    return settled


@contextmanager
def _freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Spark deletes shuffle files of queries run meanwhile when they end, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def discard(settled: DataFrame) -> None:
    """Deletes what ``settle`` wrote for the frame it returned."""
    jvm, conf = settled.sparkSession._jvm, settled.sparkSession._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(settled.settled_at)
    path.getFileSystem(conf).delete(path, True)
