"""Tables that are refreshed by version: rows are written beside the old ones, then one rename makes them the table.

A table is a folder with a folder of rows per version and, under ``_commits``, a
numbered file per commit that names its version. The highest number counts. A
job that fails leaves no commit, so the table stays as it was; a reader holds on
to the version it found, whose files never change. The rename has to be atomic
and to fail where the name is taken, as on HDFS and local disks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

COMMITS = "_commits"
#: Versions that stay readable after a refresh, the new one included.
KEPT = 2
TRIES = 20


class Conflict(RuntimeError):
    """Another refresh was committed first."""


class _Folder:
    """What versions need of a file system, by paths below one folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm = spark._jvm
        self.hadoop = self.jvm.org.apache.hadoop.fs
        self.root = root.rstrip("/")
        at = self.hadoop.Path(self.root)
        conf = spark._jsc.hadoopConfiguration()
        self.fs = at.getFileSystem(conf)
        self.context = self.hadoop.FileContext.getFileContext(self.fs.getUri(), conf)
        self.no_options = spark.sparkContext._gateway.new_array(getattr(self.hadoop, "Options$Rename"), 0)

    def path(self, *names: str):
        return self.fs.makeQualified(self.hadoop.Path("/".join((self.root, *names))))

    def names(self, *folder: str) -> list[str]:
        at = self.path(*folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, *names: str) -> str:
        stream = self.fs.open(self.path(*names))
        try:
            return self.jvm.java.io.BufferedReader(self.jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()

    def write(self, text: str, *names: str) -> None:
        stream = self.fs.create(self.path(*names), False)
        try:
            stream.write(bytearray(text + "\n", "utf-8"))
        finally:
            stream.close()

    def claim(self, old: str, new: str) -> bool:
        """Renames a file below COMMITS, unless the new name is taken."""
        try:
            self.context.rename(self.path(COMMITS, old), self.path(COMMITS, new), self.no_options)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def delete(self, *names: str) -> None:
        self.fs.delete(self.path(*names), True)


def _commits(folder: _Folder) -> list[str]:
    return [n for n in folder.names(COMMITS) if n.isdigit()]


def committed(spark: SparkSession, path: str) -> int:
    """The number of the last commit; 0 where there is none."""
    return int(max(_commits(_Folder(spark, path)), default="0"))


def is_versioned(spark: SparkSession, path: str) -> bool:
    return committed(spark, path) > 0


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table as last committed, or as commit ``number`` left it; later refreshes do not change the frame."""
    folder = _Folder(spark, path)
    commits = _commits(folder)
    name = max(commits, default=None) if number is None else f"{number:020d}"
    if name not in commits:
        raise ValueError(f"no committed version {number or ''} of {path}".replace("  ", " "))
    return spark.read.parquet(f"{folder.root}/{folder.read(COMMITS, name)}")


def publish(
    df: DataFrame, path: str, after: int | None = None, keep: int = KEPT, options: Mapping[str, object] | None = None
) -> DataFrame:
    """Replaces the table at ``path`` by ``df``, and returns it as read from its new version.

    ``df`` may read the table itself. With ``after``, the commit that ``df`` was
    made from, another refresh in between raises Conflict and changes nothing;
    without it the later commit counts. Of earlier versions ``keep`` - 1 stay for
    readers that still hold them. A failed job's files are removed, and its table
    is as it was. ``options`` are those of the Parquet writer.
    """

    def write(folder: str) -> None:
        df.write.options(**(options or {})).parquet(folder)

    spark = df.sparkSession
    return spark.read.parquet(_commit(spark, path, write, after, keep))


def publish_together(
    frames: Mapping[str, DataFrame], path: str, after: int | None = None, keep: int = KEPT
) -> dict[str, DataFrame]:
    """As ``publish``, for several frames that become the tables under ``path`` by one commit, or none of them."""

    def write(folder: str) -> None:
        for name, df in frames.items():
            df.write.parquet(f"{folder}/{name}")

    spark = next(iter(frames.values())).sparkSession
    version = _commit(spark, path, write, after, keep)
    return {name: spark.read.parquet(f"{version}/{name}") for name in frames}


def read_together(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of the last commit of ``publish_together`` by name; none if there is no commit."""
    folder = _Folder(spark, path)
    last = max(_commits(folder), default=None)
    if last is None:
        return {}
    version = folder.read(COMMITS, last)
    return {name: spark.read.parquet(f"{folder.root}/{version}/{name}") for name in folder.names(version)}


def _commit(spark: SparkSession, path: str, write: Callable[[str], None], after: int | None, keep: int) -> str:
    """Lets ``write`` fill a new folder and makes it the last version; gives that folder."""
    folder = _Folder(spark, path)
    version, claim = f"v-{uuid.uuid4().hex}", f".{uuid.uuid4().hex}"
    try:
        write(f"{folder.root}/{version}")
        folder.write(version, COMMITS, claim)
        for _ in range(TRIES):
            last = int(max(_commits(folder), default="0"))
            if after is not None and last != after:
                raise Conflict(f"{path} is at commit {last}, not {after}")
            if folder.claim(claim, f"{last + 1:020d}"):
                break
        else:
            raise Conflict(f"{path} was refreshed {TRIES} times meanwhile")
    except BaseException:
        folder.delete(version)
        folder.delete(COMMITS, claim)
        raise
    _drop(folder, keep)
    return f"{folder.root}/{version}"


def _drop(folder: _Folder, keep: int) -> None:
    """Deletes the rows of all but the last ``keep`` commits, then these commits."""
    old = _commits(folder)[: -max(1, keep)]
    for name in old:
        folder.delete(folder.read(COMMITS, name))
        folder.delete(COMMITS, name)
