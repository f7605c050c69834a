"""Intermediate tables in the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
#: Has Spark delete a query's shuffle files when it ends; what is written is read from the table from then on.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where none is set, a temporary one, on one machine only: other nodes couldn't read it."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="gridloom-")
    return _OWN[app]


class Scratch:
    """Writes intermediate results as Parquet tables, so that a lost executor costs no recomputation, and drops them again.

    What the returned, still lazy frame reads goes when the process ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self._n = 0
        self._open: dict[str, list[str]] = {}
        atexit.register(self._delete, self.root)

    def write(self, frame: DataFrame, name: str = "t") -> str:
        path = f"{self.root}/{name}/{self._n:03d}"
        self._n += 1
        before = self.spark.conf.get(_CLEANUP, "false")
        self.spark.conf.set(_CLEANUP, "true")
        try:
            frame.write.parquet(path, compression="zstd")
        finally:
            self.spark.conf.set(_CLEANUP, before)
        self._open.setdefault(name, []).append(path)
        return path

    def table(self, frame: DataFrame, name: str = "t") -> DataFrame:
        schema = frame.schema
        return self.spark.read.schema(schema).parquet(self.write(frame, name))

    def add(self, frame: DataFrame, name: str) -> DataFrame:
        """Adds rows to what has been written under this name; returns all of it, as one table."""
        schema = frame.schema
        self.write(frame, name)
        return self.spark.read.schema(schema).parquet(*self._open[name])

    def rows(self, name: str) -> int:
        """Rows that have been written under this name, from the files' own counts."""
        return self.spark.read.parquet(*self._open[name]).count() if name in self._open else 0

    def release(self, *names: str) -> None:
        """Drops the tables of these names."""
        for name in names:
            for path in self._open.pop(name, []):
                self._delete(path)

    def drop(self, path: str) -> None:
        self._delete(path)

    def _delete(self, path: str) -> None:
        try:
            jvm = self.spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the context has ended; the cluster's own cleaning takes the folder
            pass
