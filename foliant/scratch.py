"""Tables written down once in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


_JOINS = "spark.sql.autoBroadcastJoinThreshold"
_TASKS = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def joins_by_size(spark: SparkSession) -> None:
    """Let tables be broadcast by the size that they turn out to have, not by that of their files, and only small ones.

    Spark takes the compressed bytes of a file, times the share of the chosen columns, for a table's size, so one key of millions
    of nested records passes for small and is gathered by the driver. Only files of 64 kB are broadcast by that estimate; what a shuffle
    has measured is broadcast up to 1 MB, for a load makes some hundred joins and the driver gathers each. A threshold that the session sets itself stays.
    """
    if spark.conf.get(_JOINS) in ("10485760", "10485760b", "10MB"):
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "1MB")
        spark.conf.set(_JOINS, "64KB")


def tasks_by_size(spark: SparkSession) -> None:
    """Let a task take 16 MB of a shuffle instead of 64, of which a grouping by fine keys makes gigabytes. A size that the session sets itself stays."""
    if spark.conf.get(_TASKS) in ("67108864", "67108864b", "64MB"):
        spark.conf.set(_TASKS, "16MB")


@lru_cache(maxsize=None)
def _local_folder() -> str:
    """One folder a driver process, removed at its end."""
    path = tempfile.mkdtemp(prefix="foliant-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return f"file://{path}"


class Scratch:
    """Tables that cut lineage, so that neither a second evaluation nor the loss of executors can change what they hold.

    The folder is spark.checkpoint.dir of the session. Where that is unset, a local session, whose executors are
    threads of the driver, gets a folder of its own; on a cluster it is an error, as executors have no common disk.
    Tables are deleted by drop() or else when the session ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            found, master = spark.sparkContext._jsc.sc().getCheckpointDir(), spark.sparkContext.master
            if found.isDefined():
                base = found.get()
            elif master == "local" or master.startswith("local["):
                base = _local_folder()
            else:
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        self.base = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        path, fs = self._at(self.base)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def _at(self, where: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").mode("overwrite").parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no later plan reads (all of them without a name)."""
        for name in names or [""]:
            path, fs = self._at(self.path(name) if name else self.base)
            fs.delete(path, True)
