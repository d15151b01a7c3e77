"""Intermediate tables, written once to storage that every executor reaches.

A staged table ends the lineage, so a lost executor costs a re-read and not a
recomputation, and row ids or statistics taken from it cannot change between two
uses. Its true size is known to the optimizer, which therefore broadcasts it in a
join only while it is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles
otherwise.
"""

from __future__ import annotations

import atexit
import tempfile
import time
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession


def _shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.sparkContext.master.startswith("local")
    if folder:
        if not local and file_system(spark, folder)[0].getScheme() == "file":
            warnings.warn(f"{folder} is a local path: every executor must have the same storage mounted there")
        return folder
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="rowgate-")


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


#: When shuffle files were released last, and the least number of seconds in between.
_released, RELEASE_EVERY = 0.0, 10.0


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished writes.

    Spark does so once the driver has collected its garbage, which a driver with much free memory
    hardly does during a run; until then the disks hold the shuffles of all steps.
    """
    global _released
    if time.monotonic() - _released >= RELEASE_EVERY:
        _released = time.monotonic()
        spark.sparkContext._jvm.System.gc()


class StagingArea:
    """A new folder for the intermediate tables of one run.

    As a context, it is removed at the end, also after a failure. Otherwise a DataFrame that
    reads it may be used at any time, and it is removed when the program ends.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.path = f"{folder or _shared_folder(spark)}/rowgate-{uuid.uuid4().hex}"
        self._files, self._folder = file_system(spark, self.path)  # usable after the session
        if folder is None:
            atexit.register(self._remove_at_exit)
        self.tables: dict[str, DataFrame] = {}

    def __enter__(self) -> StagingArea:
        return self

    def __exit__(self, *_) -> None:
        self.remove()

    def _remove_at_exit(self) -> None:
        try:
            self.remove()
        except Exception as e:  # the JVM may be gone before us
            warnings.warn(f"{self.path} is left: {e}")

    def part(self, name: str) -> StagingArea:
        """An area of its own for one table, within this folder."""
        return StagingArea(self.spark, f"{self.path}/{name}")

    @classmethod
    def for_frame(cls, df: DataFrame, area: StagingArea | None = None) -> StagingArea:
        return area or cls(df.sparkSession)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the written table, also kept in ``tables``."""
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        release_shuffles(self.spark)
        self.tables[name] = self.spark.read.schema(df.schema).parquet(path)
        return self.tables[name]

    def remove(self) -> None:
        """Delete the folder; every table staged here becomes unreadable."""
        atexit.unregister(self._remove_at_exit)
        self._files.delete(self._folder, True)
