"""Session settings and input parallelism."""

from __future__ import annotations

import os
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# HotSpot compiles no method above 8000 bytes of bytecode. The clean-up of a wide table
# fused into one generated method is larger and would run interpreted, so beyond the limit
# Spark shall generate one method per group of expressions instead.
#
# Rows that are bucketed by the task that wrote them meet their reasons by task and number; Spark
# leaves them where they are only if it may join by a part of the columns that rows are dealt by.
#
# A task holds a few buckets of such rows, so they need no sort by bucket when they are written.
SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}


def tune(spark: SparkSession) -> None:
    """Apply the session settings the library is written for; for whoever owns the session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str] = SETTINGS) -> Iterator[None]:
    """Session settings for the jobs within, put back afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def spread(scan: DataFrame) -> DataFrame:
    """Spread a scan of few partitions over the cores; leave any other as it is.

    A file that cannot be split, or is one row group, would otherwise be parsed by one
    core. A scan with work for half of the cores or more is not shuffled. Positions are added
    before, so the rows come out the same either way. For plain scans only: asking a plan
    with shuffles for its partitions would run them.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    parts = scan._jdf.queryExecution().toRdd().getNumPartitions()
    return scan.repartition(cores) if parts * 2 <= cores else scan


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder the driver has it in.

    For workers that see the driver's folders, as in local mode; on a cluster the package is
    installed or sent with ``--py-files``, and a path that is not there does no harm.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
