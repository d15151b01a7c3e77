"""Folders that change as a whole.

What is written goes to a new folder beside the target. When all of it is there and has been
compared, it takes the place of the target by renaming; until then readers see the old
content, and after a failure they go on seeing it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from .staging import file_system


class Aside:
    """A new folder beside ``target``, which it replaces on ``swap``."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")
        parent, _, name = self.target.rpartition("/")
        mark = uuid.uuid4().hex
        self.path, self._old = (f"{parent}/_{name}-{part}-{mark}" for part in ("new", "old"))

    def swap(self) -> None:
        fs, new = file_system(self.spark, self.path)
        _, target = file_system(self.spark, self.target)
        _, old = file_system(self.spark, self._old)
        had_one = fs.exists(target)
        if had_one and not fs.rename(target, old):
            raise OSError(f"{self.target} cannot be moved")
        if not fs.rename(new, target):
            if had_one:
                fs.rename(old, target)
            raise OSError(f"{self.path} cannot be moved to {self.target}")
        if had_one:
            fs.delete(old, True)

    def discard(self) -> None:
        fs, new = file_system(self.spark, self.path)
        fs.delete(new, True)


@contextmanager
def aside(spark: SparkSession, target: str) -> Iterator[Aside]:
    """A folder beside ``target``; gone at the end unless it was swapped in."""
    folder = Aside(spark, target)
    try:
        yield folder
    finally:
        folder.discard()


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder; false if it is not there."""
    fs, old = file_system(spark, source)
    return fs.exists(old) and fs.rename(old, file_system(spark, target)[1])


def write_json(spark: SparkSession, file: str, content: dict) -> None:
    fs, path = file_system(spark, file)
    out = fs.create(path, True)
    try:
        out.write(bytearray(json.dumps(content, indent=1).encode()))
    finally:
        out.close()


def read_json(spark: SparkSession, file: str) -> dict:
    fs, path = file_system(spark, file)
    stream = fs.open(path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
