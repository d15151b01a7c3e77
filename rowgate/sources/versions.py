"""Versions of tables that change together, committed at once.

Each run writes to new folders, ``<folder>/<id>``: the clean stage one among the clean tables and
one among the quarantined ones, a versioned gold table one of its own. They become the
current version by one small file, ``<first folder>/_versions/<number>.json``, which holds the id and
the manifest: it is written beside and renamed to the next number. Readers take the highest
number, so they see all folders of a run or none, at every moment and after every failure.
Nothing large is renamed, and older versions stay readable until ``expire`` deletes them. Of two
writers that commit the same number, the later one fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .buckets import read_bucketed
from .files import read_parquet, read_quarantine
from .runs import read_json, write_json
from .staging import file_system

LOG = "_versions"


class NewVersion:
    """A new folder in each of ``folders``, which become the current version on ``commit``."""

    def __init__(self, spark: SparkSession, *folders: str):
        self.spark, self.id = spark, uuid.uuid4().hex
        self.paths = [f"{folder.rstrip('/')}/{self.id}" for folder in folders]
        self.log = f"{folders[0].rstrip('/')}/{LOG}"
        self.committed = False
        self._next = 1 + max(_numbers(spark, folders[0]), default=0)

    def commit(self, manifest: Mapping) -> None:
        target = f"{self.log}/{self._next:08d}.json"
        beside = f"{self.log}/.{self.id}.json"
        write_json(self.spark, beside, {"version": self.id, **manifest})
        fs, new = file_system(self.spark, beside)
        _, name = file_system(self.spark, target)
        if fs.exists(name) or not fs.rename(new, name):
            raise RuntimeError(f"another run has committed {target} meanwhile")
        self.committed = True

    def discard(self) -> None:
        for path in (*self.paths, f"{self.log}/.{self.id}.json"):
            fs, folder = file_system(self.spark, path)
            fs.delete(folder, True)


@contextmanager
def new_version(spark: SparkSession, *folders: str) -> Iterator[NewVersion]:
    """Folders for a new version; gone at the end unless it was committed."""
    version = NewVersion(spark, *folders)
    try:
        yield version
    finally:
        if not version.committed:
            version.discard()


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    fs, log = file_system(spark, f"{folder.rstrip('/')}/{LOG}")
    if not fs.exists(log):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(log)]
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def manifests(spark: SparkSession, cleaned_dir: str) -> list[dict]:
    """The manifests of all versions, oldest first."""
    log = f"{cleaned_dir.rstrip('/')}/{LOG}"
    return [read_json(spark, f"{log}/{number:08d}.json") for number in _numbers(spark, cleaned_dir)]


def read_manifest(spark: SparkSession, cleaned_dir: str, version: str | None = None) -> dict:
    """The manifest of the current version, or of the one with this id; empty if there is none."""
    if version is None:
        last = max(_numbers(spark, cleaned_dir), default=None)
        return {} if last is None else read_json(spark, f"{cleaned_dir.rstrip('/')}/{LOG}/{last:08d}.json")
    found = [m for m in manifests(spark, cleaned_dir) if m["version"] == version]
    if not found:
        raise FileNotFoundError(f"{cleaned_dir} has no version {version}")
    return found[0]


def read_clean(spark: SparkSession, cleaned_dir: str, table: str, version: str | None = None) -> DataFrame:
    """A clean table of the current version, or of the one with this id.

    If the clean stage bucketed the table, plans know. Where a folder has no versions, its tables are taken
    as they lie in it.
    """
    manifest = read_manifest(spark, cleaned_dir, version)
    path = "/".join(filter(None, (cleaned_dir.rstrip("/"), manifest.get("version"), table)))
    dealt = manifest.get("bucketed", {}).get(table)
    if dealt is None:
        return read_parquet(spark, path)
    return read_bucketed(spark, path, StructType.fromJson(dealt["schema"]), dealt["key"], manifest["buckets"])


def read_unbucketed(spark: SparkSession, cleaned_dir: str, table: str, version: str | None = None) -> DataFrame:
    """The rows of ``read_clean`` whose scan may be split anywhere, also where the table is bucketed."""
    version = version or read_manifest(spark, cleaned_dir).get("version")
    return read_parquet(spark, "/".join(filter(None, (cleaned_dir.rstrip("/"), version, table))))


def read_version(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    """A versioned table: its current version, or the one with this id."""
    return read_clean(spark, folder, "", version)


def read_rejected(
    spark: SparkSession, cleaned_dir: str, quarantine_dir: str, table: str, version: str | None = None, lines: bool = False
) -> DataFrame:
    """The rejected rows of the version that the clean table is of, with their reason.

    ``lines`` adds the column ``_malformed`` with the lines that were rejected as malformed.
    """
    version = version or read_manifest(spark, cleaned_dir).get("version")
    schema = read_clean(spark, cleaned_dir, table, version).schema
    path = "/".join(filter(None, (quarantine_dir.rstrip("/"), version, table)))
    return read_quarantine(spark, path, schema, lines)


def expire(spark: SparkSession, *folders: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` versions, which must not be read any more; their ids.

    ``folders`` are those of the commits, the one with the log first: the clean and the
    quarantined tables, or a versioned table alone.
    """
    if keep < 1:
        raise ValueError("the current version stays")
    home, gone = folders[0].rstrip("/"), []
    for number in _numbers(spark, home)[:-keep]:
        entry = f"{home}/{LOG}/{number:08d}.json"
        version = read_json(spark, entry)["version"]
        # First the entry: a version that is listed is whole.
        for path in (entry, *(f"{folder.rstrip('/')}/{version}" for folder in folders)):
            fs, place = file_system(spark, path)
            fs.delete(place, True)
        gone.append(version)
    return gone
