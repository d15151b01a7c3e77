"""Delimited text in, Parquet in and out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.names import named
from ..operators.positions import with_positions
from ..operators.split import MALFORMED, MALFORMED_ROW, POSITION, REASON, UNNAMED
from .headers import files_by_header
from .runs import aside, move

_RAW = "_malformed_line"


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    absent: Literal["null", "raise"] = "null",
    malformed: Literal["keep", "mark"] = "keep",
    positions: bool = False,
    **options,
) -> DataFrame:
    """Delimited text with a header per file; every column is a string.

    Columns are matched by name: each file is read by its own header, so files may have their
    columns in any order. The columns are those of all files, in the order of the first one, in any
    letter case unless ``spark.sql.caseSensitive`` is set. A column that a file does not have is
    null there, or raises ``ValueError`` with ``absent="raise"``.

    A line with more or fewer fields than its file's header is malformed. It is kept with the
    fields it has; ``malformed="mark"`` adds a column ``_malformed`` with the whole line, so that
    nothing is lost and ``tag_table`` can reject it; of well-formed lines it is null.
    ``positions`` adds the place of each row as ``with_positions`` does.

    ``options`` are Spark's own (``multiLine``, ``escape``, ``encoding``, ``mode`` ...). With
    ``header=False``, and for a header of several lines, columns are read by position.
    """
    paths = [path] if isinstance(path, str) else list(path)
    options = {"header": True, "inferSchema": False, **options}
    groups = files_by_header(spark, paths, options) if str(options["header"]).lower() == "true" else {}
    if not groups:
        plain = spark.read.options(**options).csv(paths)
        marked = plain.withColumn(MALFORMED, F.lit(None).cast(_MARK)) if malformed == "mark" else plain
        return with_positions(marked) if positions else marked
    names = _all_names(spark, groups, absent)
    several = sum(map(len, groups.values())) > 1
    scans = []
    for header, files in groups.items():
        schema = StructType()
        for name in header:
            schema.add(name, StringType())
        if malformed == "mark":
            schema.add(_RAW, StringType())
        scan = spark.read.options(**options, columnNameOfCorruptRecord=_RAW).schema(schema).csv(files)
        if positions:
            scan = with_positions(scan, several)
        own = {_key(spark, name): name for name in header}
        value = lambda n: named(own[k]).alias(n) if (k := _key(spark, n)) in own else F.lit(None).cast("string").alias(n)  # noqa: B023, E731
        columns: list[Column] = [value(name) for name in names]
        if malformed == "mark":
            columns.append(F.when(F.col(_RAW).isNotNull(), F.struct(F.col(_RAW).alias("line"))).alias(MALFORMED))
        scans.append(scan.select(*columns, *([POSITION] if positions else [])))
    return reduce(DataFrame.unionAll, scans)


_MARK = "struct<line: string>"


def _key(spark: SparkSession, name: str) -> str:
    return name if spark.conf.get("spark.sql.caseSensitive") == "true" else name.lower()


def _all_names(spark: SparkSession, groups: dict[tuple[str, ...], list[str]], absent: str) -> list[str]:
    """The names of all headers, those of the first file first."""
    names: dict[str, str] = {}
    first = min(groups, key=lambda header: groups[header][0])
    for header in [first, *groups]:
        for name in header:
            names.setdefault(_key(spark, name), name)
    if absent == "raise":
        for header, files in groups.items():
            own = {_key(spark, name) for name in header}
            if missing := [name for key, name in names.items() if key not in own]:
                raise ValueError(f"{files[0]} has no column {', '.join(missing)}")
    return list(names.values())


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Write the table; what the path held is there until all of the new one is."""
    with aside(df.sparkSession, path) as new:
        df.write.parquet(new.path)
        new.swap()


@dataclass(frozen=True)
class SplitCounts:
    """What the job that wrote a split counted; ``by_reason`` has the declared reasons that occurred."""

    rows: int
    accepted: int
    by_reason: dict[str, int]

    @property
    def rejected(self) -> int:
        return self.rows - self.accepted


def write_split(
    tagged: DataFrame, clean_path: str, quarantine_path: str, reasons: Sequence[str] | None = None
) -> SplitCounts:
    """Write the accepted rows to one new path, the rejected ones by reason to another.

    One pass: the rows are written partitioned by reason, and the partition of those without
    a reason is the clean table. The reason is a folder of the quarantine, no column of the
    clean files. Lines marked as malformed are written by a pass of their own, which keeps the
    line, to the folder of their reason.

    The job that writes also counts, so nothing is read again. ``reasons`` are the ones that may
    occur; if they are given, any other raises. An empty reason is none, but its rows are
    rejected: Spark would write them to the folder of the accepted ones, so they get one that says so.
    """
    spark = tagged.sparkSession
    marked = MALFORMED in tagged.columns
    known = list(dict.fromkeys([*([UNNAMED] if reasons is None else reasons), *([MALFORMED_ROW] if marked else [])]))
    reason, seen = F.col(REASON), Observation()
    rows = tagged.drop(POSITION).withColumn(REASON, F.when(F.trim(reason) == "", F.lit(UNNAMED)).otherwise(reason))
    watched = rows.observe(
        seen,
        F.count(F.lit(1)).alias("rows"), F.count_if(reason.isNull()).alias("accepted"),
        *(F.count_if(reason == r).alias(f"reason {i}") for i, r in enumerate(known)),
    )
    whole = watched.where(F.col(MALFORMED).isNull()).drop(MALFORMED) if marked else watched
    whole.write.partitionBy(REASON).parquet(quarantine_path)
    counted = seen.get
    counts = SplitCounts(
        counted["rows"], counted["accepted"],
        {r: n for i, r in enumerate(known) if (n := counted[f"reason {i}"])},
    )
    if reasons is not None and counts.rejected != sum(counts.by_reason.values()):
        raise ValueError(f"{counts.rejected} rows are rejected, for other reasons than {counts.by_reason}")
    kept = f"{quarantine_path}/{REASON}=__HIVE_DEFAULT_PARTITION__"
    if not move(spark, kept, clean_path):
        whole.drop(REASON).where("false").write.parquet(clean_path)
    if marked and MALFORMED_ROW in counts.by_reason:
        lines = rows.where(F.col(MALFORMED).isNotNull()).drop(REASON)
        lines.write.parquet(f"{quarantine_path}/{REASON}={MALFORMED_ROW}")
    return counts


def read_quarantine(spark: SparkSession, path: str, schema: StructType, lines: bool = False) -> DataFrame:
    """Rejected rows of columns ``schema``, with ``rejection_reason``; with ``lines``, malformed lines too.

    ``_malformed`` then holds the line as it stood in the file.
    """
    fields = StructType(schema.fields)
    if lines:
        fields = fields.add(MALFORMED, StructType().add("line", "string"))
    return spark.read.schema(fields.add(REASON, "string")).parquet(path)
