"""Quality checks over whole tables, reported as rows of one long table.

A check counts the rows that fail it. All checks of a table that look at one row at a
time are counted by a single aggregation; duplicates and foreign keys each add one
aggregation by key. Ranges of typed columns that no other check needs are counted by a filter
that file statistics decide: row groups within the limits are not read. Samples of failing ids are taken only for checks that failed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DateType, DoubleType, IntegerType, LongType, ShortType

from .. import fixed_values as fixed
from ..functions.dates import iso_date
from ..functions.names import named, own_name
from ..functions.numbers import to_double
from ..functions.text import mask_id
from ..sources.staging import StagingArea
from .footers import has_statistics
from .outliers import Moments, is_outlier, moments
from .references import orphan_keys
from .rules import outside

CHECK_RESULTS = (
    "run_id string, table string, check string, ord int, kind string, row_count long, "
    "fail_count long, pass boolean, sample_ids array<string>"
)


@dataclass(frozen=True)
class Check:
    """One named expectation about a column."""

    name: str
    column: str

    kind = "check"
    sampled = True


class RowCheck(Check):
    """A check that one row passes or fails on its own."""

    def fails(self, stats: Moments) -> Column:
        raise NotImplementedError

    def beyond(self, kind: DataType) -> Column | None:
        """The same for a column of this type as a comparison that file statistics can decide, if it is one."""
        return None


def _beyond(c: Column, low, high) -> Column | None:
    sides = [c < F.lit(low)] if low is not None else []
    sides += [c > F.lit(high)] if high is not None else []
    return reduce(or_, sides) if sides else None


@dataclass(frozen=True)
class NotNull(RowCheck):
    kind = "null"
    sampled = False

    def fails(self, stats: Moments) -> Column:
        return named(self.column).isNull()


@dataclass(frozen=True)
class DateBetween(RowCheck):
    """Date, or ISO text, in a closed range; NULL passes."""

    earliest: str | None = None
    latest: str | None = None

    kind = "date_range"

    def fails(self, stats: Moments) -> Column:
        def bound(day):
            return None if day is None else F.lit(day).cast("date")

        return outside(
            iso_date(named(self.column)), bound(self.earliest), bound(self.latest)
        )

    def beyond(self, kind: DataType) -> Column | None:
        if not isinstance(kind, DateType):
            return None
        days = (None if day is None else F.lit(day).cast("date") for day in (self.earliest, self.latest))
        return _beyond(named(self.column), *days)


@dataclass(frozen=True)
class NumberBetween(RowCheck):
    """Number in a closed range; NULL passes."""

    low: float | None = None
    high: float | None = None

    kind = "numeric_range"

    def fails(self, stats: Moments) -> Column:
        return outside(to_double(named(self.column)), self.low, self.high)

    def beyond(self, kind: DataType) -> Column | None:
        numbers = (ByteType, DoubleType, IntegerType, LongType, ShortType)
        return _beyond(named(self.column), self.low, self.high) if isinstance(kind, numbers) else None


@dataclass(frozen=True)
class NoOutliers(RowCheck):
    """|z| at most the threshold, by the table's own mean and deviation."""

    threshold: float = fixed.Z_THRESHOLD

    kind = "zscore"
    sampled = False

    def fails(self, stats: Moments) -> Column:
        return is_outlier(self.column, stats, self.threshold)


@dataclass(frozen=True)
class Pattern(RowCheck):
    """Text that matches the pattern; NULL passes."""

    pattern: str = ""

    kind = "pattern"

    def fails(self, stats: Moments) -> Column:
        return F.coalesce(~named(self.column).rlike(self.pattern), F.lit(False))


@dataclass(frozen=True)
class UniqueKey(Check):
    """No key more than once; counts the rows beyond the first of each key."""

    kind = "duplicate"


@dataclass(frozen=True)
class HasParent(Check):
    """Every value of the column is a key of the parent table; NULL fails."""

    parent: str = ""
    parent_key: str | None = None

    kind = "foreign_key"


@dataclass(frozen=True)
class Suite:
    """The checks of one table, in report order; ``key`` names the sampled ids."""

    table: str
    key: str
    checks: Sequence[Check]


def _entry(suite: Suite, check: Check, n: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check"),
        F.lit(suite.checks.index(check)).alias("ord"),
        F.lit(check.kind).alias("kind"),
        n.alias("n"),
    )


def _decided_by_files(df: DataFrame, suite: Suite) -> dict[str, Column]:
    """The checks that statistics of files can decide, and that need columns of their own."""
    if not has_statistics(df):
        return {}
    rows = [c for c in suite.checks if isinstance(c, RowCheck)]
    found = {}
    for check in rows:
        beyond = check.beyond(df.schema[own_name(df, check.column)].dataType)
        if beyond is not None:
            found[check.name] = beyond
    read_anyway = {c.column.lower() for c in rows if c.name not in found}
    return {c.name: found[c.name] for c in rows if c.name in found and c.column.lower() not in read_anyway}


def _filtered_counts(df: DataFrame, suite: Suite, beyond: Mapping[str, Column]) -> DataFrame:
    """Counts of the rows beyond limits; files and row groups without any are not read."""
    checks = [c for c in suite.checks if c.name in beyond]
    counted = df.where(reduce(or_, (beyond[c.name] for c in checks))).agg(
        *(F.count_if(beyond[c.name]).alias(f"c{i}") for i, c in enumerate(checks))
    )
    return counted.select(F.inline(F.array(*(_entry(suite, c, F.col(f"c{i}")) for i, c in enumerate(checks)))))


def _row_counts(df: DataFrame, suite: Suite, stats: Moments, without: Mapping[str, Column] | None = None) -> DataFrame:
    """Counts of the row checks, and the row count of the table under a NULL check."""
    checks = [c for c in suite.checks if isinstance(c, RowCheck) and c.name not in (without or {})]
    one_row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(c.fails(stats)).alias(f"c{i}") for i, c in enumerate(checks)),
    )
    text, number = F.lit(None).cast("string"), F.lit(None).cast("int")
    total = F.struct(
        text.alias("check"), number.alias("ord"), text.alias("kind"), F.col("rows").alias("n")
    )
    counted = [_entry(suite, c, F.col(f"c{i}")) for i, c in enumerate(checks)]
    return one_row.select(F.inline(F.array(total, *counted)))


def _duplicate_groups(df: DataFrame, column: str) -> DataFrame:
    counted = df.groupBy(named(column).alias("id")).agg(F.count(F.lit(1)).alias("copies"))
    return counted.where(F.col("copies") > 1)


def _duplicate_count(df: DataFrame, check: UniqueKey) -> DataFrame:
    extra = F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))
    return _duplicate_groups(df, check.column).agg(extra.alias("n"))


def _orphan_count(df: DataFrame, check: HasParent, parents: Mapping[str, DataFrame]) -> DataFrame:
    # Counted per key before the join: a hot key or NULL is one row per task by then.
    used = df.groupBy(named(check.column).alias("_used")).agg(F.count(F.lit(1)).alias("rows"))
    known = parents[check.parent].select(named(check.parent_key or check.column).alias("_known"))
    orphans = used.join(known, F.col("_used") == F.col("_known"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))


def _count_table(df: DataFrame, suite: Suite, parents: Mapping[str, DataFrame]) -> DataFrame:
    outlier_columns = [c.column for c in suite.checks if isinstance(c, NoOutliers)]
    by_files = _decided_by_files(df, suite)
    parts = [_row_counts(df, suite, moments(df, dict.fromkeys(outlier_columns)), by_files)]
    if by_files:
        parts.append(_filtered_counts(df, suite, by_files))
    for check in suite.checks:
        if isinstance(check, UniqueKey):
            counted = _duplicate_count(df, check)
        elif isinstance(check, HasParent):
            counted = _orphan_count(df, check, parents)
        else:
            continue
        parts.append(counted.select(F.inline(F.array(_entry(suite, check, F.col("n"))))))
    return reduce(DataFrame.unionByName, parts).withColumn("table", F.lit(suite.table))


def _lowest(failing: DataFrame, size: int) -> DataFrame:
    """The ``size`` lowest ids of each check; each task sends at most ``size`` per check."""
    rank = F.row_number().over(Window.partitionBy("check").orderBy(F.col("id").asc_nulls_last()))
    lowest = failing.withColumn("rank", rank).where(F.col("rank") <= size)
    return lowest.select("check", "rank", F.col("id").cast("string"))


def _samples(
    df: DataFrame,
    suite: Suite,
    failed: set[str],
    parents: Mapping[str, DataFrame],
    area: StagingArea,
    size: int,
) -> DataFrame | None:
    """(table, check, sample_ids) for the failed checks that are sampled, else None.

    One scan of the table tells the rows that fail row checks and those without a parent, by
    the short lists of missing parents; repeated keys are found by one grouping of that column.
    """
    checks = [c for c in suite.checks if c.name in failed and c.sampled]
    parts = []
    key = named(suite.key).alias("id")
    scan, fails = df, []
    for i, check in enumerate(checks):
        if isinstance(check, RowCheck):
            fails.append(F.when(check.fails({}), F.lit(check.name)))
        elif isinstance(check, HasParent):
            orphans = orphan_keys(
                df, check.column, parents[check.parent], check.parent_key or check.column
            )
            orphans = area.stage(orphans, "orphan-keys").withColumnRenamed("_orphan", f"_orphan_{i}")
            scan = scan.join(orphans, named(check.column) == F.col(f"_orphan_{i}"), "left")
            missing = named(check.column).isNull() | F.col(f"_orphan_{i}").isNotNull()
            fails.append(F.when(missing, F.lit(check.name)))
        elif isinstance(check, UniqueKey):
            repeated = _duplicate_groups(df, check.column)
            parts.append(_lowest(repeated.select(F.lit(check.name).alias("check"), "id"), size))
    if fails:
        failing = scan.select(F.explode(F.array_compact(F.array(*fails))).alias("check"), key)
        parts.append(_lowest(failing.where(F.col("id").isNotNull()), size))
    if not parts:
        return None
    ranked = F.array_sort(F.collect_list(F.struct("rank", mask_id(F.col("id")).alias("id"))))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("check")
        .agg(ranked.getField("id").alias("sample_ids"))
        .select(F.lit(suite.table).alias("table"), "check", "sample_ids")
    )


def run_checks(
    tables: Mapping[str, DataFrame],
    suites: Sequence[Suite],
    run_id: str,
    sample_size: int = fixed.SAMPLE_SIZE,
    area: StagingArea | None = None,
) -> DataFrame:
    """Check results, one row per check, of all suites over their tables.

    The counts of all tables are one job. They are one row per declared check, and are
    looked at here only to see which checks need samples; ``sample_size=0`` takes none.
    """
    spark = next(iter(tables.values())).sparkSession
    area = area or StagingArea(spark)
    counts = reduce(
        DataFrame.unionByName, (_count_table(tables[s.table], s, tables) for s in suites)
    )
    counts = area.stage(counts.coalesce(1), "check-counts")
    failed: dict[str, set[str]] = {s.table: set() for s in suites}
    if sample_size:
        for row in counts.where(F.col("check").isNotNull() & (F.col("n") > 0)).collect():
            failed[row["table"]].add(row["check"])

    totals = counts.where(F.col("check").isNull()).select("table", F.col("n").alias("row_count"))
    ordinals = {s.table: sum(len(t.checks) for t in suites[:i]) for i, s in enumerate(suites)}
    offset = F.create_map(*(F.lit(x) for item in ordinals.items() for x in item))
    results = counts.where(F.col("check").isNotNull()).join(totals, "table")
    samples = [
        _samples(tables[s.table], s, failed[s.table], tables, area, sample_size) for s in suites
    ]
    samples = [s for s in samples if s is not None]
    if samples:
        results = results.join(reduce(DataFrame.unionByName, samples), ["table", "check"], "left")
    else:
        results = results.withColumn("sample_ids", F.lit(None).cast("array<string>"))
    return results.select(
        F.lit(run_id).alias("run_id"),
        "table",
        "check",
        (F.col("ord") + F.try_element_at(offset, F.col("table"))).alias("ord"),
        "kind",
        "row_count",
        F.col("n").alias("fail_count"),
        (F.col("n") == 0).alias("pass"),
        "sample_ids",
    )


def overall_pass(results: DataFrame) -> DataFrame:
    """Whether every check of a run passed; a missing outcome counts as failed."""
    return results.groupBy("run_id").agg(
        F.bool_and(F.coalesce("pass", F.lit(False))).alias("overall_pass")
    )


def row_counts(results: DataFrame) -> DataFrame:
    """Rows per checked table."""
    return results.groupBy("run_id", "table").agg(F.max("row_count").alias("row_count"))


def failures_by_table(results: DataFrame) -> DataFrame:
    """Failed checks per table, also where none failed."""
    failed = F.count_if(~F.coalesce("pass", F.lit(False)))
    return results.groupBy("run_id", "table").agg(failed.alias("failed_checks"))


def fk_violations(results: DataFrame) -> DataFrame:
    """Rows that break each foreign key, labelled ``table.check``."""
    return results.where(F.col("check").startswith("fk_")).select(
        "run_id", F.concat_ws(".", "table", "check").alias("label"), "fail_count"
    )
