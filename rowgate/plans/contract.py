"""What a clean table is, as data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..operators.checks import Check, Suite
from ..operators.decisions import PART, ROW, stage_reasons, stage_rows, with_reasons
from ..operators.duplicates import later_copies
from ..operators.normalize import ColumnRule, normalize
from ..operators.outliers import outlier_reason, tag_outliers
from ..operators.positions import with_positions
from ..operators.references import orphan_rows
from ..operators.rules import RowRule, tag_rows, untagged
from ..operators.split import MALFORMED, MALFORMED_ROW, POSITION, REASON, accepted
from ..sources.staging import StagingArea


@dataclass(frozen=True)
class Unique:
    """The first row of each key stays."""

    keys: tuple[str, ...]
    order_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class NotOutlying:
    """No z-score above the threshold, column after column."""

    columns: tuple[str, ...]
    threshold: float = fixed.Z_THRESHOLD
    sequential: bool = True


@dataclass(frozen=True)
class References:
    """Every row has a parent among the accepted rows of another table."""

    column: str
    table: str
    parent_key: str | None = None

    @property
    def reason(self) -> str:
        return f"fk_{self.column} not in {self.table}"


Rule = RowRule | Unique | NotOutlying | References


@dataclass(frozen=True)
class TableContract:
    """Clean-up, rejection rules in order of priority, and checks of one table.

    A later rule only sees rows that all earlier rules accept. Every reason is a text: a
    contract with an empty one raises, as its rows would count as accepted.
    """

    name: str
    key: str
    columns: Mapping[str, ColumnRule] = field(default_factory=dict)
    derived: Mapping[str, tuple[str, ColumnRule]] = field(default_factory=dict)
    rules: Sequence[Rule] = ()
    checks: Sequence[Check] = ()

    def __post_init__(self):
        if not all(isinstance(reason, str) and reason.strip() for reason in self.reasons):
            raise ValueError(f"{self.name}: a rule has no reason to reject rows for")

    @property
    def reasons(self) -> list[str]:
        """Every reason that a row of this table may be rejected for, in order of priority."""
        found: list[str] = []
        for rule in self.rules:
            if isinstance(rule, Unique):
                found.append(fixed.DUPLICATE_KEY)
            elif isinstance(rule, NotOutlying):
                found += [outlier_reason(c) for c in rule.columns]
            else:
                found.append(rule.reason)
        return found

    @property
    def parents(self) -> list[str]:
        return [rule.table for rule in self.rules if isinstance(rule, References)]

    @property
    def has_unique_key(self) -> bool:
        """Whether the rules leave one row of each key."""
        return any(isinstance(rule, Unique) and rule.keys == (self.key,) for rule in self.rules)

    @property
    def only_row_rules(self) -> bool:
        """Whether each row is decided on its own, so that ``tag_table`` has nothing to write."""
        return all(isinstance(rule, RowRule) for rule in self.rules)

    @property
    def suite(self) -> Suite:
        return Suite(self.name, self.key, self.checks)


def tag_table(
    raw: DataFrame,
    contract: TableContract,
    parents: Mapping[str, DataFrame],
    area: StagingArea | None = None,
) -> DataFrame:
    """Normalised rows with the reason each one is rejected for, NULL if accepted.

    The normalised rows are parsed and written once, and stay there: keys, statistics and missing
    parents are then found on the few columns they need, and the reasons join the rows where these
    lie. Lines that ``read_csv`` marked as malformed are rejected before all rules.
    """
    area = StagingArea.for_frame(raw, area)
    df = raw if POSITION in raw.columns else with_positions(raw)
    df = untagged(normalize(df, contract.columns, contract.derived))
    if MALFORMED in df.columns:
        df = df.withColumn(REASON, F.when(F.col(MALFORMED).isNotNull(), F.lit(MALFORMED_ROW)))
    groups = [(of_rows, list(group)) for of_rows, group in groupby(contract.rules, lambda r: isinstance(r, RowRule))]
    if groups and groups[0][0]:
        df = tag_rows(df, groups.pop(0)[1])
    if not groups:
        return df
    rows, found = stage_rows(df, contract.name, area), []
    left = rows.where(accepted())  # rows that all rules before accept, but for those since the last staged reasons
    last = rows
    for of_rows, group in groups:
        for rule in [group] if of_rows else group:
            if of_rows:
                left, last = tag_rows(left, rule), tag_rows(last, rule)
                continue
            found.append(stage_reasons(_tag_by_table(left, rule, parents, area, rows), area))
            last = with_reasons(rows, found)
            left = last.where(accepted())
    return last.drop(PART, ROW)


def _tag_by_table(
    left: DataFrame, rule: Rule, parents: Mapping[str, DataFrame], area: StagingArea, staged: DataFrame
) -> DataFrame:
    """The staged rows that a rule rejects, and maybe others, with the reason."""
    if isinstance(rule, NotOutlying):
        return tag_outliers(left, rule.columns, rule.threshold, rule.sequential, area)
    if isinstance(rule, Unique):
        return later_copies(left, rule.keys, rule.order_by).withColumn(REASON, F.lit(fixed.DUPLICATE_KEY))
    lost = orphan_rows(left, rule.column, parents[rule.table], rule.parent_key, area, staged)
    return lost.withColumn(REASON, F.lit(rule.reason))


def in_parent_order(contracts: Mapping[str, TableContract]) -> list[list[TableContract]]:
    """Contracts in waves: each table comes after the tables it refers to."""
    waves: list[list[TableContract]] = []
    waiting = dict(contracts)
    while waiting:
        wave = [c for c in waiting.values() if waiting.keys().isdisjoint(c.parents)]
        if not wave:
            raise ValueError(f"tables refer to each other in a circle: {', '.join(waiting)}")
        waves.append(wave)
        for contract in wave:
            del waiting[contract.name]
    return waves
