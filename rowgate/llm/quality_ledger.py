"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit
per failed rule; a policy is a version with the set of rules that count. Changing a policy,
or asking what each of its rules costs, reads the bits and never a text again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, encoded, fresh

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint"
)


def measure(text: bytes) -> tuple[int, int, int, int, int, int]:
    """Words, code points in words, symbols, lines with a word, repeated lines, and words
    inside a 3-word window that the text has twice or more."""
    words = text.split()  # bytes split at space, \t, \n, \v, \f and \r: exactly the word pattern
    n = len(words)
    if not n:
        return 0, 0, sum(text.count(s.encode()) for s in SYMBOLS), 0, 0, 0
    decoded = text.decode("utf-8", "replace")
    spaces = sum(decoded.count(s) for s in SPACES)
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\x0b\x0c\r")]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        seen: set = set()
        twice = set()
        for window in windows:
            if window in seen:
                twice.add(window)
            else:
                seen.add(window)
        covered_to = 0
        for i, window in enumerate(windows):
            if window in twice:
                repeated += i + WINDOW - max(covered_to, i)
                covered_to = i + WINDOW
    symbols = sum(text.count(s.encode()) for s in SYMBOLS)
    return n, len(decoded) - spaces, symbols, len(lines), len(lines) - len(set(lines)), repeated


def _measured(texts: pa.Array) -> pa.Array:
    rows = [measure(text) for text in encoded(texts)]
    names = [part.split()[0] for part in MEASURES.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


Measured = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """A document fails where ``fails`` holds; it is given the measurements by name."""

    name: str
    fails: Callable[[Measured], Column]


#: The bit of a rule is its place. New rules go to the end, so that old ledgers stay readable.
RULES = (
    Rule("too_few_words", lambda m: m("n_words") < 50),
    Rule("repeated_windows", lambda m: 100 * m("n_repeat_words") > 50 * m("n_words")),
    Rule("many_symbols", lambda m: 10 * m("n_symbols") > 3 * m("n_words")),
    Rule("repeated_lines", lambda m: (m("n_lines") >= 4) & (2 * m("n_dup_lines") > m("n_lines"))),
    Rule("short_words", lambda m: m("word_chars") < 2 * m("n_words")),
    Rule("long_words", lambda m: m("word_chars") > 25 * m("n_words")),
    Rule("some_symbols", lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("some_repeats", lambda m: 100 * m("n_repeat_words") > 20 * m("n_words")),
)
BASE = ("too_few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]


#: ``v1`` are the base rules alone, ``v2`` is in use, ``v3`` a stricter trial.
POLICIES = (
    Policy("v1", BASE),
    Policy("v2", (*BASE, "many_symbols", "repeated_lines", "short_words", "long_words")),
    Policy("v3", tuple(rule.name for rule in RULES)),
)
IN_USE = POLICIES[1]


def bits_of(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    """The bitmask of the named rules; an unknown name raises."""
    place = {rule.name: i for i, rule in enumerate(rules)}
    return sum(1 << place[name] for name in set(names))


def with_ledger(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, into: str = "ledger") -> DataFrame:
    """The documents with a struct ``into``: all measurements and ``fail_bits``.

    A null, empty or blank text has no words and fails what a text without words fails. The
    rows stay where they are: nothing is shuffled.
    """
    measured = fresh(docs, "measured")
    value: Measured = lambda name: F.col(measured).getField(name)
    bits = F.lit(0).cast("bigint")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(rule.fails(value), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint"))
    fields = [value(part.split()[0]).alias(part.split()[0]) for part in MEASURES.split(", ")]
    return (
        docs.withColumn(measured, F.arrow_udf(_measured, f"struct<{MEASURES}>")(column(text)))
        .withColumn(into, F.struct(*fields, bits.alias("fail_bits")))
        .drop(measured)
    )


def passes(fail_bits: Column, policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    """Whether a document passes the policy: none of its bits is set."""
    return fail_bits.bitwiseAND(F.lit(bits_of(policy.rules, rules)).cast("bigint")) == 0


def keep_passing(docs: DataFrame, policy: Policy = IN_USE, text: str = "text") -> DataFrame:
    """The documents that the policy lets pass, unchanged."""
    into = fresh(docs, "ledger")
    marked = with_ledger(docs, text, into=into)
    return marked.where(passes(F.col(into).getField("fail_bits"), policy)).drop(into)


def ablations(fail_bits: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """What each rule of each policy costs: one row per policy and rule.

    ``fail_bits`` has one column of that name. Equal masks are counted first, so all that is
    left is one row per distinct mask, 2 to the number of rules at most. ``failed`` fail the
    rule, ``failed_alone`` fail no other rule of the policy and would be kept without it.
    """
    masks = fail_bits.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    counts: list[Column] = []
    lines: list[tuple[str, str, int, int]] = []
    for policy in policies:
        whole = bits_of(policy.rules, rules)
        for name in policy.rules:
            lines.append((policy.version, name, whole, bits_of([name], rules)))
    for i, (_, _, whole, bit) in enumerate(lines):
        own = F.col("fail_bits").bitwiseAND(F.lit(whole).cast("bigint"))
        counts += [
            F.sum(F.when(own.bitwiseAND(F.lit(bit).cast("bigint")) != 0, F.col("n")).otherwise(0)).alias(f"f{i}"),
            F.sum(F.when(own == bit, F.col("n")).otherwise(0)).alias(f"a{i}"),
            F.sum(F.when(own == 0, F.col("n")).otherwise(0)).alias(f"k{i}"),
        ]
    rows = [
        F.struct(
            F.lit(version).alias("policy"), F.lit(name).alias("rule"),
            F.coalesce(f"k{i}", F.lit(0)).alias("kept"),
            F.coalesce(f"f{i}", F.lit(0)).alias("failed"),
            F.coalesce(f"a{i}", F.lit(0)).alias("failed_alone"),
        )
        for i, (version, name, _, _) in enumerate(lines)
    ]
    return masks.agg(*counts).select(F.inline(F.array(*rows)))
