"""Rows that every operator must take."""

import random

SMALL = "/root/testdata/sf0.001"
#: Columns whose names the operators use inside.
CLASHING = (
    "size", "shard", "slot", "digest", "key", "n", "labels", "task", "kind", "row", "of", "ledger", "fail_bits",
    "measured", "repeats", "cid", "bin", "target", "threshold", "id", "words", "text_sha", "ledger_", "multiplier",
)


def long_text() -> str:
    """A text of 60,000 different words."""
    rng = random.Random(5)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(60_000))


def edge_rows() -> list[tuple]:
    """``doc_id, text, source``: nulls, empty, blank, very long and repeated texts, ties."""
    plain = " ".join(f"word{i}" for i in range(80))
    return [
        (1, None, "a"), (2, "", "b"), (3, " \t\n", None), (4, plain, "a"), (5, plain, "b"), (5, plain, "b"),
        (6, plain + " ", "c"), (7, plain.replace(" ", "\n"), None), (8, long_text(), "a"), (9, "one two", "a"),
        (10, "one two", "\U0001f600"), (11, "one two éß", "z"), (None, plain, "a"), (None, None, None),
        (12, plain.replace("word40", "other"), "a"), (13, "x", "a"),
    ]
