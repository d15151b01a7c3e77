"""Every query agrees with its SQL on the smallest tables."""

import os
import pathlib
import shutil
import subprocess
import sys

import pytest
from agreement import connect, difference

import __spark_entry__ as book

FOLDER = book.SMOKE_DIR


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(book.queries()))
def test_query_agrees_with_sql(spark, database, name):
    result = book.queries()[name](spark, FOLDER)
    sql = book.oracle_sql().get(name)
    if sql is None:
        assert result.count() > 0
    else:
        assert difference(result, database, sql) == ""


def test_optional_modules_may_be_missing(monkeypatch):
    every = set(book.queries())
    monkeypatch.setattr(book.importlib.util, "find_spec", lambda name: None)
    base = set(book.queries())
    assert base == set(book.QUERIES) and base <= every and set(book.oracle_sql()) <= base


def test_everything_else_works_without_the_training_data_operators(tmp_path):
    """A copy without the two folders, the pipeline left in or taken out."""
    root = pathlib.Path(book.__file__).parent
    for name in ("rowgate", "querybook", "__spark_entry__.py", "corpus_pipeline.py"):
        if (root / name).is_dir():
            shutil.copytree(root / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif (root / name).exists():
            shutil.copy(root / name, tmp_path / name)
    code = (
        "import __spark_entry__ as e; from pyspark.sql import SparkSession as S; "
        "s = S.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate(); "
        "print('FOUND', len(e.queries()), len(e.oracle_sql()), e.entry(s).count() > 0)"
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONDONTWRITEBYTECODE": "1"}
    for _ in range(2):
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300)
        assert f"FOUND {len(book.QUERIES)} {len(book.ORACLES)} True" in done.stdout, done.stderr[-2000:]
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)


def test_entry_returns_rows(spark):
    assert book.entry(spark).count() > 0
