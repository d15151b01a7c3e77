import pytest
from llm_cases import CLASHING, SMALL, edge_rows
from pyspark.sql import functions as F

from rowgate.session import share_package
from rowgate.sources import StagingArea


@pytest.fixture(autouse=True, scope="session")
def package(spark):
    share_package(spark)


@pytest.fixture
def area(spark):
    with StagingArea(spark) as area:
        yield area


@pytest.fixture
def edge(spark):
    """The edge rows over several partitions, with columns of clashing names."""
    docs = spark.createDataFrame(edge_rows(), "doc_id bigint, text string, source string").repartition(3)
    return docs.select("*", *(F.lit(i).alias(name) for i, name in enumerate(CLASHING)))


@pytest.fixture
def empty(edge):
    return edge.where("false")


@pytest.fixture(scope="session")
def small(spark):
    """All documents of the smallest tables as (doc_id, text, source)."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()
    return sorted(tuple(r) for r in rows)
