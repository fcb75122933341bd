import pytest
from edge_rows import EDGE_ROWS

from tidemark.llm.shared import with_package


@pytest.fixture(scope="session")
def llm(spark):
    return with_package(spark)


@pytest.fixture(scope="session")
def edge(llm):
    """The edge rows with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    rows = llm.createDataFrame(EDGE_ROWS, "doc_id long, text string, source string").repartition(3)
    clashing = ["row", "part", "place", "shard", "slot", "block", "spot", "size", "label", "score", "fp", "s", "b", "n", "guest", "word", "lang"]
    return rows.select("*", *[F.lit("clash").alias(c) for c in clashing])
