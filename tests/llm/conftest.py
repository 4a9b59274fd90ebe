import pytest
from odd import CLASHING, DOCS, odd_rows

from playtrail.llm.stages import reach_workers


@pytest.fixture(autouse=True)
def workers(spark):
    reach_workers(spark)


@pytest.fixture
def odd_docs(spark):
    """The odd rows between columns whose names the operators use for themselves."""
    rows = [(d, t, 1, 2, 3, "n", 4, 5, 6, 7.0) for d, t in odd_rows()]
    return spark.createDataFrame(rows, f"{DOCS}, {CLASHING}")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
