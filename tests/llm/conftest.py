import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
import cases  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return cases.documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, cases.SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], cases.SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """A null id, an id with two texts, and a row that stands twice."""
    t = " ".join(cases.VOCAB[:60])
    data = [(None, t, None, None), (1, t, "en", "a"), (1, t, "en", "a"), (2, t + " more", "en", "a"), (2, "other words here", "de", "b"), (3, None, None, None)]
    return spark.createDataFrame([(i, x, a, b, len(x or ""), 0, "", "", "", "") for i, x, a, b in data], cases.SCHEMA)
