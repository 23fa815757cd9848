import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

#: One fixture of awkward rows for every operator: NULLs, empty and blank texts, repeats, a clashing column.
AWKWARD = [
    (1, None, "a"), (2, "", "b"), (2, "", "b"), (3, " \t\n", None), (None, "you there, x y z", "c"),
    (5, "one two three", "d"), (5, "one two three four five six", "d"), (6, "word " * 30_000, "e"),
    (7, "é😀 " * 40, "f"), (8, "x" * 50_000, "g"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, "doc_id long, text string, pii string")


@pytest.fixture(scope="session")
def sample(spark):
    """All documents of the small table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
