import pytest

LONG = "alpha beta gamma " * 60_000


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty and very long texts, repeated rows and extra columns."""
    rows = [(1, "the quick brown fox jumps over the lazy dog again", "a", 1, "x"),
            (1, "the quick brown fox jumps over the lazy dog again", "a", 1, "x"),
            (2, "the quick brown fox jumps over the lazy dog again", None, None, None),
            (3, "", "b", 2, "y"), (4, None, "b", 2, "y"), (None, "some words of nobody", None, None, None),
            (5, LONG, "c", 3, "z"), (6, "one", "c", 3, "z"), (7, " \t\n ", "c", 3, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, grp string, size int, rep string")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string")
