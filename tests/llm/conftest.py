import pytest

from ledgerlake.llm.tables import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark):
    """The texts of a small given table, by id."""
    return {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and columns with the names of results."""
    long_text = "alpha beta gamma delta epsilon zeta eta theta " * 20_000
    rows = [
        (1, None, "x", 1),
        (2, "", "x", 2),
        (3, " \t\n", "x", 3),
        (4, long_text, "x", 4),
        (5, "one two three four five six seven eight", "x", 5),
        (5, "one two three four five six seven eight", "x", 5),
        (6, "ONE two three four five six seven eight", None, None),
        (7, "漢字かな交じり文" * 40, "x", 7),
        (None, "one two three", "x", 8),
        (None, None, None, None),
    ]
    names = "doc_id long, text string, score string, n_tokens long"
    return spark.createDataFrame(rows, names).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
