import pytest

#: (doc_id, text) with nulls, empty and white-space texts, repeated rows, ties and a long text.
ODD = [
    (1, "Alpha beta  gamma\tdelta."), (2, "Alpha beta gamma delta."), (2, "Alpha beta gamma delta."), (3, None), (4, ""), (5, " \n "), (None, "alpha"),
    (6, "one two"), (7, "1234 5678"), (8, "x" * 30_000), (9, "<|endoftext|> ΑΣ é🙂\u0000 end"), (10, "Alpha beta gamma delta."),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with further columns whose names clash with those that operators use."""
    rows = [(*r, "a", 1, None) for r in ODD]
    return spark.createDataFrame(rows, SCHEMA + ", lang string, keep_id int, _digest string").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA + ", lang string")


