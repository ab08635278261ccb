import pytest

SMALL = "/root/testdata/sf0.001"
LONG = "word " * 30_000
EDGE = [
    (None, "a text without an id that has some words in it"),
    (None, None),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, LONG),
    (5, "x" * 60_000),
    (6, "the same row twice, with a few words more"),
    (6, "the same row twice, with a few words more"),
    (7, "the same row twice, with a few words more"),
    (8, "one"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Rows with nulls, empty and long texts and repeats, and columns named like those used within."""
    rows = [(i, t, "en", None, k, "n") for k, (i, t) in enumerate(EDGE)]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, source string, block int, spans string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
