import pytest


@pytest.fixture
def frame(spark):
    """Builds a DataFrame from rows and a schema string, in two partitions."""

    def build(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(2)

    return build


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def hard_docs(frame):
    """Nulls in every column, empty and very long texts, repeated rows."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "some words here", "en", "a", 15),
            (3, long, "en", "a", len(long)), (4, long, None, None, None), (5, "same row", "en", "a", 8),
            (5, "same row", "en", "a", 8), (6, "  \n\t ", "de", "b", 5), (7, "é" * 50_000, "fr", "b", 50_000)]
    return frame(rows, DOCS)
