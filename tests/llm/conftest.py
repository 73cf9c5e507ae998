import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, score string, n_words string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    para = " ".join(f"word{i} of the and" for i in range(60))
    rows = [
        (1, para, "en", "a", 5, "x", "y", "z"), (2, para, "en", "a", 5, "x", "y", "z"), (2, para, "en", "a", 5, "x", "y", "z"),
        (3, None, None, None, None, None, None, None), (4, "", "fr", "b", 0, "", "", ""), (5, " \t\n\r", "fr", "b", 0, "", "", ""),
        (None, para + " tail", None, None, None, None, None, None), (6, "12 34", "de", None, 5, "x", "y", "z"), (7, "hello", "en", "c", 5, "x", "y", "z"),
        (8, "HELLO", "en", "c", 5, "x", "y", "z"), (9, "abc def " * 60_000, "en", "c", 5, "x", "y", "z"), (10, "x" * 700_000, "en", "c", 5, "x", "y", "z"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
