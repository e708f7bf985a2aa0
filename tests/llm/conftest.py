import pytest

LONG = "alpha beta gamma delta " * 30_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in every column, empty, blank and very long texts, repeated rows and clashing column names."""
    rows = [
        (1, "one two three four five six", "en", "a", 27, 0, "x"),
        (1, "one two three four five six", "en", "a", 27, 0, "x"),
        (2, None, None, None, None, None, None),
        (3, "", "de", "b", 0, 1, "y"),
        (4, " \n\t\n ", "de", None, 5, 1, "y"),
        (None, "one two three four five six", "en", "b", 27, 1, None),
        (5, LONG, "en", "b", len(LONG), 1, "z"),
        (6, "é\x85ü ß ퟿\U0001f600 x", None, "c", 9, 1, "z"),
        (7, "A\r\nA\r\nB\n\n\nA\r", "fr", "c", 12, 1, "z"),
    ]
    kind = "doc_id long, text string, lang string, source string, n_chars long, size long, n_cut string"
    return spark.createDataFrame(rows, kind)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
