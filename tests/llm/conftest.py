import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns whose names may clash."""
    rows = [(1, None, "en", 5), (2, "", "en", 5), (3, " \n\t\n", None, 1), (4, "word " * 30_000, "en", 2),
            (5, "Same line\nother é\nSame line", "fr", 3), (5, "Same line\nother é\nSame line", "fr", 3),
            (None, "Same line", "fr", 3), (6, "x" * 700, None, 0), (7, "12 34 ...", "en", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_lines int")
