import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, blanks, repeats, one very long text, extra columns with clashing names."""
    long = " ".join(f"w{i} of the" for i in range(20_000))
    rows = [(1, None, "en", None, None), (2, "", None, "s", 0), (3, " \n\t ", "en", "s", 3), (4, "same line of text here", "en", "s", 1), (5, "same line of text here", "en", "s", 1),
            (5, "same line of text here", "en", "s", 1), (6, long, "en", "s", 1), (7, long + " end", "de", "s", 1), (None, "no id at all", "de", None, 1), (9, "!!! ???", "fr", "s", 1)]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("line", "label", "u", "v", "n", "leaks", "root", "token", "key", "item_id", "set_key"):
        df = df.selectExpr("*", f"'x' as {c}")
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
