import pytest

LONG = " ".join(f"w{i % 997}x{i}" for i in range(60_000))

# id, text, lang, source, n_chars and columns whose names operators use inside
DOCUMENTS = ("doc_id long, text string, lang string, source string, n_chars long, keep_id string, sha string, "
             "row string, rid int, n int, `_possible` boolean, node long, found string")


def row(doc_id, text, lang="en", source="s", n=1):
    return (doc_id, text, lang, source, n, "k", "h", "r", 7, 8, True, 9, "f")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows,
    ties, and clashing column names."""
    rows = [row(5, "same  text\tof a few words here"), row(3, "same text of a few words here"),
            row(9, "Same text of a few words here"), row(3, "same text of a few words here"),
            row(None, "same text of a few words here"), row(None, None), row(4, None), row(6, ""), row(7, "  \n "),
            row(8, LONG), row(8, "another text under an id that is taken"), row(10, "x", None, None, None),
            (None,) * 13, row(11, "12 345 .. !!"), row(12, LONG + " tail")]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
