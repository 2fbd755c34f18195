import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, high long, "
    "words string, n_lines long, component_id long"
)
FILLER = "word number %d of a text that goes on and on "


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with further columns whose names operators might use themselves."""

    def make(*pairs):
        rows = [(i, text, None, "src0", None if text is None else len(text), 0.5, None, 1, "x", 7, 8) for i, text in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def awkward():
    """Null ids and texts, empty and blank texts, repeated rows, and one very long text."""
    long = "".join(FILLER % i for i in range(4000))
    return [
        (1, None), (2, ""), (3, " \n\t \n"), (None, "a text without an id"), (None, None), (4, "one"), (5, "same text"),
        (5, "same text"), (6, "same text"), (7, long), (8, "é日本 ümlaut 😀 \x1f \x85 Straße\r\nİ K ſ"),
    ]


@pytest.fixture(scope="session")
def larger(testdata):
    """The next larger tables, where each kind of finding occurs."""
    import os

    folder = testdata.replace("sf0.001", "sf0.01")
    return folder if os.path.isdir(folder) else testdata
