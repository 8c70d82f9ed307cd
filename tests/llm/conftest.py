import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Null, empty and blank texts, null ids and sources, ties, copies, a very long text, clashing columns."""
    long_text = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [
        (1, "alpha beta gamma delta", "en", "a", 1),
        (1, "alpha beta gamma delta", "en", "a", 1),
        (2, None, "en", "a", 2),
        (3, "", None, None, 3),
        (4, " \t\n ", "fr", "b", 4),
        (None, "no id here but some words all the same", "de", "b", 5),
        (None, None, None, None, None),
        (7, long_text, "en", "a", 7),
        (8, long_text + " x", "en", "c", 8),
        (9, "ÄÖÜ ß é 中文 😀 \x00 end", "de", "c", 9),
        (1, "another text under the same id", "en", "a", 1),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clashing = ("size", "score", "fp", "mix", "component_id", "tokens", "target", "row_hash", "label", "m", "key", "host")
    # ``mix`` and ``score`` are outputs of operators that keep the documents' columns, so those get other names
    return frame.withColumns({c: F.lit(c) for c in clashing if c not in ("mix", "score")})


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
