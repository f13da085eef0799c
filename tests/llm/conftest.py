import pytest

LONG = "Und " * 20_000 + "ende"
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it again and again today"),
    (2, None),
    (3, ""),
    (4, "the quick brown fox jumps over the lazy dog and runs away from it again and again TODAY"),
    (4, "the quick brown fox jumps over the lazy dog and runs away from it again and again TODAY"),
    (None, "No id, 日本語 words 😀😀 here"),
    (7, LONG),
    (8, "  \n\t "),
    (9, "short"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with the names of results."""
    rows = [(*r, "x", None, 0) for r in ROWS]
    schema = "doc_id long, text string, fingerprint string, score double, TOXICITY int"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
