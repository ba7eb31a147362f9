import pytest

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))

#: Columns whose names the operators use inside.
CLASHING = ("_id", "_text", "_key", "row", "fp", "node", "score", "line", "n", "token", "component", "words", "_copy", "spans", "_place", "_gone", "gone", "id",
            "old", "new", "place", "_best", "n_words", "items", "base", "terms")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Null and empty texts, a very long one, repeated rows, ties, null ids, and extra columns with clashing names."""
    rows = [
        (1, None), (2, ""), (3, "   \n\t "), (4, LONG), (5, "one two three four five six"), (5, "one two three four five six"),
        (6, "one two three four five six"), (None, "a text without an id at all"), (None, None), (7, "\n\n\n"),
        (8, "Ünïcödé 日本語 🎉 ▁ text here"), (9, "x" * 20_000),
    ]
    wide = spark.createDataFrame(rows, "doc_id long, text string")
    return wide.selectExpr("*", *[f"'{c}' AS `{c}`" for c in CLASHING])


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
