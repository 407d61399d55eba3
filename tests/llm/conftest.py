import pytest

#: Columns whose names the operators use themselves.
CLASHING = ["score", "n_words", "words", "text_hash", "fp", "start", "hits", "_id", "_doc_id", "anchor", "kept"]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from ``(doc_id, text)`` pairs, with further columns whose names clash."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
        full = [(i, t, "en", "s", None if t is None else len(t), *["x"] * len(CLASHING)) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int, score string")


@pytest.fixture(scope="session")
def odd():
    """Null ids and texts, empty and blank texts, repeated rows, one id with two texts, a long text."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    return [(None, "a lone text"), (1, None), (2, ""), (3, " \n\t "), (4, "same row"), (4, "same row"), (5, "one"), (5, "two"), (6, long), (None, None)]
