import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa"]


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with those that operators make."""

    def make(rows, key="doc_id", value="text"):
        schema = f"{key} bigint, {value} string, keep_id string, part string, size int, n_words string, `a.b` int"
        return spark.createDataFrame([(i, t, "x", "y", 1, "z", 2) for i, t in rows], schema)

    return make


@pytest.fixture
def odd_texts():
    """Null, empty, blank, very long, tied and repeated texts."""
    return [(1, None), (2, ""), (3, " \t\n"), (4, "word " * 30000), (5, "Straße ünïcode \U0001f600 x"), (5, "twice the same id"),
            (6, "same text here"), (7, "same text here"), (8, "same  text\nhere"), (None, "no id"), (9, "a\x00b\x1cc"), (10, "x" * 50000)]
