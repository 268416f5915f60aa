import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs or longer tuples; one row a partition where asked for."""

    def make(rows, parts=3):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, "en", "s0")[:4] if len(row) == 2 else (*row, "s0")[:4]
            full.append((doc_id, text, lang, source, len(text or "")))
        return spark.createDataFrame(full, DOC_SCHEMA).repartition(parts)

    return make


@pytest.fixture
def hard(docs):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and a clashing extra column."""
    rows = [
        (1, "one two three four five six seven eight nine ten " * 3, "en", "a"),
        (1, "one two three four five six seven eight nine ten " * 3, "en", "a"),
        (2, None, None, None),
        (None, "a text without an id that is long enough to be looked at " * 2, "en", None),
        (3, "", "de", "a"),
        (4, " \t\n\x0b\f\r ", "de", "a"),
        (5, "Große Wörter, ünïcode 漢字 \U0001f600 und ß" * 3, "de", "b"),
        (6, "x" * 300_000, "en", "b"),
        (7, "long words " * 30_000, "en", "b"),
        (8, "one two three four five six seven eight nine ten " * 3, "fr", "c"),
    ]
    from pyspark.sql import functions as F

    names = ("n_words", "kept", "counts", "shard", "slot", "fp", "key", "block", "topic", "probability", "copies")
    return docs(rows).withColumns({n: F.lit("other") for n in names})


@pytest.fixture
def empty(docs):
    return docs([(0, "x")]).where("doc_id > 0")
