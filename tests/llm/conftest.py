import pytest

#: Columns whose names the operators use themselves.
EXTRA = "kept string, key string, d string, turn string, runs string, of string, copies string, draw string, k string"


@pytest.fixture(scope="session")
def docs(spark):
    """A documents table from (doc_id, text) pairs or (doc_id, text, lang, source), with extra columns of clashing names."""

    def build(*rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or ""), *"abcdefghi") for r in rows]
        schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
        return spark.createDataFrame(full, schema).repartition(3)

    return build


@pytest.fixture(scope="session")
def edge_rows():
    """Null and repeated ids, null, empty and blank texts, repeated rows, a long text."""
    long = " ".join(f"word{i % 5000} is here." for i in range(20_000))
    body = "Some words that make a text of its own. " * 3
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, body), (4, body), (5, "one two"), (None, body), (None, None), (6, long), (6, "other text"), (7, "#" * 50)]
    return rows
