import pytest

SCHEMA = ("doc_id long, text string, TEXT string, key string, score string, sig string, "
          "lang string, n_chars int")


@pytest.fixture(scope="session")
def make(spark):
    """(id, text) rows as documents with extra columns whose names clash."""

    def rows(pairs):
        return spark.createDataFrame(
            [(i, t, "other", "k", "s", "g", "en", len(t or "")) for i, t in pairs], SCHEMA)

    return rows


LONG = ("Some words of a very long text, number %d of it.\n" * 6000) % tuple(range(6000))


@pytest.fixture(scope="session")
def odd(make):
    """Nulls, empty, blank, very long and repeated texts, repeated and null ids."""
    return make([(1, None), (2, ""), (3, "  \n\t "), (4, LONG), (5, "one two"), (5, "one two"),
                 (6, "one two"), (7, "mail me@mail.example.com now. Now call +1 (017) 555-7713!"),
                 (7, "another text under the same id"), (None, "no id here"), (None, None),
                 (2**62 + 1, "a large id stays exact, beside null ones")])


@pytest.fixture(scope="session")
def empty(make, spark):
    return spark.createDataFrame([], SCHEMA)
