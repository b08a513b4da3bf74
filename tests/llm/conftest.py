import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, n_words string, text_key string, name int"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with clashing extra columns."""

    def make(pairs, lang="en", source="s"):
        rows = [(i, t, lang, source, len(t or ""), True, "x", "k", 1) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def text_of():
    """Seeded texts of a small vocabulary."""

    def make(n, seed, vocabulary=400):
        r = random.Random(seed)
        return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))

    return make


@pytest.fixture(scope="session")
def odd_texts(text_of):
    """Nulls, empty and blank texts, one word, repeats, a very long text, odd white space."""
    return [None, "", " \t\n ", "one", "one", "a b c", "x " * 300, text_of(30_000, 5), "A\x0bB\x0cC D E é ü 漢字",
            text_of(60, 1), text_of(60, 1), "y" * 5000]
