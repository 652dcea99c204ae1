import pytest

LONG = "word and more, " * 8000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, an extra and clashing columns."""
    texts = [None, "", "  \n ", LONG, "Plain text. Nothing else here.", "Plain text. Nothing else here."]
    rows = [(i, t, "en", "s", 0, "x", 1) for i, t in enumerate(texts)]
    rows += [rows[-1], (None, "no id", None, None, None, None, None)]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, more string, "
        "N_Tokens long",
    )


@pytest.fixture(scope="session")
def documents(spark):
    """Make (doc_id, text) rows."""

    def make(*texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    return make
