"""Fixtures that the tests of the operators share."""

import pytest

TEXT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents of (doc_id, text[, lang, source]) rows, with a clashing extra column name."""

    def make(*rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "src0")), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, TEXT)

    return make


#: Cases every operator must take: NULL and empty texts, NULL and repeated ids, white space.
ODD = [(1, None), (2, ""), (3, " \t\n "), (None, "a b c"), (4, "x"), (4, "x"), (5, "é 漢字 " * 3)]


@pytest.fixture
def odd(docs):
    return docs(*ODD)

