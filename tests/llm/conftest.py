import pytest

from conftest_llm import prose
from starmart.llm.common import prepare

COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, "
           "size long, score double, key string, row string, tk string, n_words long, copies int, hit int, label string, lines_removed int")


@pytest.fixture
def documents(spark):
    """documents with further columns whose names operators might use themselves; rows are (doc_id, text, source)."""
    prepare(spark)

    def build(*rows):
        full = [(i, t, "en", s, len(t) if t is not None else None, 1, 0.5, "k", "r", "t", 2, 3, 4, "l", 5) for i, t, s in rows]
        return spark.createDataFrame(full, COLUMNS)
    return build


@pytest.fixture
def odd(documents):
    """Null and empty cells, repeated rows, one id with two texts, white space only, a very long text."""
    return documents(
        (1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (None, "no id here but some words to go with it", "b"), (None, None, None),
        (4, "the same row twice is one document", "b"), (4, "the same row twice is one document", "b"), (5, "two texts under", "a"),
        (5, "one id are two texts", "a"), (6, prose(1, 60_000), "c"), (7, "x" * 50_000, "c"), (8, "É naïve Ünïcode wörds ß", "c"))
