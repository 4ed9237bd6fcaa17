import datetime

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score string, fingerprint long, component_id string, "
    "size string, taken date, held_out int, `odd.name` int, kept string"
)


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids, null and empty texts, ties, repeated rows, a very long text, and columns with clashing names."""
    long_text = " ".join(f"word{i % 977} other{i % 31}" for i in range(60_000))
    near = " ".join(f"alpha{i}" for i in range(400))
    texts = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "one two", "en", None), (4, "one two", "en", None),
        (5, "One TWO", "fr", "b"), (None, "no id here at all", "de", "b"), (None, None, None, None), (6, long_text, "en", "a"),
        (7, "<|endoftext|> in a text, 中文 und ünïcode 😀 'll 've", "en", "é"), (8, near, "en", "a"), (9, near, "en", "c"), (10, near + " beta", "en", "c"),
        (11, "x" * 5000, "en", ""), (12, "!!! ??? ...", None, "a"), (13, "12345 678", "en", "a"),
    ]
    rows = [(i, t, g, s, len(t) if t else None, "s", 5, "c", "z", datetime.date(2020, 1, 1), 7, 3, "k") for i, t, g, s in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
