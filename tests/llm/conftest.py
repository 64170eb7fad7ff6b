import pytest
from corpora import KINDS, prose


@pytest.fixture(scope="session")
def docs(spark):
    def make(*rows):
        return spark.createDataFrame([(r + (None,) * 5)[:5] for r in rows], KINDS)

    return make


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and blank texts, a very long one, repeated rows, columns with clashing names."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog, again and again.", "en", "a", 3),
        (1, "The quick brown fox jumps over the lazy dog, again and again.", "en", "a", 3),
        (2, "", "en", None, None), (3, None, None, "a", None), (None, None, None, None, None), (None, "null id", "en", "b", 1),
        (4, " \t\n\x0b\x0c\r ", "en", "b", 1), (5, "12 345 !!", "de", "b", 1), (6, "naïve café ＡＢ 日本語 \U0001f600 é", "fr", "\U0001f600", 1),
        (7, prose(7, 60_000), "en", "a", 1), (8, "line\nline\n\nline", "en", "ä", 1), (8, "other text of the same id", "en", "ä", 1),
    ]
    made = spark.createDataFrame(rows, KINDS)
    for name in ("_id", "_sha", "score", "lang_pred", "kept", "_size", "copies", "n_tokens", "quality", "c0", "_best", "class", "a.b"):
        made = made.withColumn(name, made["n_chars"])
    return made
