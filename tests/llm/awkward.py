"""Fixtures that the tests of this folder share."""

import pytest

# Awkward documents: NULLs in every column, empty and very long texts, ties, repeated rows, and extra columns named
# like the operators' own.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, n_words string, _row int, "
    "fp string, part string, perplexity int, shard string, ids int"
)
PROSE = "The quick brown fox jumps over the lazy dog while twelve more foxes sleep under old trees near running water. "


def awkward():
    extra = ("no", "many", 1, "f", "p", 2, "s", 3)
    texts = [
        (1, PROSE * 4, "en", "a"), (2, PROSE * 4, "en", "a"), (2, PROSE * 4, "en", "a"), (None, PROSE * 4, "en", None),
        (3, None, "en", "a"), (4, "", "en", "b"), (5, " \t\n", None, "b"), (6, "word", "fr", "b"), (7, "two words", None, None),
        (8, "x" * 60_000, "en", "c"), (9, "lazy dog " * 9_000, "en", "c"), (10, "\n".join(["same line here"] * 90), "de", "c"),
        (11, "Señor é 日本語 😀 " * 30 + "mail a.b@c.example or +1 (017) 555-7713, 10.0.0.256 and 10.0.0.25!", "es", "d"),
        (12, "### $$$ %%% " * 60, "en", "d"), (13, PROSE.upper() * 5, "en", "d"), (14, PROSE * 3 + "And then some more.", "en", "e"),
        (15, "card 4111 1111 1111 1111 and 4111 1111 1111 1112", "en", "e"), (None, None, None, None),
    ]
    return [(i, t, lang, src, None if t is None else len(t), *extra) for i, t, lang, src in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
