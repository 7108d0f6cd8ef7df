"""Words as the contracts define them, and small document tables with odd rows (import the fixtures)."""

import re

import pytest

WORDS = re.compile(r"[^\x20\x09-\x0D]+")

#: doc_id, text, lang, source, n_chars, and two columns whose names clash with others' inner names
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, h string"


def words(text):
    return WORDS.findall(text or "")


def make_docs(spark, rows):
    return spark.createDataFrame(
        [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or ""), 1, "x") for r in rows],
        DOC_SCHEMA)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, a very long one, repeated rows and ids, odd characters."""
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000)) + "\n" + "end of it"
    rows = [(5, "one two three four five six", "en", "a"), (1, None, "fr", None), (2, "", None, "b"), (3, " \n\t ", "en", "b"),
            (None, "text without an id here", "en", "a"), (None, None, None, None), (7, long_text, "en", "c"),
            (8, "one two three four five six", "en", "a"), (8, "one two three four five six", "en", "a"),
            (9, "Straße naïve \x1c odd space 中文 <|endoftext|> don't 'tis", "de", "a"),
            (9, "same id, another text", "de", "a"), (0, "zero\nzero\nzero", "en", "z")]
    return make_docs(spark, rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
