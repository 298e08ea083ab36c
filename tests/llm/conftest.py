"""Staged tables of these tests go to a folder of pytest's; helpers for odd tables."""

import pytest

from surveyqa.llm import storage


@pytest.fixture(scope="session", autouse=True)
def staging(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("staged"))
    kept, storage.checkpoint_folder = storage.checkpoint_folder, lambda spark: folder
    yield folder
    storage.checkpoint_folder = kept


#: Null in any column, empty and blank texts, a very long text, ties and repeated rows, and extra columns
#: with names that the operators use themselves.
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, row string, n int, kind string, token string, quality_score double"
LONG = "word " * 60_000 + "token = 'abcdefgh12345678'"
ODD_ROWS = [
    (1, "Plain text of eleven words here to be kept by all rules.", "en", "a", 1, 1, "x", 1, "k", "t", 0.5),
    (1, "Plain text of eleven words here to be kept by all rules.", "en", "a", 1, 1, "x", 1, "k", "t", 0.5),
    (2, "Plain text of eleven words here to be kept by all rules.", None, None, None, None, None, None, None, None, None),
    (None, "no id", "en", "a", 1, 1, "x", 1, "k", "t", 0.5), (None, None, None, None, None, None, None, None, None, None, None),
    (3, None, "en", "a", 1, 1, "x", 1, "k", "t", 0.5), (4, "", "de", "b", 0, 2, "y", 2, "k", "t", 0.1),
    (5, " \t\n\r\x0b\x0c ", "de", "b", 0, 2, "y", 2, "k", "t", 0.1), (6, LONG, "de", "c", 1, 2, "y", 2, "k", "t", 0.1),
    (7, "é 🙂   two  blanks\n\n\nand breaks\r\n<|endoftext|> \x1c x", "fr", "c", 1, 2, "y", 2, "k", "t", 0.1),
    (3, "same id, other text", "en", "a", 1, 1, "x", 1, "k", "t", 0.5),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
