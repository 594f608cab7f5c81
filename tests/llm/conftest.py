import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables not there")
    return SF_DIR


ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "one two",
    "One two",
    "a b c d e f g h " * 40,
    "x" * 5000,
    "é ü 漢字 \u2028 \x1c 😀 \x00 end",
    "Same text in two rows, with enough words to be counted as a text of its own here today.",
    "Same text in two rows, with enough words to be counted as a text of its own here today.",
    "line\nline\nline\n\nline two\n\n\nend",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, tiny, long, repeated and clashing."""
    rows = [(i, t, "en", f"s{i % 2}", 1, 7, "x") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[3], (None, "a row without an id", None, None, None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, n_words int, kept string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
