import pytest

from drivelake.llm.common import shared_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture()
def odd_docs(spark):
    """Nulls in every column, empty and white texts, repeated rows, one long text, extra columns with odd names."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [(1, "One two three.", "a"), (2, None, None), (None, "no id", "b"), (3, "", "text"), (3, "", "text"), (4, " \n\t ", None),
            (5, long, "c"), (6, "x" * 5000, "c"), (7, "a  b\n c d 　e  ", "d"), (8, "<|endoftext|> in <|endoftext|>text", "d"),
            (1, "One two three.", "a"), (None, None, None), (9, "naïve \U0001f600\U0001f600 日本語 café", "e")]
    return spark.createDataFrame([(*r, i, "z") for i, r in enumerate(rows)], "doc_id long, text string, source string, `a b.c` int, part string")


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture()
def out_dir(spark):
    return shared_path(spark, "test")
