import pytest

AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Two words"), (6, "a b c"), (7, "A B  c"), (8, "x\x1cy z w é\x0bq"),
    (9, "line one\nline two\nline three\nline one\nline two\nline three\n\n"), (10, "tab\there </s> <|endoftext|> \U0001f600 Ünï"),
    (11, "rep eat " * 400), (12, "rep eat " * 400), (12, "rep eat " * 400), (13, " ".join(f"w{i}" for i in range(30_000))),
    (None, "no id at all"), (None, None), (15, "#*$%&|<> \r\n #*"),
]


@pytest.fixture
def awkward(spark):
    """Nulls, empty, white and very long texts, repeated rows, and extra columns with names the operators use."""
    rows = [(d, t, "en", "s", "shard!", 1, "w") for d, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard string, n long, words string")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
