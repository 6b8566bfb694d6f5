import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: null and empty texts, ties, repeated rows, a very long text, a null id
ODD = [
    (1, None, "en", "a", 0), (2, "", None, None, 0), (3, " \t\n ", "en", "a", 4), (4, "x", "de", "b", 1),
    (5, "same words in this very text", "en", "a", None), (6, "same words in this very text", "en", None, 28),
    (6, "same words in this very text", "en", None, 28), (7, "word " * 30_000, "en", "a", 150_000),
    (None, "a row without an id but with words", "fr", "b", 34), (8, "été 12345 \x00 <|endoftext|> end", "fr", "b", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENT)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCUMENT)


def documents(spark, sf="0.001"):
    return spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
