import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, n bigint, ids string"


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty fields, ties, repeated rows, blank and long texts, and columns whose names operators use inside."""
    prose = "The old harbour wall keeps the winter sea away from the small houses. People walk there in the evening, when it is calm. "
    rows = [
        (1, prose * 3, "en", "a", None, "k", 1, "x"), (2, prose * 3, "en", "a", 1, None, None, None), (2, prose * 3, "en", "a", 1, None, None, None),
        (3, None, None, None, None, None, None, None), (4, "", "en", "b", 0, "k", 2, "y"), (None, prose, None, "b", 5, "k", 3, "z"), (None, None, None, None, None, None, None, None),
        (5, " \n\t ", "fr", "b", 4, "k", 4, ""), (6, "one", "en", "b", 3, "k", 5, ""), (7, "É ß 漢字 ▁ \u0000 😀 <|endoftext|> it's\r\n", "de", "b", 9, "k", 6, ""),
        (8, prose * 400, "en", "c", 40000, "k", 7, ""), (9, prose * 3 + "x", "en", "c", 2, "k", 8, ""), (10, "word " * 3000 + "z" * 5000, "en", "c", 2, "k", 8, ""),
    ]
    return rows


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
