import pytest


@pytest.fixture(scope="session")
def ready(spark):
    from dayfold.llm.common import ship

    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd_docs(ready):
    """Nulls in any column, blank, wordless and long texts, repeated rows, a clashing extra column."""
    rows = [(1, "one two three four five six seven", "en", 1), (2, "one two three four five six seven", "en", 2),
            (3, None, "en", 3), (4, "", None, None), (5, " \n\t ", "fr", 5), (6, "short", "fr", 6),
            (7, "12 34 !!", "fr", 7), (8, "x" * 70_000, "en", 8), (9, "word " * 30_000, "en", 9),
            (10, "one two three four five six seven", "en", 1), (10, "one two three four five six seven", "en", 1),
            (None, "one two three four five six seven", "en", 1), (None, None, None, None), (11, "é", "fr", 11),
            (12, "nul \x00 byte <|endoftext|> it's 'll", "en", 0)]
    return ready.createDataFrame(rows, "doc_id long, text string, lang string, n long").selectExpr(
        "*", "n as chunk", "n as set_id", "n as key", "n as pack", "n as learn", "n as held_out").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
