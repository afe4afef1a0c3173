import pytest

LONG = "long bigint"


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents():
    """Rows of ``documents``: nulls in every column, empty, very long, tied and repeated ones, ids far apart."""
    words = [f"w{i % 97}x{i % 31}" for i in range(30_000)]
    rows = [
        (1, "The quick brown fox jumps over the lazy dog again and again", "en", "a", 10),
        (2, "the QUICK brown fox\tjumps over the lazy dog again and again", "en", "b", 10),
        (3, "", "en", "a", 0),
        (4, None, None, None, None),
        (5, " ".join(words), "en", "a", None),
        (6, " ".join(words[:-3] + ["other", "end", "here"]), "en", "b", 1),
        (7, "Été à la plage, naïve 😀 text", "fr", None, 3),
        (7, "Été à la plage, naïve 😀 text", "fr", None, 3),
        (2**40, "one", "de", "c", 1),
        (-5, "one two", "de", "c", 1),
        (None, "nameless text without an id", "de", "c", 1),
        (None, None, "de", "c", 1),
        (12, "\x00 odd \x1f characters   here", "xx", "a", 1),
        (13, "one two three four five six seven eight", "en", "a", 1),
        (14, "eight seven six five four three two one", "en", "a", 1),
    ]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark, documents):
    """The rows with extra columns whose names operators use inside."""
    df = spark.createDataFrame(documents, SCHEMA)
    for name in ("score", "size", "key", "taken", "fp", "k", "b", "flag", "word", "c", "place", "cluster", "words"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
