import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, length int, fp string, span int, uid int, rank int, label int, _key string"
LONG = "word " * 30_000 + "é" * 5_000


def rows(texts):
    """(doc_id, text) pairs as documents with further columns whose names clash with inner ones."""
    return [(i, t, "en", "s", None if t is None else len(t), 1, "x", 2, 3, 4, 5, "k") for i, t in texts]


@pytest.fixture(scope="session")
def nasty(spark):
    """Nulls, empty and very long texts, repeated rows, ties, clashing columns."""
    texts = [(1, None), (2, ""), (3, "   \n\n"), (None, "a text without id, but with a few words"), (4, LONG), (5, "same text here"),
             (6, "same text here"), (5, "same text here"), (7, "x"), (8, 'token = "abcdefgh12345678"\n日本語 ok'), (None, None), (9, "a b\na b\na b")]
    return spark.createDataFrame(rows(texts), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    from tests.conftest import SF_SMALL

    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.fixture(scope="session")
def make(spark):
    return lambda pairs: spark.createDataFrame(rows(pairs), SCHEMA)
