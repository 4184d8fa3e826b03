import pytest

from barlens.llm import common as C

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def documents(spark):
    return C.table(spark, SF, "documents")


@pytest.fixture(scope="session")
def texts(documents):
    """doc_id -> text of the whole sf0.01 documents."""
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank, very long and repeated texts, null ids and columns, extra columns
    whose names the operators use themselves."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
    rows = [
        (1, None, "en", "a", 0, 1, "x", 0.5), (2, "", "en", "a", 0, 2, "x", 0.5), (3, " \t\n", None, None, None, 3, None, None),
        (4, long, "en", "b", len(long), 4, "x", 0.5), (4, long, "en", "b", len(long), 4, "x", 0.5),
        (5, "The same words stand here twice in two rows of one table.", "en", "b", 1, 5, "x", 0.5),
        (6, "The same words stand here twice in two rows of one table.", "de", "c", 1, 6, "x", 0.5),
        (None, "A row without any id has a text of its own all the same.", "en", None, 1, 7, "x", 0.5),
        (None, None, None, None, None, None, None, None),
        (7, "12345 67890 !!! ---", None, "c", 1, 8, "x", 0.5),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, shard long, size string, score double")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
