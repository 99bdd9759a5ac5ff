import pytest

#: Nulls, an empty and a blank text, repeated rows, an equal id with another text.
ODD = [
    (1, "the cat sat on the mat and the dog ate the cat food today", "a"),
    (1, "the cat sat on the mat and the dog ate the cat food today", "a"),
    (1, "another text under the same id", "a"),
    (None, "a text without an id of any length at all", None),
    (2, None, "b"),
    (3, "", "b"),
    (4, " \n\t ", None),
    (5, "é " * 700 + "x" * 3000, "c"),
]


@pytest.fixture
def odd_documents(spark):
    """Odd rows, with extra columns whose names operators use inside."""
    rows = [(*r, 1, 2, 3, "k") for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, words int, size int, class int, key string")


@pytest.fixture
def no_documents(odd_documents):
    return odd_documents.where("doc_id > 99")


@pytest.fixture
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
