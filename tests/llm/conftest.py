import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents of the smallest scale plus odd rows: nulls, blanks, ties, repeated rows."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame(
        [(900001, None, None, None, None), (900002, "", "en", "s", 0), (900003, " \n\t ", "en", "s", 4), (900004, "123 456 --", None, "s", 10),
         (900005, "the", "en", None, 3), (900005, "the", "en", None, 3), (None, "of the and of the and", None, "s", None),
         (900006, "é 漢字   x", "fr", "s", 9), (900007, ("the of and to in " * 4000), "en", "s", 72000)], SCHEMA)
    return docs.unionByName(odd).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
