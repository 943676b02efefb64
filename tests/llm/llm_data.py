import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with columns whose names operators might use themselves."""
    def make(rows, clash=True):
        df = spark.createDataFrame([(i, t, "en", None, None if t is None else len(t)) for i, t in rows], DOCS).coalesce(2)
        if not clash:
            return df
        names = ["node", "label", "n", "kept", "piece", "length", "score", "key", "gram", "at", "h", "fold", "lines", "rows", "count"]
        return df.select("*", *[F.lit(c).alias(c) for c in names])
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows, a repeated id, a null id, one very long text."""
    long = " ".join(f"w{i % 5003} the of and" for i in range(30_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (5, "one two"), (None, "one two"), (6, "ONE two"),
            (7, long), (8, long), (9, "a\x1fb \x0bc\x85d \r\n e"), (9, "another text of the same id"), (10, "\U0001f600 é " * 60)]


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")
