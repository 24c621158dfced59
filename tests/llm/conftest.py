import pytest
from llm_helpers import prose
from pyspark.sql import types as T

#: Names that the operators use inside or return.
CLASHES = ["score", "n_words", "fp", "cell", "size", "shard", "_row", "stratum", "key", "ids", "level", "part", "label", "root", "h", "n", "_m", "max_symbol_rate"]

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in CLASHES]])

EDGE_ROWS = [
    (1, None, "en", "s"), (2, "", "en", "s"), (3, " \t\n\x0b\r ", None, None), (4, "a", "en", "s"), (5, "Über ñandú 東京   x", None, "s"),
    (6, prose(1, 80), "en", "s"), (6, prose(1, 80), "en", "s"), (7, prose(1, 80), "de", "s"), (8, prose(2, 60000), "en", "s"), (9, "x" * 150000, "en", "s"),
    (10, "12345 67890", "en", "s"), (11, "Same line\nSame line\n\nSame line", "en", "s"), (None, prose(3, 70), "en", "s"), (None, None, None, None),
]


@pytest.fixture(scope="session")
def edge_rows():
    return EDGE_ROWS


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *["clash"] * len(CLASHES)) for r in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    return make_docs(EDGE_ROWS)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
