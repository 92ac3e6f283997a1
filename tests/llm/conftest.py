import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside, to clash with.
        T.StructField("size", T.StringType()),
        T.StructField("_text_hash", T.StringType()),
        T.StructField("_key", T.StringType()),
        T.StructField("n", T.StringType()),
    ]
)


def prose(seed, n):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 4001}" for i in range(n))


LONG = prose(3, 30_000)
TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    prose(1, 300),
    prose(1, 300),
    prose(1, 299) + " changed",
    prose(2, 60),
    LONG,
    "Ünï©ode straße 東京 🙂 " + prose(4, 80),
    "same line\nsame line\n" + prose(5, 70),
    "a b c a b c a b c " * 30,
]


@pytest.fixture(scope="session")
def odd_rows():
    rows = [(i, t, "en", f"s{i % 4}", 0, "x", "y", "z", "n") for i, t in enumerate(TEXTS)]
    rows += [(None, prose(6, 90), None, None, None, None, None, None, None)] * 2
    rows += [(4, prose(1, 300), "en", "s0", 0, "x", "y", "z", "n")]  # a repeated row
    rows += [(5, prose(7, 100), None, None, None, None, None, None, None)]  # a repeated id
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
